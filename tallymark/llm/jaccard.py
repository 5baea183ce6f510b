"""N-gram Jaccard join as a T-occurrence search over inverted lists (DivideSkip).

A document is the set of its distinct four-word shingles, hashed to 64 bits. Two sets link
when 100 * intersection >= 85 * union. Equal sets are one class before anything else.

Candidates. All sets order their shingles alike: rare ones first, by hash within. If two
sets link, the first ``prefix_length`` shingles of both have one in common, so a set is
listed under those alone. A short list's members are searched pair by pair. A long list
is first linked to leaders, members of about the same size, one candidate each. What then
still lies in different components of a long list is searched in rounds: the members outside
the list's largest component, in tiles, against all its members, in blocks, by parity
sketches, which bound the overlap from above. A component proposes its likeliest pairs
that have not been refused, a few in the first round and more in later ones, until none is
left; after each round components are found anew, so a large group of near copies is one
after a round or two. Which shingles are common comes
from counting every shingle of every document; the order is right whatever it holds, so it
is kept as a bitmap of fixed size, which is all that is broadcast.

Verification. For each set with candidates the shingle lists over them are searched for
members with the required overlap: short lists merged with a heap, long ones probed.

Texts are cut into shingles twice: once for sets, sketches and counts, and once, when it
is known which shingles are common, for the lists.

Defined results: ASCII letters are lower-cased, no others; with one to three words the
whole sequence is the only shingle; null, empty or blank texts have no shingle, link with
nothing and are their own component; a null doc_id never represents a component (it takes
that of its class, null if the class has no id), but links through it count; repeated rows link with each other; very long texts are whole sets; ties
in size are ordered by the set's hash; extra columns are ignored; an empty table gives an
empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import nlargest

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import durable, gram_hashes, map_rows, mixed, worker_cache
from .components import components
from .divide_skip import divide_skip

WORDS = 4
PERCENT = 85
# A list with more sets than this is long.
SHORT_LIST = 12
# A shingle in more documents than this is common, unless that would fill the bitmap.
COMMON = 24
BITMAP_BITS = 24
# Bits of a sketch that tells from below how much two sets differ.
SKETCH_BITS = 1024
# Members compared in one task: of a list's smaller components, and of the whole list.
TILE, BLOCK = 512, 16_384
# Shingles a worker counts before it passes them on.
HELD_SHINGLES = 1_000_000
# Ranges of hashes for each partition they are counted in, one range at a time.
RANGES_EACH = 4
# Rows of a batch that are turned into Python objects at once.
SLICE_ROWS = 1024
# Sketches compared at once.
CHUNK = 512
# How many pairs a component proposes in the first round, and how many times more from round to round.
FIRST, STEP = 4, 64
# Rows up to which a side may be broadcast: 24 bytes each make 12 MB.
BROADCAST_ROWS = 500_000



# A word's hash is a polynomial in its bytes, so that all words of a text come from one running sum.
_BASE = 0x9E3779B97F4A7C15
# Bytes summed up at once, unless a single word is longer.
PIECE = 1 << 17
_LOWER = np.array([b + 32 if ord("A") <= b <= ord("Z") else b for b in range(256)], dtype=np.uint8)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


@lru_cache(maxsize=2)
def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base, and of its inverse among numbers of 64 bits."""
    return tuple(
        np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(count, x, dtype=np.uint64)]))
        for x in (_BASE, pow(_BASE, -1, 1 << 64))
    )


def _hashed_words(content: np.ndarray) -> np.ndarray:
    """The hash of every word of a piece of text, in order."""
    blank = np.ones(len(content) + 2, dtype=bool)
    blank[1:-1] = _BLANK[content]
    edges = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edges[::2], edges[1::2]
    powers, inverse = _powers(max(PIECE, len(content)))
    total = np.zeros(len(content) + 1, dtype=np.uint64)
    np.cumsum((content + np.uint64(1)) * powers[: len(content)], out=total[1:])
    lengths = (ends - starts).astype(np.uint64)
    return mixed((total[ends] - total[starts]) * inverse[starts] + lengths * np.uint64(0xC2B2AE3D27D4EB4F))


def word_hashes(content: np.ndarray) -> np.ndarray:
    """The hash of every word of a text; a long text is summed up in pieces, cut at blanks."""
    if len(content) <= PIECE:
        return _hashed_words(content)
    blanks = np.flatnonzero(_BLANK[content])
    found, at = [], 0
    while at < len(content):
        end = len(content)
        if end - at > PIECE:
            before = np.searchsorted(blanks, at + PIECE)
            if before and blanks[before - 1] > at:
                end = int(blanks[before - 1])
            elif before < len(blanks):
                end = int(blanks[before])
        found.append(_hashed_words(content[at:end]))
        at = end
    return np.concatenate(found)


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct numbers, sorted."""
    values = np.sort(values)
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return values[new]


def shingles(text: str | None) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    content = _LOWER[np.frombuffer((text or "").encode(), dtype=np.uint8)]
    hashes = word_hashes(content)
    if not len(hashes):
        return np.empty(0, dtype=np.uint64)
    if len(hashes) < WORDS:
        words = content.tobytes().split()
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], dtype=np.uint64)
    return distinct(gram_hashes(hashes, WORDS))


def sketch(own: np.ndarray) -> bytes:
    """For each of SKETCH_BITS parts of all hashes, whether an odd number of the set's lie in it.

    Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    parts = (own >> np.uint64(20)).astype(np.int64) % SKETCH_BITS
    return np.packbits((np.bincount(parts, minlength=SKETCH_BITS) & 1).astype(bool)).tobytes()


def prefix_length(size: int) -> int:
    """Of two linked sets, this many shingles of each, first in a common order, share one."""
    return size - -(-PERCENT * size // 100) + 1


def linked(common: int, left: int, right: int) -> bool:
    return 100 * common >= PERCENT * (left + right - common)


def required(left: int, right: int) -> int:
    """Least overlap with which sets of these sizes link."""
    return -(-PERCENT * (left + right) // (100 + PERCENT))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _packed(values: np.ndarray) -> bytes:
    """Sorted numbers as differences, in four bytes each where they fit."""
    steps = np.diff(values, prepend=np.uint64(0))
    if not len(steps) or steps[1:].max(initial=0) >> np.uint64(32):
        return b"8" + steps.astype("<u8").tobytes()
    return b"4" + values[:1].astype("<u8").tobytes() + steps[1:].astype("<u4").tobytes()


def _unpacked(blob: bytes) -> np.ndarray:
    if blob[:1] == b"8":
        return np.cumsum(np.frombuffer(blob, dtype="<u8", offset=1), dtype=np.uint64)
    steps = np.frombuffer(blob, dtype="<u4", offset=9)
    return np.cumsum(np.concatenate([np.frombuffer(blob, dtype="<u8", count=1, offset=1), steps]), dtype=np.uint64)


_SETS = ("doc_id", "fp", "n_shingles", "sid", "sketch")
_COUNTS = ("range", "shingles", "counts")


def _sets_and_counts(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From one pass over the texts, written: a row for each document, and packed counts of shingles.

    Documents: doc_id, text fingerprint, number of shingles, hash and sketch of the set
    (null: no shingle). Counts: each batch's shingles by range, one of many equal parts of all hashes.
    """
    ranges = RANGES_EACH * _partitions(rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("shingles", dict)  # nothing is kept here, and what the operator before kept goes
        edges = np.array([(i << 48) // ranges for i in range(1, ranges)], dtype=np.uint64)

        def counted(held):
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = [0, *np.searchsorted(values, edges).tolist(), len(values)]
            parts = [(i, a, b) for i, (a, b) in enumerate(zip(cuts, cuts[1:])) if a < b]
            out = {name: [None] * len(parts) for name in _SETS}
            out["range"] = [i for i, _, _ in parts]
            out["shingles"] = [_packed(values[a:b]) for _, a, b in parts]
            out["counts"] = [zlib.compress(counts[a:b].astype("<u4").tobytes(), 1) for _, a, b in parts]
            return pa.RecordBatch.from_pydict(out, schema=fields)

        held, size = [], 0
        for batch in _slices(batches):
            sets = []
            for text in batch.column(2).to_pylist():
                own = shingles(text)
                if len(own):
                    sets.append((len(own), xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63), sketch(own)))
                    held.append(own >> np.uint64(16))
                    size += len(own)
                else:
                    sets.append((0, None, None))
                if size >= HELD_SHINGLES:
                    yield counted(held)
                    held, size = [], 0
            out = dict(zip(("n_shingles", "sid", "sketch"), zip(*sets) if sets else ((), (), ())))
            out |= {"doc_id": batch.column(0), "fp": batch.column(1)}
            out |= {name: [None] * batch.num_rows for name in _COUNTS}
            yield pa.RecordBatch.from_pydict(out, schema=fields)
        if size:
            yield counted(held)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    fields = pa.schema(list(zip((*_SETS, *_COUNTS), kinds)))
    schema = (
        "doc_id bigint, fp bigint, n_shingles bigint, sid bigint, sketch binary, "
        "range int, shingles binary, counts binary"
    )
    written = durable(rows.select("doc_id", "fp", "text").mapInArrow(work, schema), "sets-and-counts")
    return (
        written.where("range IS NULL").select(*_SETS),
        written.where("range IS NOT NULL").select(*_COUNTS),
    )


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(start, SLICE_ROWS)


def _partitions(rows: DataFrame) -> int:
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())


def _often(values: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    """Of the counts of one range, the shingles that many documents hold: place in the bitmap, and how common."""
    # Shingles have 48 bits; a count takes the other 16, sums may be larger.
    rows = np.concatenate(values)
    rows <<= np.uint64(16)
    rows |= np.minimum(np.concatenate(counts), 0xFFFF).astype(np.uint64)
    rows.sort()
    held = rows >> np.uint64(16)
    starts = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
    rows &= np.uint64(0xFFFF)
    total = np.add.reduceat(rows.view(np.int64), starts)
    often = total > COMMON
    places = (held[starts[often]] >> np.uint64(48 - BITMAP_BITS)).astype(np.int64)
    level = np.log2(total[often] / COMMON).astype(np.int32)
    return pa.RecordBatch.from_pydict(
        {"place": places, "level": level}, schema=pa.schema([("place", pa.int64()), ("level", pa.int32())])
    )


def count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts sorted by range, added up. A task may have several ranges, of which one is held at a time."""
    current, values, counts = None, [], []
    for batch in batches:
        for i, own in enumerate(batch.column(0).to_pylist()):
            if own != current and values:
                yield _often(values, counts)
                values, counts = [], []
            current = own
            values.append(_unpacked(batch.column(1)[i].as_py()))
            counts.append(np.frombuffer(zlib.decompress(batch.column(2)[i].as_py()), dtype="<u4"))
    if values:
        yield _often(values, counts)


def common_shingles(packed: DataFrame, partitions: int) -> np.ndarray:
    """A bitmap of the shingles that many documents hold, by the first BITMAP_BITS bits of their hash.

    The counts of a range come together in one task, as a partition of any other shuffle.
    """
    often = durable(
        packed.repartition(partitions, "range")
        .sortWithinPartitions("range")
        .mapInArrow(count_ranges, "place bigint, level int"),
        "common-shingles",
    )
    # Raise the bar by powers of two until the bitmap is at most an eighth full.
    level, held = 0, 0
    for row in sorted(often.groupBy("level").count().collect(), key=lambda r: -r["level"]):
        held += row["count"]
        if held > 1 << (BITMAP_BITS - 3):
            level = row["level"] + 1
            break
    words = (
        often.where(F.col("level") >= level)
        .groupBy(F.shiftright("place", 5).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(place % 32 AS int))")).alias("bits"))
    )
    bitmap = np.zeros(1 << (BITMAP_BITS - 5), dtype="<u4")
    for row in words.toLocalIterator():  # at most the bitmap itself: 2 MB
        bitmap[row["word"]] = row["bits"]
    return np.unpackbits(bitmap.view(np.uint8), bitorder="little").astype(bool)


def _listed(rows: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """One row for each set and prefix shingle: shingle, size of the set, its hash."""
    shared = rows.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def per_batch(texts):
        common = np.unpackbits(shared.value).astype(bool)
        sids, sizes, prefixes, seen = [], [], [], set()
        for text in texts:
            own = shingles(text)
            if not len(own):
                continue
            sid = xxhash.xxh3_64_intdigest(own.tobytes()) - (1 << 63)
            if sid in seen:
                continue
            seen.add(sid)
            late = common[(own >> np.uint64(64 - BITMAP_BITS)).astype(np.int64)]
            order = np.concatenate([own[~late], own[late]])
            sids.append(sid)
            sizes.append(len(own))
            prefixes.append(order[: prefix_length(len(own))].view(np.int64))
        return {"sid": sids, "size": sizes, "prefix": prefixes}

    fields = pa.schema([("sid", pa.int64()), ("size", pa.int32()), ("prefix", pa.list_(pa.int64()))])
    lists = map_rows(rows, ["text"], "sid bigint, size int, prefix array<bigint>", fields, per_batch)
    return lists.select(F.explode("prefix").alias("shingle"), "size", "sid")


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The distinct rows (shingle, size, sid) of a sorted stream whose shingle has more than one.

    Most shingles are one set's alone; their rows are dropped by whole columns. The last
    row of a batch waits for the next batch, and with it whether its shingle came before it.
    """
    waiting, before = [np.empty(0, dtype=np.int64)] * 3, False
    for batch in batches:
        own = [batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3)]
        own = [np.concatenate(pair) for pair in zip(waiting, own)]
        new = np.ones(len(own[0]), dtype=bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in own])
        own = [c[new] for c in own]
        if not len(own[0]):
            continue
        shingle = own[0]
        same = shingle[1:] == shingle[:-1]
        several = np.concatenate([[before], same]) | np.concatenate([same, [False]])
        waiting, before = [c[-1:] for c in own], bool(several[-1])
        yield from zip(*[c[:-1][several[:-1]].tolist() for c in own])
    if before:
        yield tuple(int(c[0]) for c in waiting)


_PAIRS = pa.schema([("x", pa.int64()), ("y", pa.int64()), ("shingle", pa.int64()), ("size", pa.int32())])


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sorted lists: candidate pairs (x, y), and members of long lists (y null)."""
    out, seen = [], set()

    def flush():
        return pa.RecordBatch.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(zip(*out), _PAIRS)] if out else [pa.array([], type=f.type) for f in _PAIRS],
            schema=_PAIRS,
        )

    def pair(x, y):
        if (x, y) not in seen:
            if len(seen) > 200_000:
                seen.clear()
            seen.add((x, y))
            out.append((x, y, None, None))

    # A list is held until it turns out to be long; from then on its members pass by one at a time.
    current, members, leader = None, [], (0, 0)
    for shingle, size, sid in _shared(batches):
        if shingle != current:
            current, members = shingle, []
        if members is not None and len(members) < SHORT_LIST:
            for smaller, other in members:
                if 100 * smaller >= PERCENT * size:
                    pair(sid, other)
            members.append((size, sid))
        else:
            if members is not None:
                out.extend((other, None, shingle, smaller) for smaller, other in members)
                leader, members = members[0], None
            if 100 * leader[0] >= PERCENT * size:
                pair(sid, leader[1])
            else:
                leader = (size, sid)
            out.append((sid, None, shingle, size))
        if len(out) >= 50_000:
            yield flush()
            out.clear()
    yield flush()


_CELL = ("shingle", "tile", "block", "member", "size", "sid", "component", "sketch", "refused")


def _cells(long_lists: DataFrame, labels: DataFrame, sketches: DataFrame, refused: DataFrame | None) -> DataFrame:
    """Rows of the long lists that hold several components, dealt out to cells.

    A cell compares a tile of the members outside the list's largest component with a block
    of all its members, whatever the list's length: a row goes to each cell of its tile or block.
    """
    placed = durable(
        long_lists.join(labels, F.col("sid") == F.col("node"), "left").select(
            "shingle", "size", "sid", F.coalesce("component", "sid").alias("component")
        ),
        "long-lists",
    )
    shares = placed.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("_n"))
    lists = shares.groupBy("shingle").agg(
        F.sum("_n").alias("_all"), F.max("_n").alias("_most"), F.max_by("component", "_n").alias("_major")
    )
    lists = durable(lists.where("_all > _most"), "mixed-lists")
    mixed = placed.join(_bounded(lists, lists.count()), "shingle").join(sketches, "sid")
    tiles = F.ceil((F.col("_all") - F.col("_most")) / TILE)
    blocks = F.ceil(F.col("_all") / BLOCK)
    spread = F.xxhash64("sid", F.lit(3))
    minor = mixed.where("component <> _major")
    if refused is not None:
        known = refused.groupBy("x").agg(F.collect_set("y").alias("refused"))
        minor = minor.join(known, F.col("sid") == F.col("x"), "left").drop("x")
    else:
        minor = minor.withColumn("refused", F.lit(None).cast("array<bigint>"))
    queries = minor.select(
        "shingle",
        F.pmod(spread, tiles).alias("tile"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1)).alias("block"),
        F.lit(False).alias("member"),
        *_CELL[4:],
    )
    members = mixed.select(
        "shingle",
        F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1)).alias("tile"),
        F.pmod(spread, blocks).alias("block"),
        F.lit(True).alias("member"),
        *_CELL[4:-1],
        F.lit(None).cast("array<bigint>").alias("refused"),
    )
    return queries.unionByName(members)


def _between_components(cells: DataFrame, most: int) -> DataFrame:
    """Of each cell, the likeliest pairs of members of different components, ``most`` for each smaller component."""
    fields = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def compared(queries, members, found):
        """Adds to ``found`` what the sketches allow: (differences to spare, query, member) by component."""
        sizes, sids, own, sketches, refused = queries
        m_sizes, m_sids, m_own = (np.array(c, dtype=np.int64) for c in zip(*[m[:3] for m in members]))
        m_sketches = np.frombuffer(b"".join(m[3] for m in members), dtype=np.uint64).reshape(len(members), -1)
        for i in range(len(sizes)):
            both = sizes[i] + m_sizes
            near = np.flatnonzero(
                (m_own != own[i]) & (100 * np.minimum(sizes[i], m_sizes) >= PERCENT * np.maximum(sizes[i], m_sizes))
            )
            if not len(near):
                continue
            differ = np.bitwise_count(m_sketches[near] ^ sketches[i]).sum(axis=1, dtype=np.int64)
            spare = both[near] - 2 * -(-PERCENT * both[near] // (100 + PERCENT)) - differ
            for k in np.flatnonzero(spare >= 0).tolist():
                if (y := int(m_sids[near[k]])) not in refused[i]:
                    found.setdefault(own[i], []).append((int(spare[k]), int(sids[i]), y))

    def chosen(found):
        pairs = {(x, y) for own in found.values() for _, x, y in nlargest(most, own)}
        return pa.RecordBatch.from_pydict({"x": [x for x, _ in pairs], "y": [y for _, y in pairs]}, schema=fields)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held, queries, members, found = None, [], None, [], {}
        for batch in batches:
            for row in zip(*[batch.column(i).to_pylist() for i in range(len(_CELL))]):
                if row[:3] != cell:
                    if members:
                        compared(queries, members, found)
                    if found:
                        yield chosen(found)
                    cell, held, queries, members, found = row[:3], [], None, [], {}
                if not row[3]:
                    held.append(row[4:])
                    continue
                if queries is None:  # a cell's queries come before its members
                    if not held:
                        continue
                    sizes, sids, own, sketches, refused = zip(*held)
                    queries = (sizes, sids, own, [np.frombuffer(k, dtype=np.uint64) for k in sketches], [set(r or ()) for r in refused])
                members.append(row[4:8])
                if len(members) == CHUNK:
                    compared(queries, members, found)
                    members = []
                    # Only the likeliest can be chosen.
                    found = {c: nlargest(most, own) if len(own) > 4 * most else own for c, own in found.items()}
        if members:
            compared(queries, members, found)
        if found:
            yield chosen(found)

    return (
        cells.select(*_CELL)
        .repartition("shingle", "tile", "block")
        .sortWithinPartitions("shingle", "tile", "block", "member")
        .mapInArrow(work, "x bigint, y bigint")
        .select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y"))
        .distinct()
    )


def _possible(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The distinct pairs whose sketches allow a link."""
    own = classes.select("sid", "n_shingles", "sketch")
    both = (
        pairs.select("x", "y")
        .distinct()
        .join(own.toDF("y", "ny", "ky"), "y")
        .join(own.toDF("x", "nx", "kx"), "x")
        .select("x", "y", "nx", "ny", "kx", "ky")
    )
    fields = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def per_batch(xs, ys, nx, ny, kx, ky):
        if not xs:
            return {"x": [], "y": []}
        left, right = (np.frombuffer(b"".join(k), dtype=np.uint64).reshape(len(xs), -1) for k in (kx, ky))
        differ = np.bitwise_count(left ^ right).sum(axis=1, dtype=np.int64)
        total = np.array(nx) + np.array(ny)
        keep = np.flatnonzero(differ <= total - 2 * required(total, 0))
        return {"x": np.array(xs)[keep], "y": np.array(ys)[keep]}

    return map_rows(both, ["x", "y", "nx", "ny", "kx", "ky"], "x bigint, y bigint", fields, per_batch)


def _verified(pairs: DataFrame, classes: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (x, y) whose sets link, as (a, b)."""
    needed = pairs.select(F.col("x").alias("sid")).union(pairs.select(F.col("y").alias("sid"))).distinct()
    members = needed.join(classes, "sid").select("sid", F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
    held = _bounded(members, 2 * pairs.count())
    same = rows["doc_id"].eqNullSafe(held["_id"]) & rows["fp"].eqNullSafe(held["_fp"])
    # Rows that repeat id and text are one: a set a class.
    texts = rows.join(held, same).groupBy("sid").agg(F.first("text").alias("text"))

    def per_batch(sids, contents):
        return {"sid": sids, "set": [_packed(shingles(t)) for t in contents]}

    fields = pa.schema([("sid", pa.int64()), ("set", pa.binary())])
    sets = durable(map_rows(texts, ["sid", "text"], "sid bigint, set binary", fields, per_batch), "candidate-sets")
    queries = (
        pairs.join(sets.select(F.col("sid").alias("y"), F.col("set").alias("ys")), "y")
        .join(sets.select(F.col("sid").alias("x"), F.col("set").alias("xs")), "x")
        .select("x", "y", "xs", "ys")
        .sortWithinPartitions("x")
    )
    links = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def search(x: int, query: np.ndarray, others: list[tuple[int, np.ndarray]]) -> list[tuple[int, int]]:
        """One query: the lists of its shingles over its candidates, searched for the required overlap."""
        lists: list[list[int]] = [[] for _ in query]
        for number, (_, own) in enumerate(others):
            places = np.searchsorted(query, own)
            places[places == len(query)] = 0
            for place in places[query[places] == own].tolist():
                lists[place].append(number)
        least = min(required(len(query), len(own)) for _, own in others)
        found = divide_skip(lists, least)
        return [(x, others[n][0]) for n, c in found.items() if linked(c, len(query), len(others[n][1]))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, query, others = None, None, []
        for batch in _slices(batches):
            found = []
            for x, y, xs, ys in zip(*[batch.column(i).to_pylist() for i in range(4)]):
                if x != current or len(others) >= 64:
                    if others:
                        found += search(current, query, others)
                    current, query, others = x, _unpacked(xs), []
                others.append((y, _unpacked(ys)))
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=links)
        if others:
            found = search(current, query, others)
            yield pa.RecordBatch.from_pydict({"a": [a for a, _ in found], "b": [b for _, b in found]}, schema=links)

    return durable(queries.mapInArrow(work, "a bigint, b bigint"), "links")


def _renamed(labels: DataFrame, links: DataFrame, merged: DataFrame) -> DataFrame:
    """The components of all sets that are linked by now: ``labels`` and new ``links``, components of whose are ``merged``."""
    ends = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    known = ends.join(labels, "node", "left_anti").select("node", F.col("node").alias("component")).union(labels)
    renamed = known.join(merged.toDF("component", "_merged"), "component", "left")
    return durable(renamed.select("node", F.coalesce("_merged", "component").alias("component")), "labels")


def jaccard_components(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint of its text, n_shingles, component_id (smallest doc_id that links reach)."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("fp"), F.col(text).alias("text")
    )
    sets, packed = _sets_and_counts(rows)
    classes = durable(
        sets.where("sid IS NOT NULL")
        .groupBy("sid")
        .agg(
            F.min_by(F.struct("doc_id", "fp"), F.struct(F.col("doc_id").isNull(), "doc_id", "fp")).alias("m"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        )
        .select("sid", "m.doc_id", "m.fp", "n_shingles", "sketch"),
        "classes",
    )
    bitmap = common_shingles(packed, _partitions(rows))
    listed = _listed(rows, bitmap).repartition("shingle").sortWithinPartitions("shingle", "size", "sid")
    candidates = durable(
        listed.mapInArrow(_candidates, "x bigint, y bigint, shingle bigint, size int"), "candidates"
    )
    possible = durable(_possible(candidates.where("y IS NOT NULL"), classes), "candidate-pairs")
    links = _verified(possible, classes, rows)
    first = components(links)
    # Long lists again, those that still hold members of different components, until
    # no pair of these is left that might link.
    long_lists = candidates.where("y IS NULL").select("shingle", "size", F.col("x").alias("sid"))
    sketches, refused, most = classes.select("sid", "sketch"), None, FIRST
    while True:
        more = durable(_between_components(_cells(long_lists, first, sketches, refused), most), "more-candidates")
        if more.isEmpty():
            break
        found = _verified(more, classes, rows)
        failed = more.join(found, (F.col("x") == F.col("a")) & (F.col("y") == F.col("b")), "left_anti")
        # Either member of a refused pair may be the one to propose it again.
        failed = failed.union(failed.select(F.col("y").alias("x"), F.col("x").alias("y")))
        refused = failed if refused is None else refused.union(failed)
        if not found.isEmpty():
            # Components of components: only the new links are followed.
            named = found.join(first.toDF("a", "_a"), "a", "left").join(first.toDF("b", "_b"), "b", "left")
            merged = components(named.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b")))
            first = _renamed(first, found, merged)
        most *= STEP
    joined = durable(
        classes.join(first, F.col("sid") == F.col("node"), "left").select(
            "sid", F.col("doc_id").alias("_class_id"), F.coalesce("component", "sid").alias("component")
        ),
        "class-components",
    )
    smallest = joined.groupBy("component").agg(F.min("_class_id").alias("_least"))
    named = durable(joined.join(smallest, "component").select("sid", "_least"), "component-ids")
    return sets.join(named, "sid", "left").select(
        "doc_id",
        "fp",
        "n_shingles",
        F.when(F.col("sid").isNull(), F.col("doc_id")).otherwise(F.col("_least")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that represent their component, all columns kept.

    Rows that repeat both id and text are one document and stay or go together; a row
    without an id stays where no linked row has one.
    """
    found = jaccard_components(docs, key, text)
    kept = durable(
        found.where(F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))
        .select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
        .distinct(),
        "representatives",
    )
    same = docs[key].cast("bigint").eqNullSafe(kept["_id"]) & F.xxhash64(docs[text]).eqNullSafe(kept["_fp"])
    return docs.join(kept, same, "left_semi")
