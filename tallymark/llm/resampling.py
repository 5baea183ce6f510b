"""Importance resampling of documents towards the distribution of a target, with Arrow kernels.

A text is lower-cased (A-Z only) and split at ASCII characters other than letters and digits.
Its features are all runs of one to three consecutive words, repeats counted, hashed by the
CRC-32 of their UTF-8 bytes into BUCKETS buckets. A bucket's gain is the log ratio of its
smoothed shares in the target and in the documents, and a document's weight is the sum of
its features' gains. Gumbel noise from a hash of the id turns the largest scores into a
sample without replacement that favours documents like the target.

Per batch ``ascii_lower``, ``split_pattern_regex``, ``list_flatten`` and
``dictionary_encode`` make numbers of words; runs are pairs of shifted numbers, encoded
again so that each distinct run is hashed once, from the checksum of its beginning and that
of its last word; gains are taken by bucket and summed over each document's segment.

Only bucket counts (BUCKETS numbers a task) reach the driver. The ranking is a range-partitioned
sort of narrow rows; a partition's offset is the number of rows in the partitions before it.

Defined results: a null or empty text has no feature and weight 0; a null id counts as empty in
the noise and comes last among ties; rows that repeat an id are documents of their own, and
rows alike in everything are drawn in any order; texts longer than PIECE characters are worked
off in pieces, with equal results; with an empty target every document still gets its
weight; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import durable

BUCKETS = 10_000
LONGEST_RUN = 3
PERCENT = 5
MIN_WORDS = 20
SEED = 42
# Characters of text worked on at once.
PIECE = 4_000_000
# Bytes up to which the checksum of a word is appended by table.
SHORT_WORD = 48

# What stands between words: ASCII characters that are neither letters nor digits.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _zero_byte_steps() -> np.ndarray:
    """What one zero byte more makes of a checksum, by the checksum's lowest byte."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


def _append_tables() -> np.ndarray:
    """[length, byte of the checksum, its value] -> what it becomes when ``length`` zero bytes follow.

    A checksum is linear in its bits, so that of ``ab`` is the sum (exclusive or) of what
    the four bytes of a's become after len(b) zero bytes, and of b's own checksum.
    """
    step = _zero_byte_steps()
    now = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], dtype=np.uint32)
    tables = [now]
    for _ in range(SHORT_WORD + 1):
        now = step[now & 0xFF] ^ (now >> np.uint32(8))
        tables.append(now)
    return np.stack(tables)


_APPEND = _append_tables()


class _Words:
    """The distinct words of a batch with their checksums, alone and behind a space."""

    def __init__(self, dictionary: pa.Array):
        self.bytes = dictionary.cast(pa.binary()).to_pylist()
        count = len(self.bytes)
        self.alone = np.fromiter(map(zlib.crc32, self.bytes), np.uint32, count)
        self.spaced = np.fromiter((zlib.crc32(b" " + w) for w in self.bytes), np.uint32, count)
        self.length = np.fromiter(map(len, self.bytes), np.int64, count) + 1

    def appended(self, checksums: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Checksums of runs, from those of what stands before the last word and the last word's number."""
        length = self.length[words]
        short = np.minimum(length, SHORT_WORD + 1)
        out = self.spaced[words]
        for byte in range(4):
            out = out ^ _APPEND[short, byte, (checksums >> np.uint32(8 * byte)) & np.uint32(0xFF)]
        for i in np.flatnonzero(length > SHORT_WORD + 1).tolist():
            out[i] = zlib.crc32(b" " + self.bytes[words[i]], int(checksums[i]))
        return out


def _distinct(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    encoded = pa.array(numbers).dictionary_encode()
    return encoded.dictionary.to_numpy(), encoded.indices.to_numpy()


def _features(texts: pa.Array, carried: np.ndarray) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Of each text its number of words, and for each length of run (text, bucket) of every run.

    The first ``carried`` words of a text belong to the piece before it: runs that end in
    one of them, and they themselves, have been counted there.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=BETWEEN)
    flat, owners = pc.list_flatten(lists), pc.list_parent_indices(lists)
    words = pc.not_equal(flat, "")  # a separator at either end leaves an empty string
    flat, owners = flat.filter(words), owners.filter(words).to_numpy().astype(np.int64)
    encoded = flat.dictionary_encode()
    numbers, known = encoded.indices.to_numpy().astype(np.int64), _Words(encoded.dictionary)
    starts = np.searchsorted(owners, np.arange(len(texts)))
    place = np.arange(len(owners)) - starts[owners]
    new = place >= carried[owners]

    checksums, runs = known.alone, numbers
    out = [(owners[new], (known.alone % np.uint32(BUCKETS)).astype(np.int64)[numbers][new])]
    for size in range(2, LONGEST_RUN + 1):
        # A run one word longer: the number of the run that starts here, and of the word after it.
        last = np.arange(size - 1, len(numbers))
        whole = owners[last] == owners[last - size + 1] if len(last) else np.empty(0, dtype=bool)
        longer = np.full(len(numbers), -1, dtype=np.int64)
        last = last[whole]
        pairs, index = _distinct(runs[last - size + 1] << 32 | numbers[last])
        checksums = known.appended(checksums[pairs >> 32], pairs & 0xFFFFFFFF)
        longer[last - size + 1] = index
        runs = longer
        fresh = new[last]
        buckets = (checksums % np.uint32(BUCKETS)).astype(np.int64)[index]
        out.append((owners[last][fresh], buckets[fresh]))
    return np.bincount(owners[new], minlength=len(texts)), out


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str], list[int]]]:
    """Groups of about PIECE characters: numbers of the texts, the texts, and how many words each carries over.

    A longer text is cut between words, and its last words go in front of its next piece.
    """
    numbers, group, carried, size = [], [], [], 0
    for number, text in enumerate(texts):
        text, at, before = text or "", 0, []
        while True:
            end = len(text)
            if end - at > PIECE:
                cut = _BETWEEN.search(text, at + PIECE)
                end = cut.end() if cut else end
            part = text[at:end]
            numbers.append(number)
            group.append(" ".join([*before, part]) if before else part)
            carried.append(len(before))
            size += len(part)
            at = end
            if size >= PIECE:
                yield numbers, group, carried
                numbers, group, carried, size = [], [], [], 0
            if at >= len(text):
                break
            before = (before + [w for w in _BETWEEN.split(part) if w])[1 - LONGEST_RUN :]
    if group:
        yield numbers, group, carried


def _worked_off(texts: Sequence[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, list]]:
    for numbers, group, carried in _pieces(texts):
        counts, features = _features(pa.array(group, type=pa.string()), np.array(carried))
        yield np.array(numbers), counts, features


def bucket_counts(docs: DataFrame, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for _, _, features in _worked_off(batch.column(0).to_pylist()):
                for _, buckets in features:
                    total += np.bincount(buckets, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": held, "n": total[held]}, schema=fields)

    fields = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
    counted = docs.select(text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for row in counted.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket the floor of 1000 times the log ratio of its smoothed shares, target over documents."""
    s, t = documents.astype(float), target.astype(float)
    ratio = ((t + 1) * (s.sum() + BUCKETS)) / ((s + 1) * (t.sum() + BUCKETS))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def weighted(docs: DataFrame, own: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint of the text, n_words, n_features and weight, the sum of gains over its features."""
    shared = docs.sparkSession.sparkContext.broadcast(own)  # BUCKETS numbers

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, dtype=np.int64) for _ in range(3))
            for numbers, counts, features in _worked_off(batch.column(2).to_pylist()):
                np.add.at(n_words, numbers, counts)
                for owners, buckets in features:
                    # Each text's runs are consecutive: its sum is a difference of running sums.
                    running = np.concatenate([[0], np.cumsum(gain.take(buckets))])
                    edges = np.searchsorted(owners, np.arange(len(numbers) + 1))
                    np.add.at(n_features, numbers, np.diff(edges))
                    np.add.at(weight, numbers, np.diff(running[edges]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, (n_words, n_features, weight))], schema=fields
            )

    fields = pa.schema([(n, pa.int64()) for n in ("doc_id", "fp", "n_words", "n_features", "weight")])
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("fp"), F.col(text).alias("text"))
    return rows.mapInArrow(weigh, "doc_id bigint, fp bigint, n_words bigint, n_features bigint, weight bigint")


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, from the first 32 bits of a hash."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def ranked(
    docs: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    seed: int = SEED,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: doc_id, fp, n_features, weight, score and rank (null: not drawn).

    ``percent`` of the documents with at least ``min_words`` words are drawn.
    """
    spark = docs.sparkSession
    own = gains(bucket_counts(docs, text), bucket_counts(target, text))
    scored = durable(weighted(docs, own, key, text).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scored")
    fit = F.col("n_words") >= min_words
    drawn = percent * scored.where(fit).count() // 100
    # Documents that may be drawn come first, so that a row's place is its rank. The last
    # columns tell repeated rows apart, which would all go to one range otherwise.
    placed = durable(
        scored.withColumn("_row", F.monotonically_increasing_id())
        .orderBy(fit.desc(), F.desc("score"), F.asc_nulls_last("doc_id"), "fp", "_row")
        .withColumns(
            {
                "_part": F.spark_partition_id(),
                "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
            }
        )
        .drop("_row"),
        "placed",
    )
    # One row for each partition of the sort.
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("_part"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.col("_offset") + F.col("_place") + 1
    return placed.join(F.broadcast(offsets), "_part").select(
        "doc_id",
        "fp",
        "n_features",
        "weight",
        "score",
        F.when(rank <= drawn, rank).cast("bigint").alias("rank"),
    )


def resampled(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The drawn rows of ``docs``, all columns kept; ``settings`` as for ``ranked``.

    Rows that repeat both id and text are told apart by nothing and come along together.
    """
    drawn = (
        ranked(docs, target, key=key, text=text, **settings)
        .where("rank IS NOT NULL")
        .select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"))
        .distinct()
    )
    same = docs[key].cast("bigint").eqNullSafe(drawn["_id"]) & (F.xxhash64(docs[text]) == drawn["_fp"])
    return docs.join(drawn, same, "left_semi")
