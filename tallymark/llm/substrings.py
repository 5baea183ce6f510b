"""Substring dedup by seed and extend: winnowed anchors are joined, matches extended around them.

A window is ``length`` consecutive words. Its anchor is its least hash among the runs of
ANCHOR_WORDS words in it, so equal windows have equal anchors at equal places: that is
winnowing, and no match of ``length`` words is without a seed. Texts are joined on anchors;
around each anchor that another text has as well, the match is extended to the left and
right, a word at a time, as far as windows go that have this anchor. Each window's earliest
holder is the least id with its hash; windows that follow one another in a text and in
the same holder make a maximal repeat, and a repeat is at least ``length`` words long.

A repeat's words are then compared with its holder's, word by word. Where they differ, two
different windows had one hash: all windows of that hash are grouped by their words
instead. A window that starts in a text with a smaller id is removed. Grouping keeps only
the least id, so a passage in a third of all texts is one partial row per task and no pairs of
texts are formed but that of a text and its holder.

Texts of equal words are one class, of which only the smallest id is searched: the others
are removed as a whole when they have a window at all.

Defined results: null text has no words; texts shorter than a window lose nothing; a null
doc_id is smaller than no id and nothing is removed from it; rows with the same id never
remove words from each other; repeated rows are each reported; very long texts are searched
whole; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import WordHashes, durable, gram_hashes, map_rows, worker_cache

LENGTH = 50
ANCHOR_WORDS = 16
# Rows up to which a side may be broadcast: 24 bytes each make 12 MB.
BROADCAST_ROWS = 500_000



def anchors_of(hashes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ANCHOR_WORDS words, and for each window the place of its anchor."""
    size = min(ANCHOR_WORDS, length)
    runs = gram_hashes(hashes, size)
    span = length - size + 1
    if len(runs) < span:
        return runs, np.empty(0, dtype=np.int64)
    least = np.lib.stride_tricks.sliding_window_view(runs, span).argmin(axis=1)
    return runs, least + np.arange(len(least))


def _words(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _seeds(docs: DataFrame, length: int) -> DataFrame:
    """Per row: id, text fingerprint, number of words, digest of the words, distinct anchors."""

    def per_batch(ids, fps, texts):
        n_words, digests, anchors = [], [], []
        for text in texts:
            words = _words(text)
            runs, places = anchors_of(worker_cache("words", WordHashes).of(words), length)
            n_words.append(len(words))
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            anchors.append(np.unique(runs[places]).view(np.int64))
        return {"doc_id": ids, "fp": fps, "n_words": n_words, "digest": digests, "anchors": anchors}

    fields = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("fp", pa.int64()),
            ("n_words", pa.int64()),
            ("digest", pa.string()),
            ("anchors", pa.list_(pa.int64())),
        ]
    )
    schema = "doc_id bigint, fp bigint, n_words bigint, digest string, anchors array<bigint>"
    return map_rows(docs, ["doc_id", "fp", "text"], schema, fields, per_batch)


def _extended(suspects: DataFrame, length: int, hash_bits: int) -> DataFrame:
    """Per text: starts and hashes of the windows around its repeated anchors."""
    mask = np.uint64((1 << hash_bits) - 1)

    def per_batch(ids, fps, texts, anchors):
        starts, windows = [], []
        for text, known in zip(texts, anchors):
            hashes = worker_cache("words", WordHashes).of(_words(text))
            runs, places = anchors_of(hashes, length)
            # Every offset at which a window of this text has a repeated anchor as its own.
            own = np.flatnonzero(np.isin(runs[places], np.array(known, dtype=np.int64).view(np.uint64)))
            starts.append(own.astype(np.int32))
            windows.append((gram_hashes(hashes, length)[own] & mask).view(np.int64))
        return {"doc_id": ids, "fp": fps, "starts": starts, "windows": windows}

    fields = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("fp", pa.int64()),
            ("starts", pa.list_(pa.int32())),
            ("windows", pa.list_(pa.int64())),
        ]
    )
    schema = "doc_id bigint, fp bigint, starts array<int>, windows array<bigint>"
    return map_rows(suspects, ["doc_id", "fp", "text", "anchors"], schema, fields, per_batch)


def _slices(wanted: DataFrame, texts: DataFrame) -> DataFrame:
    """The words of (doc_id, fp, start, n) in their texts, joined by spaces."""

    def per_batch(ids, fps, contents, places):
        out = {name: [] for name in ("doc_id", "fp", "start", "n", "words")}
        for doc_id, fp, text, own in zip(ids, fps, contents, places):
            words = _words(text)
            for place in own:
                start, n = place["start"], place["n"]
                for name, value in zip(out, (doc_id, fp, start, n, b" ".join(words[start : start + n]).decode())):
                    out[name].append(value)
        return out

    by_text = wanted.groupBy("doc_id", "fp").agg(F.collect_set(F.struct("start", "n")).alias("places"))
    rows = texts.join(by_text, ["doc_id", "fp"])
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string()]
    fields = pa.schema(list(zip(("doc_id", "fp", "start", "n", "words"), kinds)))
    schema = "doc_id bigint, fp bigint, start int, n int, words string"
    return map_rows(rows, ["doc_id", "fp", "text", "places"], schema, fields, per_batch)


def _repeats(placed: DataFrame, length: int) -> DataFrame:
    """Maximal repeats: (doc_id, fp, start, n) of a text whose windows are those of (a_doc_id, a_fp) from a_start on."""
    held = placed.groupBy("window").agg(F.min(F.struct("doc_id", "fp", "start")).alias("_a"), F.max("doc_id").alias("_last"))
    held = durable(held.where("_a.doc_id < _last").select("window", "_a"), "repeated-windows")
    hits = placed.join(held, "window").where("doc_id > _a.doc_id").select(
        "doc_id",
        "fp",
        "start",
        F.col("_a.doc_id").alias("a_doc_id"),
        F.col("_a.fp").alias("a_fp"),
        (F.col("start") - F.col("_a.start")).alias("_shift"),
    )
    # Starts without a gap differ from their rank by one number. A text's own starts are all there is in a window.
    match = ["doc_id", "fp", "a_doc_id", "a_fp", "_shift"]
    rank = F.dense_rank().over(Window.partitionBy(*match).orderBy("start"))
    runs = hits.withColumn("_run", F.col("start") - rank).groupBy(*match, "_run")
    return runs.agg(F.min("start").alias("start"), (F.max("start") - F.min("start") + length).alias("n")).select(
        "doc_id", "fp", "start", "n", "a_doc_id", "a_fp", (F.col("start") - F.col("_shift")).alias("a_start")
    )


def _compared(repeats: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Per text: starts of the windows of repeats whose words are the holder's, and of those whose words are not."""
    holder = ["a_doc_id", "a_fp", "a_start", "n"]
    theirs = _slices(
        repeats.select(F.col("a_doc_id").alias("doc_id"), F.col("a_fp").alias("fp"), F.col("a_start").alias("start"), "n").distinct(),
        texts,
    ).toDF(*holder, "words")
    # The same part of a holder is compared at every place of a text that it may stand at.
    places = repeats.groupBy("doc_id", "fp", *holder).agg(F.collect_set("start").alias("starts"))
    own = places.join(theirs, holder).groupBy("doc_id", "fp").agg(F.collect_list(F.struct("words", "starts")).alias("parts"))
    rows = texts.join(own, ["doc_id", "fp"])

    def per_batch(ids, fps, contents, parts):
        same, different = [], []
        for text, known in zip(contents, parts):
            words, good, bad = _words(text), [], []
            for part in known:
                wanted = part["words"].encode().split()
                for start in part["starts"]:
                    found = good if words[start : start + len(wanted)] == wanted else bad
                    found.extend(range(start, start + len(wanted) - length + 1))
            same.append(sorted(set(good)))
            different.append(sorted(set(bad)))
        return {"doc_id": ids, "fp": fps, "starts": same, "unequal": different}

    fields = pa.schema(
        [("doc_id", pa.int64()), ("fp", pa.int64()), ("starts", pa.list_(pa.int32())), ("unequal", pa.list_(pa.int32()))]
    )
    schema = "doc_id bigint, fp bigint, starts array<int>, unequal array<int>"
    return durable(map_rows(rows, ["doc_id", "fp", "text", "parts"], schema, fields, per_batch), "compared")


def _by_words(placed: DataFrame, unequal: DataFrame, texts: DataFrame, length: int) -> DataFrame:
    """Starts of repeated windows among all those that share a hash with an unequal one, found by their words."""
    hashes = placed.join(unequal, ["doc_id", "fp", "start"]).select("window").distinct()
    doubtful = placed.join(hashes, "window").select("doc_id", "fp", "start", F.lit(length).alias("n"))
    spelt = durable(_slices(doubtful, texts), "spelt-windows")
    first = spelt.groupBy("words").agg(F.min("doc_id").alias("_first"))
    return spelt.join(first, "words").where("doc_id > _first").select("doc_id", "fp", "start")


def covered_words(starts: list[int], n_words: int, length: int) -> np.ndarray:
    """Which words the windows at ``starts`` cover."""
    edges = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(edges, np.array(starts, dtype=np.int64), 1)
    np.add.at(edges, np.array(starts, dtype=np.int64) + length, -1)
    return np.cumsum(edges)[:n_words] > 0


def _without(texts: DataFrame, length: int) -> DataFrame:
    """Per text: how many words its repeated windows cover, digest of the others, and the others."""

    def per_batch(ids, fps, contents, starts):
        n_removed, digests, kept_texts = [], [], []
        for text, own in zip(contents, starts):
            words = _words(text)
            gone = covered_words(own, len(words), length)
            kept = b" ".join([w for w, out in zip(words, gone) if not out])
            n_removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(kept).hexdigest())
            kept_texts.append(kept.decode())
        return {"doc_id": ids, "fp": fps, "n_removed": n_removed, "kept_sha256": digests, "kept": kept_texts}

    fields = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("fp", pa.int64()),
            ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
            ("kept", pa.string()),
        ]
    )
    schema = "doc_id bigint, fp bigint, n_removed bigint, kept_sha256 string, kept string"
    return map_rows(texts, ["doc_id", "fp", "text", "starts"], schema, fields, per_batch)


def repeated_substrings(
    docs: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text", hash_bits: int = 64
) -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256, and ``kept``, the words left of a text that
    lost some (null where it lost none or all). ``hash_bits`` of a window's hash are used; results don't depend on it."""
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("fp"), F.col(text).alias("text"))
    seeds = durable(_seeds(rows, length), "seeds")
    first = durable(seeds.groupBy("digest").agg(F.min("doc_id").alias("_first")), "word-classes")
    searched = seeds.where(f"n_words >= {length}").join(first, "digest").where("doc_id = _first")
    seeded = searched.select("doc_id", "fp", F.explode("anchors").alias("anchor"))
    spread = seeded.groupBy("anchor").agg(F.min("doc_id").alias("_a"), F.max("doc_id").alias("_b"))
    repeated = durable(spread.where("_a < _b").select("anchor"), "repeated-anchors")
    # Broadcast or not, only ids and fingerprints travel; anchors follow by a join on them.
    suspects = durable(
        seeded.join(repeated, "anchor").groupBy("doc_id", "fp").agg(F.collect_set("anchor").alias("anchors")),
        "suspects",
    )
    narrow = _bounded(suspects.select("doc_id", "fp"), suspects.count())
    texts = rows.join(narrow, ["doc_id", "fp"]).groupBy("doc_id", "fp").agg(F.first("text").alias("text"))
    texts = durable(texts, "suspect-texts")

    extended = durable(_extended(texts.join(suspects, ["doc_id", "fp"]), length, hash_bits), "windows")
    placed = extended.select("doc_id", "fp", F.explode(F.arrays_zip("starts", "windows")).alias("w")).select(
        "doc_id", "fp", F.col("w.starts").alias("start"), F.col("w.windows").alias("window")
    )
    repeats = durable(_repeats(placed, length), "repeats")
    compared = _compared(repeats, texts, length)
    starts = compared.where("size(starts) > 0").select("doc_id", "fp", "starts")
    unequal = compared.select("doc_id", "fp", F.explode("unequal").alias("start"))
    if not unequal.isEmpty():
        more = _by_words(placed, unequal, texts, length)
        known = starts.select("doc_id", "fp", F.explode("starts").alias("start"))
        starts = known.union(more).groupBy("doc_id", "fp").agg(F.collect_set("start").alias("starts"))
    removed = durable(_without(texts.join(starts, ["doc_id", "fp"]), length), "removed")
    found = seeds.select("doc_id", "fp", "n_words", "digest").join(first, "digest", "left")
    whole = F.coalesce((F.col("doc_id") > F.col("_first")) & (F.col("n_words") >= length), F.lit(False))
    return found.join(removed, ["doc_id", "fp"], "left").select(
        "doc_id",
        "n_words",
        F.when(whole, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.sha2(F.lit(""), 256))
        .otherwise(F.coalesce("kept_sha256", "digest"))
        .alias("kept_sha256"),
        F.when(~whole, F.col("kept")).alias("kept"),
    )
