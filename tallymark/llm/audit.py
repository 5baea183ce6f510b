"""Audit of how five document filters interact, in every order they could be applied in.

Filters, by letter: A few words, B few distinct words, C many capitals, D special characters,
E text identical to that of a smaller id. What a filter removes depends on those before
it; but whether a document fails a filter does not, so the documents are counted once by the
mask of filters they fail, and all 120 orders are sums over at most 32 masks a part.

Filter E looks at the whole table. A counting Bloom sketch of text hashes comes first:
every task counts the cells its rows fall into, up to two, the sketches are merged by adding, and a
text with a cell of its own is surely unique. Only the other texts are shuffled, whole, for
the smallest id of each (combined before the shuffle, so copies travel once a task). What
comes back is one (id, fingerprint) for each such text; rows among the possible repeats without
it fail E. A group of copies, however large, is never together in a task.

The merged sketch has one bit a cell and CELLS_PER_ROW cells a row, at most 2^MAX_CELL_BITS cells,
which bounds what is collected and broadcast to 32 MB; beyond some 50 million rows a part
of the unique texts is shuffled too, and results stay the same.

Defined results: a null text is empty, so it equals other null and empty texts; a null id is neither smaller
nor larger than any other, so its row never fails E and makes no other fail it; rows that
repeat an id and text are documents of their own and don't make each other fail; several label
rows of an id count as one that has each label any of them has; a document without label
is neither good nor toxic; null and empty source are one part; an empty table has no part and gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_text, durable, map_rows, mixed

FILTERS = "ABCDE"
MIN_WORDS = 50
SYMBOLS = b"#$%&*|"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
# The sketch: cells a row, cells a text falls into, bits of the largest sketch, cells merged in a group.
CELLS_PER_ROW = 8
CELLS_A_TEXT = 3
MAX_CELL_BITS = 28
BLOCK_BITS = 16
# Positions a task holds before it passes its counts on.
HELD_POSITIONS = 3_000_000
# Bytes of a text split into words at once.
PIECE = 8_000_000


def _word_counts(content: bytes) -> tuple[int, int]:
    """Number of words, and of distinct words."""
    if len(content) <= PIECE:
        words = content.split()
        return len(words), len(set(words))
    total, seen, rest = 0, set(), content
    while rest:
        # Up to a word's beginning; a piece without a blank is one word of more than PIECE bytes.
        piece, rest = rest[:PIECE], rest[PIECE:]
        if rest and not rest[:1].isspace() and not piece[-1:].isspace():
            more = rest.split(None, 1)
            piece, rest = piece + more[0], more[1] if len(more) > 1 else b""
        words = piece.split()
        total += len(words)
        seen.update(words)
    return total, len(seen)


def own_failures(text: str) -> int:
    """Mask of the filters A to D that a text fails."""
    content = text.encode()
    words, distinct = _word_counts(content)
    capitals = len(content) - len(content.translate(None, CAPITALS))
    special = len(content.translate(None, SYMBOLS)) < len(content)
    return (words < MIN_WORDS) | (100 * distinct < 65 * words) << 1 | (100 * capitals > 5 * len(text)) << 2 | special << 3


def flagged(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """Per row: doc_id, part, fingerprint of the text, mask of failures A to D."""
    rows = docs.select(
        F.col(key).cast("bigint").alias("doc_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        as_text(text).alias("text"),
    ).withColumn("fp", F.xxhash64("text"))

    def per_batch(ids, parts, fps, texts):
        return {"doc_id": ids, "part": parts, "fp": fps, "mask": [own_failures(t) for t in texts]}

    fields = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("fp", pa.int64()), ("mask", pa.int32())])
    schema = "doc_id bigint, part string, fp bigint, mask int"
    return map_rows(rows, ["doc_id", "part", "fp", "text"], schema, fields, per_batch)


def _cells(fps: np.ndarray, bits: int) -> np.ndarray:
    """[CELLS_A_TEXT, number of texts]: the cells of each text."""
    own = fps.view(np.uint64)
    seeds = (np.uint64(0x9E3779B97F4A7C15 * (i + 1) & (1 << 64) - 1) for i in range(CELLS_A_TEXT))
    return np.stack([mixed(own ^ seed) >> np.uint64(64 - bits) for seed in seeds]).astype(np.int64)


def repeat_sketch(rows: DataFrame, bits: int) -> np.ndarray:
    """One bit a cell, packed: whether more than one row falls into it."""

    def own_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted():
            cells, counts = np.unique(np.concatenate(held), return_counts=True)
            blocks, starts = np.unique(cells >> BLOCK_BITS, return_index=True)
            inside, often = (cells & (1 << BLOCK_BITS) - 1).astype("<u2"), counts > 1
            cuts = [*starts.tolist(), len(cells)]
            return pa.RecordBatch.from_pydict(
                {
                    "block": blocks,
                    "cells": [inside[a:b].tobytes() for a, b in zip(cuts, cuts[1:])],
                    "often": [np.packbits(often[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])],
                },
                schema=fields,
            )

        held, size = [], 0
        for batch in batches:
            cells = _cells(batch.column(0).to_numpy(zero_copy_only=False), bits)
            # A text whose cells coincide is one row in that cell, not several.
            for i in range(1, CELLS_A_TEXT):
                repeated = (cells[:i] == cells[i]).any(axis=0)
                held.append(cells[i][~repeated])
            held.append(cells[0])
            size += cells.size
            if size >= HELD_POSITIONS:
                yield counted()
                held, size = [], 0
        if size:
            yield counted()

    fields = pa.schema([("block", pa.int64()), ("cells", pa.binary()), ("often", pa.binary())])

    def merge(sketches: pa.Table) -> pa.Table:
        count = np.zeros(1 << BLOCK_BITS, dtype=np.uint8)
        for cells, often in zip(sketches["cells"].to_pylist(), sketches["often"].to_pylist()):
            inside = np.frombuffer(cells, dtype="<u2")
            more = np.unpackbits(np.frombuffer(often, dtype=np.uint8))[: len(inside)]
            count[inside] = np.minimum(count[inside] + 1 + more, 2)
        packed = np.packbits(count > 1).tobytes()
        return pa.table({"block": sketches["block"][:1], "bits": pa.array([packed], type=pa.binary())})

    merged = (
        rows.select("fp")
        .mapInArrow(own_sketch, "block bigint, cells binary, often binary")
        .groupBy("block")
        .applyInArrow(merge, "block bigint, bits binary")
    )
    sketch = np.zeros((1 << bits) // 8, dtype=np.uint8)
    width = (1 << BLOCK_BITS) // 8
    for row in merged.toLocalIterator():  # the sketch itself: at most 32 MB
        sketch[row["block"] * width : (row["block"] + 1) * width] = np.frombuffer(row["bits"], dtype=np.uint8)
    return sketch


def possible_repeats(df: DataFrame, sketch: np.ndarray, fp: str = "fp") -> DataFrame:
    """The rows whose text the sketch does not show to be unique."""
    bits = (len(sketch) * 8).bit_length() - 1
    shared = df.sparkSession.sparkContext.broadcast(sketch)

    @F.pandas_udf("boolean")
    def possible(fps: pd.Series) -> pd.Series:
        own, out = shared.value, np.ones(len(fps), dtype=bool)
        for cells in _cells(fps.to_numpy(dtype=np.int64), bits):
            out &= (own[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1 == 1
        return pd.Series(out)

    return df.withColumn("_possible", possible(F.col(fp)))


def first_of_repeats(docs: DataFrame, sketch: np.ndarray, key: str, text: str) -> DataFrame:
    """(first, first_fp): the smallest id of every text that may be repeated, by the whole text."""
    texts = docs.select(F.col(key).cast("bigint").alias("doc_id"), as_text(text).alias("text")).withColumn("fp", F.xxhash64("text"))
    return (
        possible_repeats(texts, sketch)
        .where("_possible")
        .groupBy("text")
        .agg(F.min("doc_id").alias("first"))
        .select("first", F.xxhash64("text").alias("first_fp"))
    )


def failures(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """doc_id, part, mask of failures A to E, and n, how many rows are alike in all of these."""
    rows = durable(flagged(docs, key, text, part), "audit-rows")
    bits = min(MAX_CELL_BITS, max(BLOCK_BITS, (CELLS_PER_ROW * rows.count()).bit_length()))
    sketch = repeat_sketch(rows, bits)
    firsts = durable(first_of_repeats(docs, sketch, key, text), "audit-firsts")
    marked = possible_repeats(rows, sketch)
    unique = marked.where("NOT _possible").select("doc_id", "part", "mask", F.lit(1).cast("bigint").alias("n"))
    # Rows alike are counted before the join, whose keys are then spread like the ids.
    counted = marked.where("_possible").groupBy("doc_id", "fp", "part", "mask").agg(F.count(F.lit(1)).alias("n"))
    is_first = (counted["doc_id"] == firsts["first"]) & (counted["fp"] == firsts["first_fp"])
    repeats = counted.join(firsts, is_first, "left").select(
        "doc_id",
        "part",
        F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.col("mask") + 16).otherwise(F.col("mask")).alias("mask"),
        "n",
    )
    return unique.unionByName(repeats)


def mask_counts(failed: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Per part and mask: how many documents, how many of them good, how many toxic."""
    known = labels.select(
        F.col(key).cast("bigint").alias("_id"), (F.col("quality") == 1).alias("_good"), (F.col("toxic") == 1).alias("_toxic")
    )
    flags = (
        known.where(F.col("_id").isNotNull() & (F.col("_good") | F.col("_toxic")))
        .groupBy("_id")
        .agg(F.max("_good").alias("_good"), F.max("_toxic").alias("_toxic"))
    )
    joined = failed.join(flags, failed["doc_id"] == flags["_id"], "left")
    return joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _mask_of(letters: Column) -> Column:
    return sum((F.when(letters.contains(f), 1 << i).otherwise(0) for i, f in enumerate(FILTERS)), F.lit(0))


def order_report(counts: DataFrame) -> DataFrame:
    """Per part, order and step: what the step's filter does there, summed over the masks."""
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = (
        counts.withColumn("filter_order", F.explode(orders))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("_own", _mask_of(F.substring("filter_order", F.col("step"), F.lit(1))))
        .withColumn("_earlier", F.col("mask").bitwiseAND(_mask_of(F.substring("filter_order", F.lit(1), F.col("step") - 1))) > 0)
        .withColumn("_fails", F.col("mask").bitwiseAND(F.col("_own")) > 0)
    )

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(F.lit(0)).cast("bigint"))

    fails, earlier = F.col("_fails"), F.col("_earlier")
    # Of a document that fails k filters, each of them is the first in 120 / k of the orders.
    share = F.when(fails, F.col("n") * F.floor(F.lit(120) / F.greatest(F.bit_count("mask"), F.lit(1)))).otherwise(F.lit(0))
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"),
        total(fails & ~earlier).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(F.col("mask") == F.col("_own")).alias("unique_fails"),
        total(fails & ~earlier, "good").alias("good_lost"),
        total(fails & ~earlier, "toxic").alias("toxic_lost"),
        F.sum(share.cast("bigint")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """One row per part, order of the five filters and step; see ``order_report``."""
    counts = durable(mask_counts(failures(docs, key, text, part), labels, key), "audit-masks")
    return order_report(counts)
