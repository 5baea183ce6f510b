"""Benchmark decontamination: SimHash of item-sized windows, Hamming blocks, exact verification.

Texts and items are read as lower-case runs of letters and digits; a shingle is five of
them in a row (an item with fewer words is one shingle of its own length). Every place
where a text has a shingle of an item gives a diagonal (place in the text less place in
the item). The windows of the item's size that start on or between neighbouring diagonals
are fingerprinted: a start outside them never holds more of the item than one on them,
so no window that could reach the similarity is left out. A fingerprint is cut into one
block more than the radius, so fingerprints within it agree in a block: joining on (item,
block number, block) finds them all. Those within the radius are verified by weighted
Jaccard similarity, where a shingle weighs as often as it occurs.

The radius is set so wide that windows at the similarity threshold are beyond it with a
chance of about one in a thousand, and verbatim passages never.

Only built-in functions run here. Item shingles are broadcast when they are few, by count,
and joined by shuffle otherwise; so are the ids of texts with a shared shingle.

Texts are searched once each, known by two 64-bit hashes, and their rows looked up at the
end; so a text that a third of all rows repeat is one text.

Defined results: null or empty texts and items match nothing; a null doc_id is not
reported by ``contaminated``, having no id to report, but its text is by
``contaminated_texts``; rows with the same id but different texts are examined
apart and reported once per id and item; repeated rows change nothing; very long texts are
searched whole; extra columns are ignored; of equally similar windows the first is
reported; empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from . import native
from .common import durable

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19
# Rows, or words, up to which a side may be broadcast: 32 bytes each make 16 MB.
BROADCAST_ROWS = 500_000
# The columns by which a text is known.
TEXT_KEY = ["_fp", "_fp2"]


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def text_key(text: Column) -> list[Column]:
    """Two independent hashes of a text."""
    return [F.xxhash64(text).alias("_fp"), F.xxhash64(F.lit(1), text).alias("_fp2")]


def fingerprint(shingles: Column) -> Column:
    """64-bit SimHash, written as bits: each occurrence of a shingle votes for its bits."""

    def bit(b: Column) -> Column:
        votes = F.aggregate(
            shingles,
            F.lit(0),
            lambda total, s: total + F.when(F.getbit(s, b) == 1, F.lit(1)).otherwise(F.lit(-1)),
        )
        return F.when(votes > 0, F.lit("1")).otherwise(F.lit("0"))

    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(63)), bit), "")


def blocks(bits: Column, count: int = RADIUS + 1) -> Column:
    """The fingerprint's bits cut into ``count`` blocks, each marked with its number."""
    edges = [64 * i // count for i in range(count + 1)]
    return F.array(
        *[
            F.concat(F.lit(f"{i}:"), F.substring(bits, edges[i] + 1, edges[i + 1] - edges[i]))
            for i in range(count)
        ]
    )


def distance(left: Column, right: Column) -> Column:
    """Hamming distance of two fingerprints written as bits."""

    halves = [
        F.bit_count(
            F.conv(F.substring(left, at, 32), 2, 10).cast("bigint").bitwiseXOR(
                F.conv(F.substring(right, at, 32), 2, 10).cast("bigint")
            )
        )
        for at in (1, 33)
    ]
    return halves[0] + halves[1]


def _marked(df: DataFrame, shingles: str, name: str, kept: list[str]) -> DataFrame:
    """Add the shingles as a set in which the second occurrence of one differs from its first."""
    rows = df.select(*kept, F.array_sort(shingles).alias("_in_order"))
    return rows.select(
        *kept,
        F.transform(
            "_in_order", lambda s, i: F.xxhash64(s, i + 1 - F.array_position(F.col("_in_order"), s).cast("int"))
        ).alias(name),
    )


def _matches(docs: DataFrame, items: DataFrame, size: int, similarity: float, radius: int) -> DataFrame:
    """Matches with the items whose shingles have ``size`` words."""
    sized = items.select("item_id", "n_words", native.grams(F.col("_hashes"), size).alias("_shingles"))
    sized = durable(
        _marked(
            sized.withColumn("_bits", fingerprint(F.col("_shingles"))),
            "_shingles",
            "_marked",
            ["item_id", "n_words", "_shingles", "_bits"],
        ),
        "items",
    )
    placed = sized.select("item_id", F.posexplode_outer("_shingles").alias("_q", "_g"))
    rows = docs.select(*TEXT_KEY, native.grams(F.col("_hashes"), size).alias("_shingles"))
    hits = (
        rows.select(*TEXT_KEY, F.posexplode_outer("_shingles").alias("_p", "_g"))
        .join(_bounded(placed, placed.count()), "_g")
        .groupBy(*TEXT_KEY, "item_id")
        .agg(F.array_sort(F.collect_set(F.col("_p") - F.col("_q"))).alias("_diagonals"))
    )
    hits = durable(hits, "shared-shingles")
    found = hits.select(*TEXT_KEY).distinct()
    texts = durable(rows.join(_bounded(found, hits.count()), TEXT_KEY, "left_semi").distinct(), "suspect-texts")

    def starts(diagonal, i):
        following = F.get(F.col("_diagonals"), i + 1)
        between = F.when(following - diagonal <= 2 * F.col("n_words"), F.sequence(diagonal, following))
        return F.coalesce(between, F.array(diagonal))

    item_side = sized.select("item_id", "n_words", F.col("_shingles").alias("_item"), F.col("_bits").alias("_item_bits"), F.col("_marked").alias("_item_marked"))
    few = item_side.count()
    # Items travel whole: what counts is how many words they have.
    item_words = item_side.agg(F.sum("n_words")).first()[0] or 0
    windows = (
        hits.join(_bounded(item_side.select("item_id", "n_words", F.size("_item").alias("_m")), few), "item_id")
        .select(*TEXT_KEY, "item_id", "_m", F.explode_outer(F.array_distinct(F.flatten(F.transform("_diagonals", starts)))).alias("_start"))
        .join(texts, TEXT_KEY)
        .select(
            *TEXT_KEY,
            "item_id",
            F.least(F.greatest("_start", F.lit(0)), F.greatest(F.lit(0), F.size("_shingles") - F.col("_m"))).alias("start"),
            "_m",
            "_shingles",
        )
        .select(*TEXT_KEY, "item_id", "start", F.slice("_shingles", F.col("start") + 1, F.col("_m")).alias("_window"))
        .distinct()
    )
    prints = windows.withColumn("_window_bits", fingerprint(F.col("_window")))
    # One fingerprint pair shares several blocks: the block join may find it as often.
    item_blocks = sized.select("item_id", F.col("_bits").alias("_item_bits"), F.explode_outer(blocks(F.col("_bits"), radius + 1)).alias("_block"))
    near = (
        prints.withColumn("_block", F.explode_outer(blocks(F.col("_window_bits"), radius + 1)))
        .join(_bounded(item_blocks, few * (radius + 1)), ["item_id", "_block"])
        .where(distance(F.col("_window_bits"), F.col("_item_bits")) <= radius)
        .select(*TEXT_KEY, "item_id", "start", "_window")
        .distinct()
    )
    marked = _marked(near, "_window", "_own", [*TEXT_KEY, "item_id", "start", "_window"])
    common = F.size(F.array_intersect("_own", "_item_marked"))
    return (
        marked.join(_bounded(item_side.select("item_id", "n_words", "_item", "_item_marked"), item_words), "item_id")
        .select(*TEXT_KEY, "item_id", "start", "n_words", common.alias("_common"), (F.size("_window") + F.size("_item")).alias("_both"))
        .withColumn("similarity", F.col("_common") / (F.col("_both") - F.col("_common")))
        .where(F.col("similarity") >= similarity)
        .groupBy(*TEXT_KEY, "item_id")
        .agg(*_best())
    )


def _best() -> list[Column]:
    """Of several windows of an item: the first of the most similar ones."""
    return [
        F.max("similarity").alias("similarity"),
        F.min_by("start", F.struct(-F.col("similarity"), "start")).cast("bigint").alias("start"),
        F.max("n_words").alias("n_words"),
    ]


def contaminated_texts(
    docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS, text: str = "text"
) -> DataFrame:
    """Per distinct text and item it holds: the text's key, item_id, similarity, start (in words) and n_words."""
    items = (
        benchmark.select("item_id", native.plain_words(F.col("text")).alias("_words"))
        .where((F.size("_words") > 0) & F.col("item_id").isNotNull())
        .select("item_id", F.size("_words").cast("bigint").alias("n_words"), native.word_hashes(F.col("_words")).alias("_hashes"))
        .distinct()
    )
    items = durable(items, "items-words")
    rows = docs.select(*text_key(F.col(text)), native.word_hashes(native.plain_words(F.col(text))).alias("_hashes"))
    # At most SHINGLE sizes, and only one where no item is shorter than a shingle.
    short = [r[0] for r in items.select(F.least("n_words", F.lit(SHINGLE)).alias("k")).distinct().collect()]
    parts = [
        _matches(rows, items.where(F.least("n_words", F.lit(SHINGLE)) == k), int(k), similarity, radius)
        for k in sorted(short) or [SHINGLE]
    ]
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    return durable(found, "contaminated-texts")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    radius: int = RADIUS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per doc_id and item its text holds: doc_id, item_id, similarity, start (in words) and n_words of the best window."""
    found = contaminated_texts(docs, benchmark, similarity, radius, text)
    ids = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("doc_id"), *text_key(F.col(text)))
    return ids.join(_bounded(found, found.count()), TEXT_KEY).groupBy("doc_id", "item_id").agg(*_best())


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **settings) -> DataFrame:
    """The rows whose text holds no item, all columns kept; ids play no part in it."""
    found = contaminated_texts(docs, benchmark, text=text, **settings).select(*TEXT_KEY).distinct()
    fp, fp2 = text_key(docs[text])
    return docs.join(_bounded(found, found.count()), (fp == found["_fp"]) & (fp2 == found["_fp2"]), "left_anti")
