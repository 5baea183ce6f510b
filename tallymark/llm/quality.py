"""Quality classifier: hashed word n-gram logistic regression, trained by FTRL-proximal.

A text becomes counts of hashed word n-grams: words, word pairs, and pairs of word shapes
(letter case, digits and marks with repeats folded) marked with whether a word repeats one
of the three before it. Counts are divided by their number, so length does not matter.
Training follows the regularised leader example by example in a fixed number of shards,
whose weights are averaged; scoring is one sparse dot product per text.

The labelled sample is bounded by ``sample_rows`` (in expectation: labelled rows are taken by a
hash of id, text and label below a share). Weights have a fixed number of slots, so what is
broadcast does not grow with the data. Labels, language, source and id never enter a score.

Defined results: a null or empty text scores by the bias alone; labels that are null, or
belong to no document, are not learnt from, nor are rows without an id; rows that repeat id,
text and label count once; a null id is not held out; very long texts are read whole; with
no usable label every score is 0.5; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import CACHE_WORDS, durable, map_rows, worker_cache

BITS = 18
SLOTS = 1 << BITS
SAMPLE_ROWS = 12_000
SHARDS = 6
EPOCHS = 4
# Score from which a text is taken to be good.
THRESHOLD = 0.7
# FTRL-proximal: learning rate, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.5
SCALE = 20.0


class WordFeatures(dict):
    """Numbers words; ``own`` and ``shape`` hold their hashes by number."""

    def __init__(self):
        super().__init__()
        self.own = np.zeros(1 << 16, dtype=np.uint64)
        self.shape = np.zeros(1 << 16, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        if len(word) > 64:  # a long word is known by its hash, so that the table stays small
            return self[b"\x00" + xxhash.xxh3_128_digest(word) + word[:32]]
        text = word.decode("utf-8", "replace")
        shape = "A" if len(text) > 1 and text.upper() == text and text.lower() != text else ""
        shape += re.sub(r"(.)\1+", r"\1", re.sub(r"\d+", "0", re.sub(r"[^\W\d_]+", "a", text)))
        number = self[word] = len(self)
        if number == len(self.own):
            self.own, self.shape = np.concatenate([self.own] * 2), np.concatenate([self.shape] * 2)
        self.own[number] = xxhash.xxh3_64_intdigest(word)
        self.shape[number] = xxhash.xxh3_64_intdigest(shape.encode())
        return number

    def of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self) > CACHE_WORDS:
            self.clear()
        numbers = np.array(list(map(self.__getitem__, words)), dtype=np.int64)
        return self.own[numbers], self.shape[numbers]


def _slots(values: np.ndarray, seed: int) -> np.ndarray:
    values = (values + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    return ((values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)).astype(np.int64)


def slots_of(text: str | None) -> np.ndarray:
    """The slot of every n-gram of the text, repeats included."""
    words = text.encode().split() if text else []
    if not words:
        return np.empty(0, dtype=np.int64)
    own, shape = worker_cache("quality", WordFeatures).of(words)
    repeats = np.zeros(len(words), dtype=np.uint64)
    for back in (3, 2, 1):
        if len(words) > back:
            repeats[back:][own[back:] == own[:-back]] = back
    marked = shape * np.uint64(4) + repeats
    odd = np.uint64(0xC2B2AE3D27D4EB4F)
    return np.concatenate(
        [
            _slots(own, 1),
            _slots(own[:-1] * odd + own[1:], 2),
            _slots(marked, 3),
            _slots(marked[:-1] * odd + marked[1:], 4),
        ]
    )


def sparse(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values of a text's features; slot 0 holds the bias."""
    slots, counts = np.unique(slots_of(text), return_counts=True)
    values = counts * (SCALE / max(1, counts.sum()))
    return np.append(slots, 0), np.append(values, 1.0)


def sigmoid(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(margin, -35, 35))))


class Ftrl:
    """Follow-the-regularised-leader updates of logistic loss; weights are derived from z and n."""

    def __init__(self):
        self.z, self.n = np.zeros(SLOTS), np.zeros(SLOTS)

    def weights(self, slots=slice(None)) -> np.ndarray:
        z, n = self.z[slots], self.n[slots]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, slots: np.ndarray, values: np.ndarray, label: int) -> None:
        weights = self.weights(slots)
        gradient = (sigmoid(weights @ values) - label) * values
        n = self.n[slots]
        sigma = (np.sqrt(n + gradient * gradient) - np.sqrt(n)) / ALPHA
        np.add.at(self.z, slots, gradient - sigma * weights)
        np.add.at(self.n, slots, gradient * gradient)


def fold(key: Column) -> Column:
    """crc32 of the id as text (null: empty), modulo 4; fold 2 is held out from learning."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, label: str, key: str, text: str, sample_rows: int) -> DataFrame:
    """The rows to learn from, about ``sample_rows`` or all there are: _order, _shard, _label, _text."""
    usable = (
        labels.select(F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & (fold(F.col("_id")) != 2))
        .distinct()
    )
    # Who is labelled, by fingerprint: without texts until it is known which rows are taken.
    labelled = durable(
        docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_fp")).join(usable, "_id").distinct(), "labelled"
    )
    share = min(1.0, sample_rows / max(1, labelled.count()))
    order = F.pmod(F.xxhash64("_id", "_fp", "_label"), F.lit(1_000_000))
    # About sample_rows rows of three numbers: small enough to broadcast by that bound.
    sample = labelled.where(order < int(share * 1_000_000))
    return (
        docs.select(F.col(key).alias("_id"), F.xxhash64(text).alias("_fp"), F.col(text).alias("_text"))
        .join(F.broadcast(sample), ["_id", "_fp"])
        .groupBy("_id", "_fp", "_label")
        .agg(F.first("_text").alias("_text"))
        .select(
            F.xxhash64("_id", "_fp", F.lit(7)).alias("_order"),
            F.pmod(F.xxhash64("_id", "_fp"), F.lit(SHARDS)).alias("_shard"),
            "_label",
            "_text",
        )
    )


def train(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> np.ndarray:
    """Weights learnt from a bounded sample of the labelled rows outside the held-out fold."""
    rows = training_rows(docs, labels, label, key, text, sample_rows)

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_order", "_label", "_text"])
        examples = [(sparse(t), y) for t, y in zip(pdf["_text"], pdf["_label"])]
        model = Ftrl()
        for _ in range(EPOCHS):
            for (slots, values), y in examples:
                model.learn(slots, values, y)
        return pd.DataFrame({"rows": [len(pdf)], "weights": [model.weights().astype("<f4").tobytes()]})

    # SHARDS rows of SLOTS numbers, whatever the input: this is all that reaches the driver.
    parts = rows.groupBy("_shard").applyInPandas(shard, "rows bigint, weights binary").collect()
    if not parts:
        return np.zeros(SLOTS)
    counts = np.array([p.rows for p in parts], dtype=float)
    stacked = np.stack([np.frombuffer(p.weights, dtype="<f4") for p in parts]).astype(float)
    return (counts[:, None] * stacked).sum(0) / counts.sum()


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and the score of its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)  # SLOTS numbers

    def per_batch(keys, texts):
        own = shared.value
        scores = []
        for t in texts:
            slots = slots_of(t)
            margin = own[0] + (SCALE * own[slots].mean() if len(slots) else 0.0)
            scores.append(round(sigmoid(margin), 9))
        return {key: keys, "score": scores}

    fields = pa.schema([(key, pa.int64()), ("score", pa.float64())])
    return map_rows(docs, [key, text], f"`{key}` bigint, score double", fields, per_batch)


def keep_good(
    docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD, text: str = "text"
) -> DataFrame:
    """The rows whose text scores at least ``threshold``, all columns kept."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        own = shared.value
        kept = []
        for t in texts:
            slots = slots_of(t)
            margin = own[0] + (SCALE * own[slots].mean() if len(slots) else 0.0)
            kept.append(round(sigmoid(margin), 9) >= threshold)
        return pd.Series(kept)

    return docs.where(good(F.col(text)))
