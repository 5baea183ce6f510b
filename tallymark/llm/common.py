"""Helpers shared by the text operators: reading, words, hashes, Arrow batches, durable tables."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_table_path

# Words kept per worker before a cache starts afresh: bounds its memory, never its answers.
CACHE_WORDS = 400_000
# The words of the contracts: runs of anything but the ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def durable(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: a cut in the lineage that outlives executors."""
    path = new_table_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, columns: Sequence[str], schema: str, fields: pa.Schema, per_batch: Callable[..., dict]
) -> DataFrame:
    """Apply ``per_batch(*lists) -> dict of lists`` to Arrow batches of the named columns."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gc.disable()  # millions of short-lived lists and no cycles: scanning them costs more than the work
            try:
                out = per_batch(*[batch.column(i).to_pylist() for i in range(len(columns))])
            finally:
                gc.enable()
            yield pa.RecordBatch.from_pydict(out, schema=fields)

    return df.select(*columns).mapInArrow(work, schema)


_held: dict[str, object] = {}


def worker_cache(name: str, make: Callable[[], object]):
    """What a worker keeps from task to task under a name; what it kept under another name goes."""
    if name not in _held:
        _held.clear()
        gc.collect()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)  # back to the system, where the C library can
        _held[name] = make()
    return _held[name]


class WordHashes(dict):
    """64-bit hashes of UTF-8 words: numbers the words it meets and keeps their hashes by number."""

    def __init__(self):
        super().__init__()
        self.hashes = np.zeros(1 << 16, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        if len(word) > 64:  # known by a hash, so that the table stays small
            return self[b"\x00" + xxhash.xxh3_128_digest(word) + word[:32]]
        number = self[word] = len(self)
        if number == len(self.hashes):
            self.hashes = np.concatenate([self.hashes] * 2)
        self.hashes[number] = xxhash.xxh3_64_intdigest(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > CACHE_WORDS:
            self.clear()
        numbers = np.array(list(map(self.__getitem__, words)), dtype=np.int64)  # may make room for new words
        return self.hashes[numbers]


_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (shift, multiply, shift)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(29))


def gram_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, one for each start."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.zeros(count, dtype=np.uint64)
    for i in range(size):
        # Horner's rule: the place of a word in the run matters.
        total = total * np.uint64(_ODD[0]) + hashes[i : i + count]
    return mixed(total + np.uint64(size))


def as_text(column: str = "text"):
    """A text column with null read as empty."""
    return F.coalesce(F.col(column), F.lit(""))
