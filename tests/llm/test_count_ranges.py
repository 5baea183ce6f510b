"""Counting shingles by range."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from tallymark.llm import jaccard


def packed(number, values, counts):
    blob = zlib.compress(np.array(counts, dtype="<u4").tobytes(), 1)
    return number, jaccard._packed(np.array(values, dtype=np.uint64)), blob


def test_a_task_holds_one_of_its_ranges_at_a_time(monkeypatch):
    """Ranges are dealt by hash, so a task has several; what is held at once is one range's counts."""
    held, often = [], jaccard._often
    monkeypatch.setattr(jaccard, "_often", lambda values, counts: held.append(sum(map(len, values))) or often(values, counts))
    shift = 48 - jaccard.BITMAP_BITS
    rows = [
        packed(0, [1 << shift, 2 << shift], [20, 1]),
        packed(0, [1 << shift], [20]),
        packed(3, [9 << shift], [70_000]),
        packed(3, [7 << shift], [jaccard.COMMON]),
        packed(5, [11 << shift], [100]),
    ]
    cut = [rows[:1], rows[1:4], rows[4:]]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*own)], ["range", "shingles", "counts"]) for own in cut]
    found = [row for batch in jaccard.count_ranges(iter(batches)) for row in batch.to_pylist()]
    assert held == [3, 2, 1]
    assert [row["place"] for row in found] == [1, 9, 11]
    assert [row["level"] for row in found] == [int(np.log2(n / jaccard.COMMON)) for n in (40, 65_535, 100)]
