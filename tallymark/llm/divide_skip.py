"""T-occurrence search over inverted lists by DivideSkip."""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Sequence
from heapq import heapify, heapreplace, heappop

# Weighs how many long lists are set aside; the published heuristic's tuning constant.
MU = 0.01


def divide_skip(lists: Sequence[Sequence[int]], needed: int) -> dict[int, int]:
    """Members of at least ``needed`` of the sorted ``lists``, with the number of lists they are in.

    The longest lists, fewer than ``needed`` of them, are set aside. The others are merged
    with a heap; what occurs often enough there to be able to reach ``needed`` is looked up
    in the long ones by binary search.
    """
    if needed < 1:
        raise ValueError("needed must be at least 1")
    lists = sorted((own for own in lists if own), key=len)
    if len(lists) < needed:
        return {}
    aside = min(needed - 1, int(needed / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    heap = [(own[0], i, 0) for i, own in enumerate(short)]
    heapify(heap)
    found = {}
    while heap:
        member, count = heap[0][0], 0
        while heap and heap[0][0] == member:
            _, i, at = heap[0]
            count += 1
            if at + 1 < len(short[i]):
                heapreplace(heap, (short[i][at + 1], i, at + 1))
            else:
                heappop(heap)
        if count < needed - len(long):
            continue
        for i, own in enumerate(long):
            at = bisect_left(own, member)
            count += at < len(own) and own[at] == member
            if count + len(long) - i - 1 < needed:
                break
        if count >= needed:
            found[member] = count
    return found
