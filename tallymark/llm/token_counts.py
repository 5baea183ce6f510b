"""Token counts by heap-and-linked-list byte-pair merging; no identifiers are produced.

The symbols of a word form a linked list; a heap holds its mergeable neighbours by rank
and place. The lowest is merged until none is left. A word of b bytes that took m merges
has b - m tokens. Words repeat, so a worker remembers the counts of words it has met.

Defined results: a null text counts as empty (0 bytes, 0 tokens); a special string inside
a text is one token, as the public library reads it by default; rows are independent, so
repeated rows and extra columns change nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import CACHE_WORDS, map_rows
from .vocabulary import CHUNKS, WORDS, json_merges, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024

_PLACE = (1 << 32) - 1


def merged_length(symbols: list[int], pairs: dict[int, int]) -> int:
    """How many symbols are left when every possible merge, lowest rank first, is made."""
    size = len(symbols)
    get = pairs.get
    heap = []
    for i in range(size - 1):
        value = get(symbols[i] << 16 | symbols[i + 1])
        if value is not None:
            heap.append(value << 32 | i)
    if not heap:
        return size
    heapify(heap)
    after, before = list(range(1, size + 1)), list(range(-1, size - 1))
    merges = 0
    while heap:
        entry = heappop(heap)
        left = entry & _PLACE
        right = after[left]
        if right == size or symbols[left] < 0 or get(symbols[left] << 16 | symbols[right]) != entry >> 32:
            continue  # one of the two has been merged since
        merges += 1
        symbol = symbols[left] = entry >> 32 & 0xFFFF
        symbols[right] = -1
        following = after[left] = after[right]
        if following < size:
            before[following] = left
            value = get(symbol << 16 | symbols[following])
            if value is not None:
                heappush(heap, value << 32 | left)
        previous = before[left]
        if previous >= 0:
            value = get(symbols[previous] << 16 | symbol)
            if value is not None:
                heappush(heap, value << 32 | previous)
    return size - merges


class WordCounts(dict):
    """Tokens of words, remembered up to a bounded number."""

    def __init__(self, path: str):
        super().__init__()
        self.byte_symbols, self.pairs, self.specials = json_merges(path)

    def __missing__(self, word: str) -> int:
        symbols = list(map(self.byte_symbols.__getitem__, word.encode()))
        count = merged_length(symbols, self.pairs)
        if len(word) <= 32:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = count
        return count


class ChunkCounts(dict):
    """Tokens of blank-delimited chunks, remembered up to a bounded number."""

    def __init__(self, path: str):
        super().__init__()
        self.words = WordCounts(path)

    def __missing__(self, chunk: str) -> int:
        if chunk.isalpha():
            return self.words[chunk]
        count = sum(map(self.words.__getitem__, WORDS.findall(chunk)))
        if len(chunk) <= 32:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[chunk] = count
        return count

    def of_text(self, text: str) -> int:
        for special in self.words.specials:
            if special in text:
                parts = text.split(special)
                return len(parts) - 1 + sum(map(self.of_text, parts))
        return sum(map(self.__getitem__, CHUNKS.findall(text)))


_counts: dict[str, ChunkCounts] = {}


def token_counts(
    docs: DataFrame, path: str | None = None, limit: int = LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row: ``key``, n_bytes, n_tokens and whether n_tokens exceeds ``limit``."""
    path = path or vocabulary_path(VOCABULARY)

    def per_batch(keys, texts):
        if path not in _counts:
            _counts[path] = ChunkCounts(path)
        of_text = _counts[path].of_text
        n_tokens = [of_text(t) if t else 0 for t in texts]
        return {
            key: keys,
            "n_bytes": [len(t.encode()) if t else 0 for t in texts],
            "n_tokens": n_tokens,
            "over_limit": [n > limit for n in n_tokens],
        }

    fields = pa.schema(
        [(key, pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())]
    )
    schema = f"`{key}` bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return map_rows(docs, [key, text], schema, fields, per_batch)
