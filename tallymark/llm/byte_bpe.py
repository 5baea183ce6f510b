"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct words of a group of documents are laid out in one array of symbols. An
inverted index tells, for each rank, at which positions its pair stands. Ranks are taken
in order; a merge touches its own position and the two neighbours, whose new pairs enter
the index. A word whose merge opens a pair of lower rank waits until that rank has been
replayed, so each word's merges happen in the order the public library makes them.
A worker keeps what its words came to for the groups and tasks after.

Defined results: a null text counts as empty (no tokens, digests of the empty string);
special strings are ordinary text; rows are independent, so repeated rows and extra
columns change nothing; very long texts are encoded whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from array import array
from bisect import bisect_right
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import CACHE_WORDS, map_rows, worker_cache
from .vocabulary import CHUNKS, WORDS, token_ranks, vocabulary_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Characters of text whose distinct words are replayed together.
REPLAY_CHARS = 4_000_000

# A pair of ids is packed as ``left << ID_BITS | right``.
ID_BITS = 20
# In the array of symbols: what stands between words, and what was merged away.
EDGE, GONE = -1, -2
# A rank's positions are merged by whole arrays if there are so many.
MANY = 48


def pair_ranks(ranks: dict[bytes, int]) -> dict[int, int]:
    """The rank that each pair of tokens merges into, by the packed pair."""
    pairs = {}
    for token, rank in ranks.items():
        for cut in range(1, len(token)):
            left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
            if left is not None and right is not None:
                pairs[left << ID_BITS | right] = rank
    return pairs


class MergeReplay:
    """Ids of many words at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.pairs = pair_ranks(ranks)
        self.keys = np.array(sorted(self.pairs), dtype=np.int64)
        self.values = np.array([self.pairs[key] for key in self.keys.tolist()], dtype=np.int32)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        first = [[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)]
        self.byte_pairs = np.array(first, dtype=np.int32)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """The ids of each word, four bytes an id."""
        found = {n: array("i", [rank]).tobytes() for n, w in enumerate(words) if (rank := self.ranks.get(w)) is not None}
        rest = iter(self._replayed([w for n, w in enumerate(words) if n not in found]))
        return [found[n] if n in found else next(rest) for n in range(len(words))]

    def _replayed(self, words: list[bytes]) -> list[bytes]:
        content = np.frombuffer(b"".join(words), dtype=np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.cumsum(lengths + 1) - lengths  # the position of each word's first byte
        size = len(content) + len(words) + 1
        places = np.arange(len(content)) + np.repeat(np.arange(len(words)), lengths) + 1
        symbols = np.full(size, EDGE, dtype=np.int32)
        symbols[places] = self.bytes[content]
        # pair[i]: the rank of the pair that begins at i, -1 if the two don't merge.
        pair = np.full(size, -1, dtype=np.int32)
        inside = np.diff(places) == 1
        pair[places[:-1][inside]] = self.byte_pairs[content[:-1][inside], content[1:][inside]]
        merged = self._merge(symbols, pair, starts)
        kept = np.flatnonzero(merged >= 0)
        cuts = [*np.searchsorted(kept, starts).tolist(), len(kept)]
        ids = merged[kept].tobytes()
        return [ids[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])]

    def _ranks_of(self, left, right) -> np.ndarray:
        """The ranks of many pairs; -1 where the two don't merge."""
        wanted = left.astype(np.int64) << ID_BITS | right
        place = np.searchsorted(self.keys, wanted)
        place[place == len(self.keys)] = 0
        return np.where(self.keys[place] == wanted, self.values[place], -1)

    def _merge(self, symbols: np.ndarray, pair: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The symbols after all merges; ``pair`` and the inverted index follow every one of them."""
        order = np.argsort(pair, kind="stable")[int((pair < 0).sum()) :]
        index: dict[int, list[int]] = {}
        heap: list[int] = []
        self._enter(pair[order], order, index, heap)
        size = len(symbols)
        after, before = np.arange(1, size + 1, dtype=np.int32), np.arange(-1, size - 1, dtype=np.int32)
        state = (symbols, pair, after, before)
        # The same memory, read and written one number at a time.
        own = [memoryview(a) for a in state]
        word_starts = starts.tolist()
        while heap:
            rank = heappop(heap)
            places = index.pop(rank)
            if len(places) < MANY or not self._merge_many(rank, places, state, index, heap):
                self._merge_each(rank, places, own, index, heap, word_starts)
        return symbols

    @staticmethod
    def _enter(ranks: np.ndarray, places: np.ndarray, index: dict[int, list[int]], heap: list[int]) -> None:
        """Put positions, sorted by the rank of their pairs, into the index."""
        found, cuts = np.unique(ranks, return_index=True)
        bounds, places = [*cuts.tolist(), len(ranks)], places.tolist()
        for rank, a, b in zip(found.tolist(), bounds, bounds[1:]):
            if rank in index:
                index[rank] += places[a:b]
            else:
                index[rank] = places[a:b]
                heappush(heap, rank)

    def _merge_many(self, rank: int, places: list[int], state, index, heap) -> bool:
        """Merge all positions of a rank at once; False, and nothing done, where their order matters:
        if two of them overlap, or a merge opens a pair of lower rank."""
        symbols, pair, after, before = state
        left = np.unique(np.array(places, dtype=np.int32))
        left = left[pair[left] == rank]
        right = after[left]
        following, previous = after[right], before[left]
        opened = (self._ranks_of(np.int64([rank]), symbols[following]), self._ranks_of(symbols[previous], rank))
        if (
            (pair[right] == rank).any()
            or any(((ranks >= 0) & (ranks < rank)).any() for ranks in opened)
            or 0 <= self.pairs.get(rank << ID_BITS | rank, -1) < rank
        ):
            return False
        symbols[left], symbols[right], pair[right] = rank, GONE, -1
        after[left], before[following] = following, left
        previous = before[left]
        pair[left] = self._ranks_of(np.int64([rank]), symbols[following])
        pair[previous] = self._ranks_of(symbols[previous], rank)
        changed = np.concatenate([left, previous])
        ranks = pair[changed]
        order = np.argsort(ranks, kind="stable")[int((ranks < 0).sum()) :]
        self._enter(ranks[order], changed[order], index, heap)
        return True

    def _merge_each(self, rank: int, places: list[int], state, index, heap, word_starts: list[int]) -> None:
        """Merge the positions of a rank from left to right."""
        symbols, pair, after, before = state
        rank_of, base = self.pairs.get, rank << ID_BITS
        waiting, later = set(), []
        for left in sorted(places):
            if pair[left] != rank:
                continue  # one of the two has been merged since
            if waiting and bisect_right(word_starts, left) in waiting:
                later.append(left)
                continue
            right = after[left]
            following, previous = after[right], before[left]
            symbols[left], symbols[right], pair[right] = rank, GONE, -1
            after[left], before[following] = following, left
            for place, new in (
                (left, rank_of(base | symbols[following], -1)),
                (previous, rank_of(symbols[previous] << ID_BITS | rank, -1)),
            ):
                pair[place] = new
                if new >= 0:
                    if new in index:
                        index[new].append(place)
                    else:
                        index[new] = [place]
                        heappush(heap, new)
                    if new < rank:
                        waiting.add(bisect_right(word_starts, left))
        if later:
            if rank not in index:
                index[rank] = []
                heappush(heap, rank)
            index[rank] += later


class Codec:
    """Encodes batches of texts, remembering the words it has met, and decodes ids."""

    def __init__(self, path: str):
        ranks = token_ranks(path)
        self.replay = MergeReplay(ranks)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.names = {rank: str(rank) for rank in ranks.values()}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """The ids of every chunk; a chunk of several words is put together from theirs.

        Of the chunks before, those met last stay: when the newer half is full it becomes the older.
        """
        if len(self.known) > CACHE_WORDS // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = {}
        for chunk in chunks.difference(known):
            if chunk in older:
                known[chunk] = older[chunk]
            else:
                new[chunk] = (chunk,) if chunk.isalpha() else WORDS.findall(chunk)
        words = list({word for parts in new.values() for word in parts if word not in known})
        known.update(zip(words, self.replay.encode([word.encode() for word in words])))
        for chunk, parts in new.items():
            if len(parts) > 1:
                known[chunk] = b"".join(map(known.__getitem__, parts))
        return known

    def encode(self, texts: list[str]):
        """The ids of each text, in order."""
        group, size = [], 0
        for i, text in enumerate(texts):
            group.append(CHUNKS.findall(text))
            size += len(text)
            if size >= REPLAY_CHARS or i == len(texts) - 1:
                known = self.learn(set(chain.from_iterable(group)))
                for chunks in group:
                    yield array("i", b"".join(map(known.__getitem__, chunks))).tolist()
                group, size = [], 0

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def codec(path: str | None = None) -> Codec:
    path = path or vocabulary_path(VOCABULARY)
    return worker_cache(f"byte-bpe {path}", lambda: Codec(path))


def encode_texts(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and the token ids of its whole text."""

    def per_batch(keys, texts):
        return {key: keys, "ids": list(codec(path).encode([t or "" for t in texts]))}

    fields = pa.schema([(key, pa.int64()), ("ids", pa.list_(pa.int32()))])
    return map_rows(docs, [key, text], f"`{key}` bigint, ids array<int>", fields, per_batch)


def decode_ids(encoded: DataFrame, path: str | None = None, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """Per row: ``key`` and the bytes its ids stand for (null ids: empty)."""

    def per_batch(keys, lists):
        return {key: keys, "content": [codec(path).decode(x or []) for x in lists]}

    fields = pa.schema([(key, pa.int64()), ("content", pa.binary())])
    return map_rows(encoded, [key, ids], f"`{key}` bigint, content binary", fields, per_batch)


def encoding_digests(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key``, n_tokens, and digests of the ids and of the bytes decoded from them.

    Encoding and decoding run in one task so that the ids need not leave it.
    """

    def per_batch(keys, texts):
        own = codec(path)
        counts, id_digests, text_digests = [], [], []
        for ids in own.encode([t or "" for t in texts]):
            counts.append(len(ids))
            id_digests.append(hashlib.sha256(",".join(map(own.names.__getitem__, ids)).encode()).hexdigest())
            text_digests.append(hashlib.sha256(own.decode(ids)).hexdigest())
        return {key: keys, "n_tokens": counts, "ids_sha256": id_digests, "decoded_sha256": text_digests}

    fields = pa.schema(
        [(key, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )
    schema = f"`{key}` bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(docs, [key, text], schema, fields, per_batch)
