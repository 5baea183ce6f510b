"""Language ID with language-bitmask n-gram filters.

A language's filter is a Bloom filter of the n-grams of letters (two to four, a word's beginning
and end counting as a character) that are at home in it: those that make up at least MIN_SHARE of
its n-grams and at least AT_HOME times the share they have in any other language. The filters
of all languages lie side by side, bit-sliced: a cell holds one bit a language, so the bits
that an n-gram's cells have in common are all languages that contain it. For each text the
bits are counted by language; of N n-grams a filter holds N x rate by mistake, where
rate follows from how full its slice is, and the corrected counts decide.

Learning counts n-grams in a sample of about SAMPLE_ROWS rows a language, taken by a hash of id and
text; MIN_SHARE bounds the n-grams of a language by 1 / MIN_SHARE and CELLS fixes the
filter's size, which is all that is collected and broadcast (CELLS times one bit a language).
Every text is predicted whole. Language, source and id never enter a prediction.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every
text when nothing could be learnt; a text with letters but no known n-gram gets the
language learnt from the most rows, with score 0; ties go to the first language by
name; the score is the winner's part of all corrected counts; a null id is that of an empty
text, so not held out; repeated rows are learnt from once and each predicted;
a text of more than PIECE characters is cut between words, or where a single word
is longer than that; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import durable, gram_hashes, map_rows, mixed

SIZES = (2, 3, 4)
SAMPLE_ROWS = 2_000
MIN_SHARE = 1e-5
AT_HOME = 0.5
CELL_BITS = 20
CELLS = 1 << CELL_BITS
# Cells an n-gram falls into; three times CELL_BITS bits come from one 64-bit hash.
CELLS_A_GRAM = 3
UNKNOWN = "und"
# Characters worked on at once.
PIECE = 1_000_000

_NO_LETTER = re.compile(r"[\W\d_]")
SPACE = 32


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """By code point: the small letter it stands for, or a space for anything but letters."""
    out = np.full(0x110000, SPACE, dtype=np.uint32)
    for point in range(0x110000):
        if (letter := chr(point)).isalpha():
            small = letter.lower()
            out[point] = ord(small) if len(small) == 1 else point
    return out


def _pieces(texts: Sequence[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Groups of texts, and parts of long texts, of about PIECE characters, with the numbers of the texts."""
    numbers, group, size = [], [], 0
    for number, text in enumerate(texts):
        text, at = text or "", 0
        while at < len(text):
            end = len(text)
            if end - at > PIECE:
                cut = _NO_LETTER.search(text, at + PIECE, at + 2 * PIECE)
                end = cut.start() if cut else min(end, at + 2 * PIECE)
            numbers.append(number)
            group.append(text[at:end])
            size += end - at
            at = end
            if size >= PIECE:
                yield numbers, group
                numbers, group, size = [], [], 0
    if group:
        yield numbers, group


def _grams(numbers: list[int], group: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text number and hash of every n-gram of the group, and the numbers of texts with a letter."""
    points = np.frombuffer("\n".join(["", *group, ""]).encode("utf-32-le", "replace"), dtype="<u4")
    lengths = np.fromiter(map(len, group), np.int64, len(group)) + 1
    owner = np.repeat(np.array([numbers[0], *numbers]), [1, *lengths])
    letters = _letters()[points]
    # One space between words, whatever stands there, and around each text.
    inside = letters != SPACE
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    keep[0] = True
    letters, owner, inside = letters[keep], owner[keep], inside[keep]
    hashes = mixed(letters.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
    owners, found = [], []
    for size in SIZES:
        count = len(letters) - size + 1
        if count <= 0:
            continue
        # A space only at either end: an n-gram lies in one word.
        whole = np.ones(count, dtype=bool)
        for i in range(1, size - 1):
            whole &= inside[i : i + count]
        # The space before a word may be that after the text before; the second character never is.
        owners.append(owner[1 : 1 + count][whole])
        found.append(gram_hashes(hashes, size)[whole])
    if not found:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64), owner[inside]
    return np.concatenate(owners), np.concatenate(found), np.unique(owner[inside])


def _cells(grams: np.ndarray) -> list[np.ndarray]:
    return [((grams >> np.uint64(CELL_BITS * i)) & np.uint64(CELLS - 1)).astype(np.int64) for i in range(CELLS_A_GRAM)]


@dataclass(frozen=True)
class LanguageFilters:
    """``slices[i]`` holds the bits of languages 8i to 8i + 7 for every cell."""

    languages: tuple[str, ...]
    rows: tuple[int, ...]
    slices: np.ndarray

    def containing(self, grams: np.ndarray) -> np.ndarray:
        """[slice, n-gram]: the languages that contain each n-gram, eight to a byte."""
        cells = _cells(grams)
        found = self.slices[:, cells[0]]
        for more in cells[1:]:
            found = found & self.slices[:, more]
        return found

    def mistaken(self) -> np.ndarray:
        """Per language: the share of foreign n-grams that its filter holds."""
        full = [(self.slices[i >> 3] >> np.uint8(i & 7) & 1).mean() for i in range(len(self.languages))]
        return np.array(full) ** CELLS_A_GRAM

    def counts(self, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: n-grams that each language contains, n-grams in all, and whether it has a letter."""
        hits = np.zeros((len(texts), 8 * len(self.slices)), dtype=np.int64)
        total, lettered = np.zeros(len(texts), dtype=np.int64), np.zeros(len(texts), dtype=bool)
        bits = (np.arange(256)[:, None] >> np.arange(8)[None, :]) & 1
        for numbers, group in _pieces(texts):
            owners, grams, with_letter = _grams(numbers, group)
            lettered[with_letter] = True
            first = numbers[0]
            width = numbers[-1] - first + 1
            total[first : first + width] += np.bincount(owners - first, minlength=width)
            for i, found in enumerate(self.containing(grams)):
                by_byte = np.bincount((owners - first) * 256 + found, minlength=256 * width).reshape(width, 256)
                hits[first : first + width, 8 * i : 8 * i + 8] += by_byte @ bits
        return hits[:, : len(self.languages)], total, lettered

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        hits, total, lettered = self.counts(texts)
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        rate = np.minimum(self.mistaken(), 0.999)
        corrected = np.maximum(0.0, (hits - total[:, None] * rate) / (1 - rate))
        everything = corrected.sum(axis=1)
        best = np.where(everything > 0, corrected.argmax(axis=1), int(np.argmax(self.rows)))
        share = corrected[np.arange(len(texts)), best] / np.where(everything > 0, everything, 1.0)
        names = [self.languages[b] if known else UNKNOWN for b, known in zip(best.tolist(), lettered.tolist())]
        return names, np.where(lettered, np.round(share, 9), 0.0).tolist()


def fold(key: Column) -> Column:
    """crc32 of the id as text, modulo 4; fold 2 is held out from learning."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 4


def _sample(docs: DataFrame, key: str, text: str, lang: str, sample_rows: int) -> tuple[DataFrame, dict[str, int]]:
    """Distinct rows (lang, text) to learn from, and how many usable rows each language has."""
    usable = docs.select(
        F.col(key).cast("string").alias("id"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")
    ).where((fold(F.col(key)) != 2) & F.col(text).isNotNull() & F.col(lang).isNotNull())
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return usable.select("lang", "text"), sizes
    share = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, min(1.0, sample_rows / n))])
    drawn = F.pmod(F.xxhash64("id", "text"), F.lit(1_000_000)) < 1_000_000 * F.element_at(share, F.col("lang"))
    return usable.where(drawn).distinct().select("lang", "text"), sizes


def learn(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS
) -> LanguageFilters:
    """Filters of all languages that occur outside the held-out fold."""
    sample, sizes = _sample(docs, key, text, lang, sample_rows)
    languages = sorted(sizes)
    if not languages:
        return LanguageFilters((), (), np.zeros((1, CELLS), dtype=np.uint8))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1).to_pylist()
            for name in sorted(set(own)):
                for numbers, group in _pieces([texts[i] for i in np.flatnonzero(own == name)]):
                    grams, counts = np.unique(_grams(numbers, group)[1], return_counts=True)
                    yield pa.RecordBatch.from_pydict(
                        {"lang": [name] * len(grams), "gram": grams.view(np.int64), "n": counts}, schema=fields
                    )

    fields = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())])
    counted = durable(
        sample.select("lang", "text")
        .mapInArrow(count, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n")),
        "language-grams",
    )
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    if not totals:
        return LanguageFilters(tuple(languages), tuple(sizes[n] for n in languages), np.zeros((-(-len(languages) // 8), CELLS), dtype=np.uint8))
    total = F.create_map(*[F.lit(x) for item in totals.items() for x in item])
    number = F.create_map(*[F.lit(x) for i, name in enumerate(languages) for x in (name, i)])
    # Rows of one n-gram: at most one a language.
    elsewhere = F.max("share").over(Window.partitionBy("gram"))
    at_home = (
        counted.withColumn("share", F.col("n") / F.element_at(total, F.col("lang")))
        .withColumn("most", elsewhere)
        .where((F.col("share") >= MIN_SHARE) & (F.col("share") >= AT_HOME * F.col("most")))
        .withColumn("number", F.element_at(number, F.col("lang")))
    )
    cells = F.array(*[F.shiftrightunsigned("gram", CELL_BITS * i).bitwiseAND(F.lit(CELLS - 1)) for i in range(CELLS_A_GRAM)])
    set_bits = (
        at_home.select(F.explode(cells).alias("cell"), "number")
        .groupBy("cell", F.shiftright("number", 3).alias("slice"))
        .agg(F.bit_or(F.expr("shiftleft(1, number % 8)")).cast("int").alias("bits"))
    )
    slices = np.zeros((-(-len(languages) // 8), CELLS), dtype=np.uint8)
    found = set_bits.toArrow()  # at most the filter itself: a row for each cell and eight languages
    slices[found["slice"].to_numpy(), found["cell"].to_numpy()] = found["bits"].to_numpy()
    return LanguageFilters(tuple(languages), tuple(sizes[n] for n in languages), slices)


def predicted(docs: DataFrame, filters: LanguageFilters, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred and score."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def per_batch(ids, held, texts):
        names, scores = shared.value.predict(texts)
        return {"doc_id": ids, "held_out": held, "lang_pred": names, "score": scores}

    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), (fold(F.col(key)) == 2).alias("held_out"), F.col(text).alias("text"))
    fields = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
    schema = "doc_id bigint, held_out boolean, lang_pred string, score double"
    return map_rows(rows, ["doc_id", "held_out", "text"], schema, fields, per_batch)
