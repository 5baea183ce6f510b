"""Importance resampling, filter audit and language ID against brute force, with awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from tallymark.llm import audit, language, resampling
from tallymark.llm.common import table
from tallymark.llm.queries import QUERIES

LONG = "x" * 70
AWKWARD = [
    (0, None, "en", "a"),
    (1, "", "en", "a"),
    (None, " \t\n ", "en", None),
    (3, "One", None, ""),
    (4, "A b-C_d9 é日本 " + LONG, "fr", "b"),
    (5, "the same text " * 30, "en", "b"),
    (6, "the same text " * 30, "en", "b"),
    (6, "the same text " * 30, "en", "b"),
    (None, "the same text " * 30, "en", "b"),
    (6, "another text # with the same id", "en", "c"),
    (9, "12 34 -- 56", "en", "c"),
    (10, " ".join(f"w{i} LOUD" for i in range(3000)), "de", "a"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(*row, None, "x") for row in AWKWARD]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, rank string, first string"
    )


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


# Importance resampling


def brute_buckets(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), Counter(zlib.crc32(run.encode()) % 10_000 for run in runs)


def brute_ranking(rows, target, percent, min_words):
    own, s, t = [brute_buckets(text) for _, text in rows], Counter(), Counter()
    for _, buckets in own:
        s.update(buckets)
    for text in target:
        t.update(brute_buckets(text)[1])
    total_s, total_t = s.total(), t.total()
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (total_s + 10_000) / ((s[b] + 1) * (total_t + 10_000)))) for b in s
    }
    out = []
    for (doc_id, _), (n_words, buckets) in zip(rows, own):
        name = f"42:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] * n for b, n in buckets.items())
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, buckets.total(), weight, score, n_words >= min_words])
    fit = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): i + 1 for i, r in enumerate(fit[: percent * len(fit) // 100])}
    return Counter((*r[:4], ranks.get(id(r))) for r in out)


def test_ranking_equals_brute_force(spark, awkward, nothing, small_dir):
    target = spark.createDataFrame([("the same text é日本",), (None,), ("W1 loud w2",)], "text string")
    wanted = [r.text for r in target.collect()]
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    found = resampling.ranked(awkward, target, percent=50, min_words=2).drop("fp")
    assert Counter(map(tuple, found.collect())) == brute_ranking(rows, wanted, 50, 2)
    none = resampling.ranked(awkward, target.where("false"), min_words=2).drop("fp")
    assert Counter(map(tuple, none.collect())) == brute_ranking(rows, [], 5, 2)
    assert resampling.ranked(nothing, target).count() == 0
    drawn = resampling.resampled(awkward, target, percent=50, min_words=2)
    assert drawn.columns == awkward.columns and 0 < drawn.count() < len(AWKWARD)
    docs, bench = table(spark, small_dir, "documents"), table(spark, small_dir, "benchmark")
    found = resampling.ranked(docs, bench).drop("fp").collect()
    want = brute_ranking([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in bench.collect()], 5, 20)
    assert Counter(map(tuple, found)) == want


def features(texts):
    counts, buckets = np.zeros(len(texts), dtype=int), [Counter() for _ in texts]
    for numbers, n_words, found in resampling._worked_off(texts):
        np.add.at(counts, numbers, n_words)
        for owners, own in found:
            for owner, bucket in zip(owners.tolist(), own.tolist()):
                buckets[numbers[owner]][bucket] += 1
    return [(n, b) for n, b in zip(counts.tolist(), buckets)]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="aZ é9-\x00日", max_size=40), max_size=6), st.integers(1, 30))
def test_features_do_not_depend_on_pieces(texts, piece):
    before, resampling.PIECE = resampling.PIECE, piece
    try:
        assert features(texts) == [brute_buckets(t) for t in texts]
    finally:
        resampling.PIECE = before


def test_checksums_of_long_words():
    words = ["a" * n for n in (1, 47, 48, 49, 200)]
    text = " ".join(words + words[::-1])
    assert features([text]) == [brute_buckets(text)]


def test_equal_rows_are_drawn_in_full(spark):
    """A third of all rows alike: none is lost, and each has a rank of its own."""
    rows = [(7, "many words " * 12)] * 200 + [(i, f"other words {i} " * 8) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    target = spark.createDataFrame([("many words many",)], "text string")
    found = resampling.ranked(docs, target, percent=40).collect()
    assert len(found) == 600
    assert sorted(r["rank"] for r in found if r["rank"]) == list(range(1, 241))
    assert Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in found) == brute_ranking(
        rows, ["many words many"], 40, 20
    )


# Filter audit


def brute_audit(rows, labels):
    first, good, toxic = {}, set(), set()
    for doc_id, text, source in rows:
        if doc_id is not None:
            first[text or ""] = min(doc_id, first.get(text or "", doc_id))
    for doc_id, q, x in labels:
        if doc_id is None:
            continue
        good |= {doc_id} if q == 1 else set()
        toxic |= {doc_id} if x == 1 else set()
    out = defaultdict(Counter)
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and first[text] < doc_id,
        }
        for order in permutations("ABCDE"):
            gone = False
            for step, letter in enumerate(order, 1):
                own = out[source or "", "".join(order), step]
                removed = fails[letter] and not gone
                own["kept"] += not fails[letter] and not gone
                own["removed"] += removed
                own["redundant"] += fails[letter] and gone
                own["unique_fails"] += fails[letter] and sum(fails.values()) == 1
                own["good_lost"] += removed and doc_id in good
                own["toxic_lost"] += removed and doc_id in toxic
                out[source or "", letter]["shapley"] += removed
                gone |= fails[letter]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return Counter(
        (*key, *[counts[n] for n in names], out[key[0], key[1][key[2] - 1]]["shapley"])
        for key, counts in out.items()
        if len(key) == 3
    )


LABELS = [(5, 1, 0), (6, 1, 1), (6, 0, None), (None, 1, 1), (10, None, 1), (77, 1, 1)]


@pytest.mark.parametrize("cells", [audit.CELLS_PER_ROW, 10_000])
def test_audit_equals_brute_force(spark, awkward, nothing, cells, monkeypatch):
    monkeypatch.setattr(audit, "CELLS_PER_ROW", cells)
    labels = spark.createDataFrame(LABELS, "doc_id bigint, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in awkward.collect()]
    found = audit.filter_audit(awkward, labels).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
    assert Counter(map(tuple, found.collect())) == brute_audit(rows, LABELS)
    assert audit.filter_audit(nothing, labels).count() == 0


def test_a_full_sketch_changes_nothing(spark, small_dir, monkeypatch):
    docs = table(spark, small_dir, "documents")
    rows = audit.flagged(docs)
    small = audit.repeat_sketch(rows, audit.BLOCK_BITS)
    full = np.full(1 << 13, 255, dtype=np.uint8)
    assert audit.possible_repeats(rows, small).where("_possible").count() < rows.count()

    def masks():
        return Counter((r.doc_id, r.mask) for r in audit.failures(docs).collect())

    want = masks()
    monkeypatch.setattr(audit, "repeat_sketch", lambda *_: full)
    assert masks() == want


def test_the_sketch_clears_only_unique_texts(spark):
    rows = spark.range(60_000).selectExpr("xxhash64(id DIV 2) AS fp", "id").union(
        spark.range(60_000).selectExpr("xxhash64('u', id) AS fp", "-1L AS id")
    )
    marked = audit.possible_repeats(rows, audit.repeat_sketch(rows, 20))
    assert marked.where("NOT _possible AND id >= 0").count() == 0
    assert marked.where("NOT _possible AND id < 0").count() > 50_000


@pytest.mark.parametrize("piece", [1, 7, 64])
def test_word_counts_do_not_depend_on_pieces(piece, monkeypatch):
    monkeypatch.setattr(audit, "PIECE", piece)
    for _, text, *_ in AWKWARD:
        words = (text or "").encode().split()
        assert audit._word_counts((text or "").encode()) == (len(words), len(set(words)))


# Language ID


def brute_grams(text):
    spaced = "".join(c if c.isalpha() else " " for c in text)
    words = ["".join(c.lower() if len(c.lower()) == 1 else c for c in w) for w in spaced.split()]
    padded = [f" {w} " for w in words]
    return Counter(w[i : i + n] for w in padded for n in (2, 3, 4) for i in range(len(w) - n + 1) if " " not in w[i + 1 : i + n - 1])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="abÉ日 .7\nİ", max_size=25), max_size=5))
def test_grams_lie_in_words(texts):
    want = [brute_grams(t).total() for t in texts]
    filters = language.LanguageFilters(("x",), (1,), np.full((1, language.CELLS), 1, dtype=np.uint8))
    hits, total, lettered = filters.counts(texts)
    assert total.tolist() == want and hits[:, 0].tolist() == want
    assert lettered.tolist() == [any(c.isalpha() for c in t) for t in texts]
    distinct = {h for numbers, group in language._pieces(texts) for h in language._grams(numbers, group)[1].tolist()}
    assert len(distinct) == len(set().union(*map(brute_grams, texts)))


def test_long_texts_are_cut_between_words(spark, small_dir, monkeypatch):
    docs = table(spark, small_dir, "documents")
    filters = language.learn(docs)
    texts = [r.text for r in docs.limit(30).collect()] + [r[1] for r in AWKWARD]
    whole = filters.counts(texts)
    monkeypatch.setattr(language, "PIECE", 200)
    for a, b in zip(whole, filters.counts(texts)):
        assert np.array_equal(a, b)


def test_filters_hold_all_that_is_at_home(spark, sf_dir):
    """No n-gram that makes up enough of one language is missing from that language's filter."""
    docs = table(spark, sf_dir, "documents")
    filters = language.learn(docs)
    used = docs.where((language.fold(docs.doc_id) != 2)).select("doc_id", "text", "lang").distinct().collect()
    counts = {name: Counter() for name in filters.languages}
    for name in filters.languages:
        for numbers, group in language._pieces([r.text for r in used if r.lang == name]):
            counts[name].update(language._grams(numbers, group)[1].tolist())
    shares = {n: {g: k / c.total() for g, k in c.items()} for n, c in counts.items()}
    for i, name in enumerate(filters.languages):
        home = [
            g
            for g, s in shares[name].items()
            if s >= language.MIN_SHARE and s >= language.AT_HOME * max(o.get(g, 0) for o in shares.values())
        ]
        held = filters.containing(np.array(home, dtype=np.uint64))[i >> 3] >> (i & 7) & 1
        assert len(home) > 100 and held.all()
        foreign = np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.uint64)
        rate = (filters.containing(foreign)[i >> 3] >> (i & 7) & 1).mean()
        assert abs(rate - filters.mistaken()[i]) < 0.005


def test_predictions(spark, sf_dir, awkward, nothing):
    docs = table(spark, sf_dir, "documents")
    found = QUERIES["op13_language_id"](spark, sf_dir).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(found) == docs.count()
    held = [r for r in found if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)

    filters = language.learn(docs)
    rows = {(r.doc_id, r.lang_pred) for r in language.predicted(awkward, filters).collect()}
    assert {(0, "und"), (1, "und"), (None, "und"), (9, "und")} <= rows
    assert language.predicted(awkward, filters).count() == len(AWKWARD)
    assert language.predicted(nothing, filters).count() == 0
    # Letters that no language knows: the language with the most rows.
    strange = spark.createDataFrame([(1, "Ѡѡѡ")], "doc_id bigint, text string")
    assert [tuple(r)[2:] for r in language.predicted(strange, filters).collect()] == [("en", 0.0)]
    unlearnt = language.learn(nothing)
    assert {r.lang_pred for r in language.predicted(awkward, unlearnt).collect()} == {"und"}


def test_more_languages_than_bits_of_a_byte(spark):
    letters = "abcdefghijkl"
    rows = [(i * 12 + k, f"{c}{c}x {c}y{c} " * 5, f"l{c}") for i in range(8) for k, c in enumerate(letters)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = language.learn(docs)
    assert filters.slices.shape == (2, language.CELLS) and len(filters.languages) == 12
    texts, langs = [r[1] for r in rows], [r[2] for r in rows]
    assert filters.predict(texts)[0] == langs


def test_learning_ignores_held_out_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 4 == 2)
    docs = spark.createDataFrame([(held, "abc", "xx"), (None, "def", "yy"), (None, "def", None)], "doc_id bigint, text string, lang string")
    assert language.learn(docs).languages == ("yy",)


def test_arrow_types_are_those_promised(awkward, spark):
    for df in (resampling.ranked(awkward, awkward), language.predicted(awkward, language.learn(awkward))):
        assert isinstance(df.toArrow(), pa.Table)
