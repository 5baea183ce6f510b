"""Digests and scores against plain accounts of them, and rows without ids or with repeated ones."""

from __future__ import annotations

import gzip
import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tallymark.llm import decontaminate, jaccard, pii, quality, rules, substrings, warc
from tallymark.llm.common import table
from tallymark.llm.queries import QUERIES


# Quality classifier


def plain_ftrl(examples):
    """Follow-the-regularised-leader, a weight at a time, over examples of ({slot: value}, label)."""
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)

    for _ in range(quality.EPOCHS):
        for features, label in examples:
            now = {i: weight(i) for i in features}
            error = 1 / (1 + math.exp(-sum(now[i] * v for i, v in features.items()))) - label
            for i, v in features.items():
                g = error * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * now[i]
                n[i] += g * g
    return {i: weight(i) for i in z}


def plain_features(text):
    slots = Counter(quality.slots_of(text).tolist())
    out = defaultdict(float, {i: quality.SCALE * c / max(1, slots.total()) for i, c in slots.items()})
    out[0] += 1.0
    return out


def test_scores_equal_a_plain_ftrl(spark, small_dir):
    docs, labels = table(spark, small_dir, "documents"), table(spark, small_dir, "labels")
    taken = (
        docs.join(labels, "doc_id")
        .where(quality.fold(F.col("doc_id")) != 2)
        .select(
            F.xxhash64("doc_id", F.xxhash64("text"), F.lit(7)).alias("place"),
            F.pmod(F.xxhash64("doc_id", F.xxhash64("text")), F.lit(quality.SHARDS)).alias("shard"),
            "quality",
            "text",
        )
        .collect()
    )
    total = defaultdict(float)
    for shard in {r.shard for r in taken}:
        own = sorted((r.place, r.quality, r.text) for r in taken if r.shard == shard)
        for i, w in plain_ftrl([(plain_features(t), y) for _, y, t in own]).items():
            total[i] += w * len(own) / len(taken)
    scores = {r.doc_id: r for r in QUERIES["op2_quality_classifier"](spark, small_dir).collect()}
    for r in docs.collect():
        margin = sum(total[i] * v for i, v in plain_features(r.text).items())
        assert scores[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-4)
        assert scores[r.doc_id].predicted == int(scores[r.doc_id].score >= 0.7)


def test_the_sample_is_bounded_whatever_repeats(spark):
    """One id with many labels and many texts, and rows repeated often: no more rows are learnt from than allowed."""
    learnt = [i for i in range(3010) if zlib.crc32(str(i).encode()) % 4 != 2]
    many, same = learnt[:2]
    docs = spark.range(3000).select(F.lit(many).cast("bigint").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    docs = docs.union(spark.range(3000).select(F.lit(same), F.lit("again and again")))
    docs = docs.union(spark.range(10, 3010).selectExpr("id", "concat('t', id)"))
    labels = spark.range(2000).select(F.lit(many).cast("bigint").alias("doc_id"), (F.col("id") % 2).cast("int").alias("quality"))
    labels = labels.union(spark.range(2000).select(F.lit(same), F.lit(1))).union(spark.range(10, 3010).selectExpr("id", "0"))
    labels = labels.union(spark.range(5).selectExpr("cast(null AS bigint)", "1"))
    everything = 2 * 3000 + 1 + sum(i >= 10 for i in learnt)
    rows = quality.training_rows(docs, labels, "quality", "doc_id", "text", 600).collect()
    assert 450 < len(rows) < 750
    assert max(Counter(r._shard for r in rows).values()) < 200
    assert len({(r._order, r._label) for r in rows}) == len(rows)
    assert quality.training_rows(docs, labels, "quality", "doc_id", "text", 10**6).count() == everything


def test_null_ids_are_not_held_out(spark):
    docs = spark.createDataFrame([(None, "a"), (1, None)], "doc_id bigint, text string")
    held = docs.select((quality.fold(F.col("doc_id")) == 2).alias("held"))
    assert None not in {r.held for r in held.collect()}


# Substring dedup


def passages(seed=4):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    shared = [" ".join(rng.choices(words, k=n)) for n in (50, 53, 90, 49)]
    filler = lambda n: " ".join(rng.choices(words, k=n))
    return [f"{filler(rng.randrange(30))} {rng.choice(shared)} {filler(rng.randrange(60))}" for _ in range(40)] + ["z " * 70, "z " * 90 + "y"]


def plain_removed(texts, length=50):
    """For each text the words of windows that start in an earlier one."""
    first, out = {}, []
    for number, text in enumerate(texts):
        words = text.split()
        for start in range(len(words) - length + 1):
            first.setdefault(tuple(words[start : start + length]), number)
    for number, text in enumerate(texts):
        words, gone = text.split(), set()
        for start in range(len(words) - length + 1):
            if first[tuple(words[start : start + length])] < number:
                gone.update(range(start, start + length))
        out.append((number, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


@pytest.mark.parametrize("bits", [64, 5])
def test_removed_words_do_not_depend_on_the_hash(spark, bits):
    """With five bits most windows share a hash with different ones: their words decide."""
    texts = passages()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = substrings.repeated_substrings(docs, hash_bits=bits).collect()
    want = plain_removed(texts)
    assert sorted((r.doc_id, r.n_words, r.n_removed) for r in found) == [w[:3] for w in want]
    digests = {r.doc_id: r.kept_sha256 for r in found}
    assert all(digests[n] == hashlib.sha256(kept.encode()).hexdigest() for n, _, _, kept in want)
    assert sum(removed > 0 for _, _, removed, _ in want) > 10


def test_repeats_are_maximal(spark):
    """A repeat goes as far as the words agree, and has the place it has in the earliest holder."""
    one = [f"a{i}" for i in range(200)]
    two = ["x"] * 7 + one[20:120] + ["y"] + one[150:200]
    placed = []
    for doc_id, words in ((1, one), (2, two), (3, one[:60])):
        hashes = {" ".join(words[s : s + 50]): s for s in range(len(words) - 49)}
        placed += [(doc_id, 10 * doc_id, start, hash(text)) for text, start in hashes.items()]
    frame = spark.createDataFrame(placed, "doc_id bigint, fp bigint, start int, window bigint")
    found = {tuple(r) for r in substrings._repeats(frame, 50).collect()}
    assert found == {(2, 20, 7, 100, 1, 10, 20), (2, 20, 108, 50, 1, 10, 150), (3, 30, 0, 60, 1, 10, 0)}


# Personal data


def plain_spans(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        ("ip", m)
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
        if all(int(p) <= 255 for p in m[0].split("."))
    ]
    found += [
        ("card", m)
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))
    ]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    kinds = ("email", "ip", "card", "phone")
    return sorted(((k, *m.span()) for k, m in found), key=lambda s: (s[1], kinds.index(s[0])))


def test_digests_and_counts_of_personal_data(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    some = Counter()
    for r in QUERIES["op8_pii"](spark, sf_dir).collect():
        base = plain_spans(texts[r.doc_id])
        counts = Counter(k for k, *_ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(counts[k] for k in ("email", "ip", "card", "phone"))
        joined = [f"{k}:{a}:{b}" for k, a, b in base]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(joined) <= set(spans) and [s for s in spans if s.split(":")[0] in pii.BASE_KINDS] == joined
        some.update(counts)
    assert all(some[k] for k in ("email", "ip", "card"))


# WARC


def test_every_index_entry_is_a_member_for_another_reader(spark, small_dir, tmp_path):
    pages = table(spark, small_dir, "pages")
    warc.archive_pages(pages, f"file://{tmp_path}/w").collect()
    seen = Counter()
    for index in (tmp_path / "w").glob("members-*.index"):
        content = index.with_name(index.name.replace(".index", ".warc.gz")).read_bytes()
        end = 0
        for line in index.read_text().splitlines():
            page_id, offset, length = json.loads(line)
            assert offset == end
            end = offset + length
            record = gzip.decompress(content[offset:end])
            head, _, block = record.partition(b"\r\n\r\n")
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:] if ": " in x)
            assert head.startswith(b"WARC/1.1") and len(block) == int(fields["Content-Length"]) + 4
            assert str(page_id) == fields["X-Page-ID"]
            seen[int(page_id)] += 1
        assert end == len(content)
        assert len(gzip.decompress(content)) > 0  # and the whole file is one gzip stream to others
    assert seen == Counter(r.page_id for r in pages.collect())


# Quality rules


def test_estimates_tell_the_share_each_rule_rejects(spark, small_dir):
    rows, own = rules.base_measures(table(spark, small_dir, "documents")), rules.standard_rules()
    total = rows.count()
    for rule, found in zip(own, rules.estimate(rows, own)):
        assert found.name == rule.name and found.seconds >= 0
        assert found.rejected == pytest.approx(rows.where(rule.rejects).count() / total)
    assert {e.rejected for e in rules.estimate(rows.where("false"), own)} == {0.0}


# Decontamination and the pipeline


def test_the_stage_judges_texts_and_not_ids(spark, small_dir):
    item = table(spark, small_dir, "benchmark").first().text
    rows = [(1, f"so it begins {item} and ends"), (1, "nothing of that here at all"), (None, item), (None, "clean as well"), (4, None)]
    docs = spark.createDataFrame([(*r, "en", "s", 0) for r in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    kept = corpus_pipeline.decontaminated(spark, docs, small_dir)
    assert {(r.doc_id, r.text) for r in kept.collect()} == {(1, rows[1][1]), (None, "clean as well"), (4, None)}
    assert kept.columns == docs.columns


def test_items_shorter_than_a_shingle_equal_all_windows(spark):
    items = spark.createDataFrame([(1, "alpha"), (2, "beta gamma"), (3, "a b c d"), (4, "a b c d e"), (5, "q r s t u v")], "item_id bigint, text string")
    texts = ["alpha beta", "beta gamma alpha", "x a b c d e y", "Q, r; s t u v!", "q r s t u", "beta", ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    words = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    want = set()
    for i, t in enumerate(texts):
        for r in items.collect():
            item = words(r.text)
            size = min(5, len(item))
            grams = lambda ws: [tuple(ws[k : k + size]) for k in range(len(ws) - size + 1)]  # noqa: E731, B023
            own, g = grams(words(t)), Counter(grams(item))
            for s in range(max(1, len(own) - g.total() + 1)):
                window = Counter(own[s : s + g.total()])
                both = (window & g).total()
                if window and both / (window.total() + g.total() - both) >= 0.8:
                    want.add((i, r.item_id))
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == want and len(want) >= 6


# Words of the Jaccard join


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aAbZ é日\n\t\x0b", max_size=60), max_size=4), st.integers(1, 40))
def test_hashes_of_words_do_not_depend_on_pieces(texts, piece):
    """Equal words have equal hashes wherever they stand, and different words different ones."""
    before, seen = jaccard.PIECE, {}
    for text in texts:
        content = jaccard._LOWER[jaccard.np.frombuffer(text.encode(), dtype=jaccard.np.uint8)]
        words = content.tobytes().split()
        whole = jaccard.word_hashes(content).tolist()
        jaccard.PIECE = piece
        try:
            assert jaccard.word_hashes(content).tolist() == whole
        finally:
            jaccard.PIECE = before
        assert len(whole) == len(words) and all(seen.setdefault(w, h) == h for w, h in zip(words, whole))
    assert len(set(seen.values())) == len(seen)
