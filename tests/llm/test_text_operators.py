"""The text operators against libraries, SQL and brute force, with awkward rows."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter
from itertools import combinations

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from compare import assert_same
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm import byte_bpe, chat, decontaminate, jaccard, pii, quality, rules, substrings, token_counts, warc
from tallymark.llm.common import table
from tallymark.llm.divide_skip import divide_skip
from tallymark.llm.queries import QUERIES
from tallymark.llm.sql import ORACLES

AWKWARD = [None, "", " \t\n ", "one", "ab c<|endoftext|>d\x1c ½² it's I'LL  \n\n x", "aaaa" * 300, "日本語 🙂　x", "a b " * 3000]


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [(i if i != 2 else None, t, "en", None) for i, t in enumerate(AWKWARD)]
    return spark.createDataFrame([*rows, rows[4], rows[5]], "doc_id bigint, text string, shingle string, n_tokens string")


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(name, spark, small_dir, small_duck):
    assert_same(QUERIES[name](spark, small_dir), small_duck, ORACLES[name])


def tiktoken_encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts_equal_the_library(spark, awkward, nothing, small_dir):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for docs in (awkward, table(spark, small_dir, "documents")):
        want = Counter(
            (r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 1024)
            for r in docs.collect()
        )
        assert Counter(map(tuple, token_counts.token_counts(docs).collect())) == want
    assert token_counts.token_counts(nothing).count() == 0


def test_byte_bpe_equals_the_library_and_decodes(spark, awkward, nothing, small_dir):
    library = tiktoken_encoding()
    for docs in (awkward, table(spark, small_dir, "documents")):
        rows = docs.collect()
        want = Counter((r.doc_id, tuple(library.encode_ordinary(r.text or ""))) for r in rows)
        encoded = byte_bpe.encode_texts(docs)
        assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
        decoded = Counter((r.doc_id, bytes(r.content)) for r in byte_bpe.decode_ids(encoded).collect())
        assert decoded == Counter((r.doc_id, (r.text or "").encode()) for r in rows)
    assert byte_bpe.encoding_digests(nothing).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_merges_on_any_text(text):
    own = byte_bpe.codec()
    assert next(own.encode([text])) == tiktoken_cached().encode_ordinary(text)


def tiktoken_cached(held=[]):  # noqa: B006
    if not held:
        held.append(tiktoken_encoding())
    return held[0]


def test_classifier_on_the_held_out_fold(spark, sf_dir, awkward, nothing):
    labels = table(spark, sf_dir, "labels")
    scored = QUERIES["op2_quality_classifier"](spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50
    assert sum(r.predicted == r.quality for r in scored) / len(scored) > 0.95
    weights = quality.train(nothing, labels.where("false"))
    assert {r.score for r in quality.score(awkward, weights).collect()} == {0.5}
    assert quality.score(nothing, weights).count() == 0
    folds = labels.select("doc_id", quality.fold(labels.doc_id).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 4 for r in folds)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), unique=True).map(sorted), max_size=12), st.integers(1, 6))
def test_divide_skip_equals_counting(lists, needed):
    counts = Counter(m for own in lists for m in own)
    assert divide_skip(lists, needed) == {m: c for m, c in counts.items() if c >= needed}


def near_copies(count=60, words=120, seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(words)]
    texts = []
    for _ in range(count):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(words)] = rng.choice(vocabulary)
        texts.append(" ".join(own))
    return texts


def brute_components(rows):
    def shingle_set(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words[i : i + 4]) for i in range(max(1, len(words) - 3))} if words else set()

    sets = [shingle_set(t) for _, t in rows]
    least = [i for i, _ in rows]
    links = [
        (a, b)
        for a, b in combinations(range(len(rows)), 2)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    for _ in rows:
        for a, b in links:
            least[a] = least[b] = min((x for x in (least[a], least[b]) if x is not None), default=None)
    return Counter((i, len(s), c) for (i, _), s, c in zip(rows, sets, least))


def test_dense_group_of_near_copies(spark):
    rows = list(enumerate([*near_copies(), *near_copies(30, 12, 4), "A b C d", "a B c D", "x y", "X y"]))
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in found.drop("fp").collect()) == brute_components(rows)


def test_jaccard_awkward_rows(awkward, nothing):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter(tuple(r) for r in jaccard.jaccard_components(awkward).drop("fp").collect()) == brute_components(rows)
    assert jaccard.jaccard_components(nothing).count() == 0
    assert jaccard.one_of_each(awkward).columns == awkward.columns


LETTERS = "a b c d e f g h i j k l m n o p q r s t u v w x y z aa bb".split()


def test_rows_without_id_link_like_others(spark):
    """As an end of a link, and as the only bridge between two others."""
    texts = [" ".join(LETTERS[i : i + 26]) for i in range(3)]
    rows = [(5, texts[0]), (None, texts[1]), (9, texts[2]), (7, "other words than those"), (None, "all alone here now")]
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in found.drop("fp").collect()) == brute_components(rows)
    assert (9, 5) in {(r.doc_id, r.component_id) for r in found.collect()}


def test_repeated_rows_do_not_multiply(spark, monkeypatch):
    base = near_copies(3, 200, 9)
    rows = [(1, base[0])] * 200 + [(2, base[1])] * 200 + [(3, base[2])] + [(n, t) for n, t in enumerate(near_copies(20, 200, 9), 10)]
    sizes, verified = [], jaccard._verified

    def counted(pairs, classes, texts):
        found = verified(pairs, classes, texts)
        sizes.append((pairs.count(), found.count()))
        return found

    monkeypatch.setattr(jaccard, "_verified", counted)
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert Counter(tuple(r) for r in found.drop("fp").collect()) == brute_components(rows)
    assert all(links <= pairs for pairs, links in sizes) and sum(p for p, _ in sizes) < 100


def test_lists_are_searched_in_tiles_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 3)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    monkeypatch.setattr(jaccard, "CHUNK", 2)
    monkeypatch.setattr(jaccard, "SHORT_LIST", 3)
    rows = list(enumerate([*near_copies(40, 60, 5), *near_copies(30, 60, 6)]))
    found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6))
    assert Counter(tuple(r) for r in found.drop("fp").collect()) == brute_components(rows)


def test_shared_rows_of_a_sorted_stream():
    rows = [(1, 5, 1), (2, 5, 1), (2, 5, 1), (3, 5, 1), (3, 6, 2), (3, 7, 3), (4, 1, 1), (5, 1, 1), (5, 2, 2)]
    counts = Counter(r[0] for r in set(rows))
    want = sorted({r for r in rows if counts[r[0]] > 1})
    for size in (1, 2, 3, 4, 9):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i : i + size])], names=["shingle", "size", "sid"])
            for i in range(0, len(rows), size)
        ]
        assert list(jaccard._shared(iter(batches))) == want


def brute_substrings(rows, length=50):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, own in words:
        for s in range(len(own) - length + 1):
            if i is not None:
                first[tuple(own[s : s + length])] = min(i, first.get(tuple(own[s : s + length]), i))
    out = []
    for i, own in words:
        gone = set()
        for s in range(len(own) - length + 1):
            if i is not None and first[tuple(own[s : s + length])] < i:
                gone.update(range(s, s + length))
        kept = " ".join(w for k, w in enumerate(own) if k not in gone)
        out.append((i, len(own), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


def test_substrings_equal_brute_force(spark, awkward, nothing):
    rng = random.Random(1)
    passage = " ".join(f"p{rng.randrange(500)}" for _ in range(70))
    other = " ".join(f"q{rng.randrange(500)}" for _ in range(49))
    filler = lambda: " ".join(f"f{rng.randrange(9000)}" for _ in range(rng.randrange(0, 40)))
    texts = [f"{filler()} {p} {filler()}" for p in [passage, other, f"{passage} {other}"] * 8]
    rows = [*enumerate(texts), (99, texts[0]), (99, texts[5]), (None, texts[0]), (100, "z " * 200)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert Counter(map(tuple, substrings.repeated_substrings(docs).drop("kept").collect())) == brute_substrings(rows)
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert Counter(map(tuple, substrings.repeated_substrings(awkward).drop("kept").collect())) == brute_substrings(rows)
    assert substrings.repeated_substrings(nothing).count() == 0


def test_rules_awkward_rows_and_order(spark, awkward, nothing):
    rows = rules.quality_rules(awkward).collect()
    assert len(rows) == len(AWKWARD) + 2
    empty = next(r for r in rows if r.doc_id == 0)
    assert tuple(empty) == (0, 0, 0, 0, 0, 0, True, False)
    assert rules.quality_rules(nothing).count() == 0
    names = [rules.Rule(n, None) for n in "abc"]
    estimates = [rules.Estimate("a", 1.0, 0.1), rules.Estimate("b", 0.1, 0.1), rules.Estimate("c", 0.1, 0.5)]
    assert [r.name for r in rules.ordered(names, estimates)] == ["c", "b", "a"]


def parsed_back(role, text):
    rendered = chat.render(role, text)
    assert list(chat.parse(rendered)) == [(role, text)]
    return rendered


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["user", "assistant", "system", "", "<s>", "\\"]),
            st.lists(st.sampled_from(["</s>", "[INST] ", " [/INST]", "<", "\\", "[", " ", "x", "<<:>>", "<</SYS>>"])).map("".join),
        )
    )
)
def test_chat_round_trip(turns):
    assert list(chat.parse("".join(parsed_back(*turn) for turn in turns))) == turns


def test_chat_awkward_rows(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 0, None, "b"), (1, 1, "assistant", "</s>"), (1, 1, "assistant", "</s>"), (None, 0, "user", "x")],
        "conv_id bigint, turn bigint, role string, text string",
    )
    found = {r.conv_id: r for r in chat.chat_digests(turns).collect()}
    want = "\nb\nuser\n\n" + "assistant\n</s>\n" * 2
    assert found[1].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert (found[1].n_turns, found[1].loss_chars, found[None].n_turns) == (4, 8, 1)
    assert chat.chat_digests(turns.where("false")).count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="a1.@-_+ 25(9", max_size=40))
def test_pii_equals_plain_patterns(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    want = [("email", *m.span()) for m in EMAIL.finditer(text)]
    want += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    want += [
        ("card", *m.span())
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
        if 14 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))
    ]
    want += [
        ("phone", *m.span())
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
        if 10 <= len(digits(m[0])) <= 15
    ]
    assert sorted(s[:3] for s in pii.find_spans(text) if s.kind in pii.BASE_KINDS) == sorted(want)


def test_pii_checks_context_and_awkward_rows(awkward, nothing):
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82WEST12345698765432") and not pii.mod97("GB82WEST12345698765431")
    assert [s.kind for s in pii.find_spans("IBAN GB82 WEST 1234 5698 7654 32.")] == ["iban"]
    assert not pii.find_spans("part 123-45-6789") and pii.find_spans("ssn 123-45-6789")[0].kind == "national_id"
    text = "to a.b@c.example.com now"
    assert pii.redact(text, pii.find_spans(text)) == "to [EMAIL] now"
    assert pii.find_spans("a" * 300_000 + "1" * 300_000 + "@") == []
    assert {tuple(r)[1:5] for r in pii.pii_digests(awkward).collect()} == {(0, 0, 0, 0)}
    assert pii.pii_digests(nothing).count() == 0
    assert pii.redacted(awkward).count() == len(AWKWARD) + 2


def test_decontamination_finds_copies_and_leaves_clean_texts(spark, small_dir):
    rng = random.Random(2)
    item = [f"b{rng.randrange(10_000)}" for _ in range(60)]
    edited = item[:20] + ["changed"] + item[21:]
    half = item[:30] + [f"o{i}" for i in range(30)]
    pad = " ".join(f"x{i}" for i in range(40))
    rows = [
        (1, f"{pad} {' '.join(item)} {pad}"),
        (2, f"{pad}\n{' '.join(edited).upper()}! {pad}"),
        (3, f"{pad} {' '.join(half)}"),
        (4, pad),
        (5, None),
        (None, " ".join(item)),
        (6, f"say hello there {pad}"),
        (1, f"{pad} {' '.join(item)} {pad}"),
    ]
    docs = spark.createDataFrame([(*r, 0, "c") for r in rows], "doc_id bigint, text string, start int, item_id string")
    items = spark.createDataFrame([(7, " ".join(item)), (8, "Hello, there"), (9, None), (None, "x1 x2")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.similarity, r.start) for r in decontaminate.contaminated(docs, items).collect()}
    assert set(found) == {(1, 7), (2, 7), (6, 8)}
    assert found[1, 7] == (1.0, 40) and 0.8 <= found[2, 7][0] < 1
    assert decontaminate.contaminated(docs.where("false"), items).count() == 0
    assert decontaminate.contaminated(docs, items.where("false")).count() == 0


def test_decontamination_equals_all_windows(spark, small_dir):
    docs, items = table(spark, small_dir, "documents"), table(spark, small_dir, "benchmark")
    found = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontaminate.contaminated(docs, items).collect()}
    words = lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w]
    grams = lambda ws: [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]
    want, own_items = {}, {r.item_id: grams(words(r.text)) for r in items.collect()}
    for r in docs.collect():
        own = grams(words(r.text))
        held = set(own)
        for item_id, g in own_items.items():
            if len(held & set(g)) < 2:
                continue
            count = Counter(g)
            for s in range(max(1, len(own) - len(g) + 1)):
                window = Counter(own[s : s + len(g)])
                both = sum((window & count).values())
                sim = both / (sum(window.values()) + len(g) - both)
                if sim >= 0.8:
                    want[r.doc_id, item_id] = max(round(sim, 9), want.get((r.doc_id, item_id), 0))
    assert found == want and want


def test_warc_awkward_rows_and_members(spark, tmp_path):
    long = "p" * 1000
    rows = [(1, "http://a\r\nX: y", long), (2, None, long), (3, "u", None), (None, "v", long), (4, "w", "short"), (5, "w", "short"), (2, None, long)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    files = warc.archive_pages(pages, f"file://{tmp_path}/w")
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.read_records(files).collect())
    assert found == Counter(
        [(1, 1000, "revisit", 2), (2, 1000, "response", None), (2, 1000, "response", None), (None, 1000, "revisit", 2)]
        + [(3, 0, "response", None), (4, 5, "response", None), (5, 5, "response", None)]
    )
    whole = next((tmp_path / "w").glob("members-*.warc.gz")).read_bytes()
    assert whole.startswith(b"\x1f\x8b")
    assert warc.read_records(warc.archive_pages(pages.where("false"))).count() == 0


def test_pipeline_equals_its_stages_by_brute_force(spark, small_dir):
    docs = table(spark, small_dir, "documents").collect()
    weights = quality.train(table(spark, small_dir, "documents"), table(spark, small_dir, "labels"))
    good = []
    for r in docs:
        slots = quality.slots_of(r.text)
        margin = weights[0] + (quality.SCALE * weights[slots].mean() if len(slots) else 0.0)
        if round(quality.sigmoid(margin), 9) >= quality.THRESHOLD:
            good.append(r)
    least = brute_components([(r.doc_id, r.text) for r in good])
    kept = {i for i, _, c in least if i == c}
    leaks = {r.doc_id for r in QUERIES["op9_decontamination"](spark, small_dir).collect()}
    library = tiktoken_cached()
    want = Counter()
    for r in good:
        if r.doc_id in kept and r.doc_id not in leaks:
            ids = library.encode_ordinary(pii.redact(r.text, pii.find_spans(r.text)))
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            want[r.doc_id, len(ids), digest, hashlib.sha256(library.decode_bytes(ids)).hexdigest()] += 1
    assert Counter(map(tuple, corpus_pipeline.run(spark, small_dir).collect())) == want
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "ngram_jaccard_join", "benchmark_decontamination", "pii", "byte_bpe",
    ]


def test_stages_take_awkward_rows(spark, small_dir, awkward, nothing):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, small_dir)
            assert result.count() <= docs.count()
            if name != "byte_bpe":
                assert result.columns == docs.columns
