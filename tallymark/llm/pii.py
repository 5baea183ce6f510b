"""Personal data: patterns propose spans, checks confirm them, context words adjust the score.

Kinds with a fixed contract (email, ip, card, phone) are reported whenever pattern and
check agree; their score only ranks them. Kinds that patterns alone cannot settle (iban,
secret, national id) are reported when their score, raised or lowered by words close by,
reaches a threshold. Positions are code points, ends are exclusive.

Defined results: a null text counts as empty and has no spans; matches that fail their
check are dropped without a retry; equal spans of different kinds are all kept, ordered by
start and then kind; rows are independent, so repeated rows and extra columns change
nothing. All scans are linear in the text, however long its runs are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_rows

# Fixed values of the contract, in its order, then the kinds this operator adds.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "secret", "national_id")

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# No match can start inside a run of digits: the run's own start would match or fail alike.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
ACCESS_KEY = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
ASSIGNED = re.compile(r"(?i:password|passwd|token|secret|api_?key)\s{0,3}[=:]\s{0,3}\"?([A-Za-z0-9+/_-]{12,200})")
NATIONAL_ID = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

# How far to look for context words, in characters, and what they add.
NEAR = 40
SUPPORT = {
    "email": ("mail", "contact", "write", "address"),
    "ip": ("ip", "host", "server", "address", "login"),
    "card": ("card", "visa", "credit", "payment", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax"),
    "iban": ("iban", "bank", "account", "konto", "compte", "cuenta"),
    "secret": ("key", "secret", "token", "password", "credential", "aws"),
    "national_id": ("ssn", "social", "security", "tax", "identity"),
}
DOUBT = ("example", "sample", "invoice", "order", "version", "isbn", "serial")
# Score of a confirmed match before its context is read, and what a reported span needs.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "secret": 0.7, "national_id": 0.4}
THRESHOLD = 0.6


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * 2 if i % 2 else digit
        total += doubled - 9 if doubled > 9 else doubled
    return total % 10 == 0


def mod97(code: str) -> bool:
    moved = code[4:] + code[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match ends its local part at an ``@``, so each ``@`` is tried once, from left to right."""
    done, at = 0, text.find("@")
    while at >= 0:
        head = text[done:at]
        start = done + len(head.rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1  # no local part reaches over an ``@``
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield m.span()


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in IBAN.finditer(text):
        code = m[0].replace(" ", "")
        if 15 <= len(code) <= 34 and mod97(code):
            yield m.span()


def _secrets(text: str) -> Iterator[tuple[int, int]]:
    for m in ACCESS_KEY.finditer(text):
        yield m.span()
    for m in ASSIGNED.finditer(text):
        if re.search("[0-9]", m[1]):
            yield m.span(1)


def _national_ids(text: str) -> Iterator[tuple[int, int]]:
    for m in NATIONAL_ID.finditer(text):
        yield m.span()


def _score(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}".lower()
    words = set(re.findall(r"[^\W\d_]+", near))
    score = PRIOR[kind] + 0.3 * any(w in words for w in SUPPORT[kind]) - 0.2 * any(w in words for w in DOUBT)
    return round(min(1.0, max(0.0, score)), 2)


FINDERS = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
    "iban": _ibans,
    "secret": _secrets,
    "national_id": _national_ids,
}
# What a text must hold for a kind to be possible at all; spares most texts most scans.
_HAS = {"email": re.compile("@"), "phone": re.compile(r"\+[0-9]"), "secret": re.compile(r"[=:]|AKIA|ASIA")}
_DIGIT = re.compile("[0-9]")


def find_spans(text: str | None, threshold: float = THRESHOLD) -> list[Span]:
    """All spans of a text, by start and then by kind in the order of ``KINDS``."""
    if not text:
        return []
    spans = []
    has_digit = _DIGIT.search(text)
    for kind in KINDS:
        needed = _HAS.get(kind)
        if not (needed.search(text) if needed else has_digit):
            continue
        for start, end in FINDERS[kind](text):
            score = _score(text, kind, start, end)
            if kind in BASE_KINDS or score >= threshold:
                spans.append(Span(kind, start, end, score))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(set(spans), key=lambda s: (s.start, order[s.kind], s.end))


def redact(text: str, spans: list[Span]) -> str:
    """Replace each span by its kind in brackets; overlapping spans become one, named after the first."""
    parts, done = [], 0
    merged: list[list] = []
    for span in spans:
        if merged and span.start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], span.end)
        else:
            merged.append([span.kind, span.start, span.end])
    for kind, start, end in merged:
        parts += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*parts, text[done:]])


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)


def pii_spans(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``key`` and its spans with scores."""

    def per_batch(keys, texts):
        return {key: keys, "spans": [[s._asdict() for s in find_spans(t, threshold)] for t in texts]}

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
    fields = pa.schema([(key, pa.int64()), ("spans", pa.list_(span))])
    schema = f"`{key}` bigint, spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"
    return map_rows(docs, [key, text], schema, fields, per_batch)


def pii_digests(docs: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: counts of the base kinds, a digest of the base spans, and all spans as text."""

    def per_batch(keys, texts):
        found = [find_spans(t, threshold) for t in texts]
        base = [[s for s in spans if s.kind in BASE_KINDS] for spans in found]
        return {
            key: keys,
            **{f"n_{kind}": [sum(s.kind == kind for s in spans) for spans in base] for kind in BASE_KINDS},
            "base_sha256": [hashlib.sha256(_joined(spans).encode()).hexdigest() for spans in base],
            "spans": [_joined(spans) for spans in found],
        }

    counts = [f"n_{kind}" for kind in BASE_KINDS]
    fields = pa.schema(
        [(key, pa.int64()), *[(c, pa.int64()) for c in counts], ("base_sha256", pa.string()), ("spans", pa.string())]
    )
    schema = f"`{key}` bigint, {', '.join(f'{c} bigint' for c in counts)}, base_sha256 string, spans string"
    return map_rows(docs, [key, text], schema, fields, per_batch)


def redacted(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """The same rows and columns with personal data replaced in ``text`` (null stays null)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import StringType

    @F.pandas_udf(StringType())
    def clean(texts):
        return texts.map(lambda t: t if not t else redact(t, find_spans(t, threshold)))

    return docs.withColumn(text, clean(F.col(text)))
