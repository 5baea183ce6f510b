"""Quality rules as a short-circuit cascade, with built-in functions only.

Each rule is a condition that rejects a row. On a bounded sample every rule is timed and
its rejections are counted; rules then run in the order of rejections per second, in one
CASE expression that stops at the first that rejects. The order changes how much work is
done, never the verdict: a row is kept when no rule rejects it.

Defined results: null text counts as empty, which fails the base rules; repeated rows and
extra columns change nothing (the measures are carried under reserved names); an empty
table gives an empty result and leaves the rules in their given order.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from . import native
from .common import durable

# Rows on which costs and rejections are estimated.
SAMPLE_ROWS = 2_000


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-3)


def estimate(rows: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """Cost and share of rejections of each rule on ``rows``, a sample with a ``text`` column.

    The sample is written out first, so that a rule's time is its own; reading the sample
    without any rule is taken off.
    """
    sample = durable(rows, "rule-sample")
    if sample.isEmpty():
        return [Estimate(rule.name, 0.0, 0.0) for rule in rules]

    def timed(condition: Column) -> tuple[float, float]:
        start = time.perf_counter()
        row = sample.agg(F.avg(F.coalesce(condition, F.lit(False)).cast("int")), F.max(F.length("text"))).first()
        return time.perf_counter() - start, row[0] or 0.0

    timed(F.lit(False))  # opens the files
    nothing = timed(F.lit(False))[0]
    found = []
    for rule in rules:
        seconds, rejected = timed(rule.rejects)
        found.append(Estimate(rule.name, max(0.0, seconds - nothing), rejected))
    return found


def ordered(rules: Sequence[Rule], estimates: Sequence[Estimate]) -> list[Rule]:
    """By rejections per second, best first; equal ones keep their order."""
    worth = {e.name: e.worth for e in estimates}
    return sorted(rules, key=lambda rule: -worth[rule.name])


def first_rejection(rules: Sequence[Rule]) -> Column:
    """Name of the first rule in order that rejects the row; later rules are not worked out. Null: kept."""
    case = F.when(F.lit(False), F.lit(""))
    for rule in rules:
        case = case.when(rule.rejects, F.lit(rule.name))
    return case


def base_measures(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, text, n_words, word_chars, n_symbols, n_dup_lines, n_lines, n_repeat_words of every row."""
    content = F.coalesce(F.col(text), F.lit(""))
    # Each step is a column of its own where the next one reads it more than once.
    rows = docs.select(F.col(key), content.alias("text"), native.words(F.col(text)).alias("_words"))
    rows = rows.select(
        key,
        "text",
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        native.word_hashes(F.col("_words")).alias("_hashes"),
    )
    rows = rows.select(
        key,
        "text",
        "n_words",
        "word_chars",
        "n_symbols",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        native.grams(F.col("_hashes"), 3).alias("_grams"),
    )
    kept = [key, "text", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    # Windows in the order of their hash: equal ones are neighbours. Texts without any are left out.
    some = F.size("_grams") > F.size(F.array_distinct("_grams"))
    placed = F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    rows = rows.select(*kept, F.when(some, F.array_sort(placed)).alias("_sorted"))

    def twice(entry, i):
        before, after = F.get(F.col("_sorted"), i - 1), F.get(F.col("_sorted"), i + 1)
        return F.coalesce(entry["g"] == before["g"], F.lit(False)) | F.coalesce(entry["g"] == after["g"], F.lit(False))

    places = F.array_sort(F.transform(F.filter("_sorted", twice), lambda entry: entry["i"]))
    rows = rows.select(*kept, places.alias("_places"))
    # A window covers three words, less those that the next one starts on.
    covered = F.aggregate(
        F.transform(
            "_places",
            lambda p, i: F.least(F.lit(3), F.coalesce(F.get(F.col("_places"), i + 1), p + 3) - p),
        ),
        F.lit(0),
        lambda total, n: total + n,
    )
    return rows.select(*kept, F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def standard_rules() -> list[Rule]:
    """Rules over the measures and the text; a row must pass them all."""
    text, n_words = F.col("text"), F.col("n_words")

    def matches(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    return [
        Rule("symbols", 10 * F.col("n_symbols") > n_words),
        Rule("word_length", (F.col("word_chars") < 2 * n_words) | (F.col("word_chars") > 20 * n_words)),
        Rule("repeated_lines", 2 * F.col("n_dup_lines") > F.col("n_lines")),
        Rule("shouting", 3 * matches(r"(?<![^\x20\x09-\x0D])[A-Z]{2,}[^a-z\x20\x09-\x0D]*(?![^\x20\x09-\x0D])") > n_words),
        Rule("exclaiming", 5 * matches(r"!!") > n_words),
    ]


def quality_rules(
    docs: DataFrame,
    rules: Sequence[Rule] | None = None,
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Per row: ``key``, the base measures, base_failed and kept."""
    rules = list(rules or standard_rules())
    measured = base_measures(docs, key, text)
    total = docs.count()
    share = min(1.0, sample_rows / max(1, total))
    sample = measured if share == 1.0 else base_measures(docs.sample(fraction=share, seed=5), key, text)
    in_order = ordered(rules, estimate(sample, rules))
    return measured.select(
        key,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        F.when(base_failed(), False).otherwise(first_rejection(in_order).isNull()).alias("kept"),
    )
