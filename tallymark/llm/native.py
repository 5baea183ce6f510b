"""Text as columns: words, grams and their hashes with built-in functions only.

Explode arrays made of these with ``explode_outer``: for a plain ``explode`` Spark infers
a filter on the array's size and pushes it below the projection that makes the array,
where the word hashes are then worked out again for every single gram.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

BLANKS = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Runs of anything but ASCII blanks, in order; null reads as empty."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def plain_words(text: Column) -> Column:
    """Runs of letters and digits in lower case, so that marks and case don't hide a copy."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def grams(hashes: Column, size: int) -> Column:
    """Hashes of all runs of ``size`` word hashes. ``hashes`` must be a column of its own:
    it is read for each run, and an expression would be worked out as often."""
    places = F.when(F.size(hashes) >= size, F.sequence(F.lit(0), F.size(hashes) - size)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(places, lambda i: F.xxhash64(*[F.get(hashes, i + F.lit(k)) for k in range(size)]))


def word_hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))
