"""Column builders for splitting text into words, characters and n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunesmith.config import WORD_SPLIT_PATTERN


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def words(text) -> Column:
    """Whitespace split with empty pieces removed (array<string>)."""
    return F.filter(F.split(_c(text), WORD_SPLIT_PATTERN), lambda x: x != "")


def chars(text) -> Column:
    """One element per Unicode code point, newlines included."""
    return F.regexp_extract_all(_c(text), F.lit("(?s)."), 0)


def ngram_keys(tokens, n: int, sep: str = " ") -> Column:
    """Distinct-free list of n-grams of an array, each joined to a string.

    Words never contain the separator (they are whitespace split) and
    character n-grams have a fixed width, so joined keys are unambiguous.
    """
    arr = _c(tokens)
    empty = F.array().cast("array<string>")
    return F.when(
        F.size(arr) >= n,
        F.transform(F.sequence(F.lit(1), F.size(arr) - n + 1),
                    lambda i: F.array_join(F.slice(arr, i, n), sep)),
    ).otherwise(empty)
