"""Projections, filters and limits (FLT1-FLT6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunesmith.operators.select import first_rows


def reshape(df: DataFrame, cols) -> DataFrame:
    """FLT1: keep only the mapped columns (Catalyst prunes the rest)."""
    return df.select(*cols)


def bind(df: DataFrame, prompt: str, response: str,
         history: str | None = None, keep=()) -> DataFrame:
    """FLT2: bind configurable role columns to prompt/response/history."""
    cols = [F.col(k) for k in keep]
    cols += [F.col(prompt).alias("prompt"), F.col(response).alias("response")]
    if history:
        cols.append(F.col(history).alias("history"))
    return df.select(*cols)


def drop_blank(df: DataFrame, cols=("prompt", "response")) -> DataFrame:
    """FLT3: keep rows whose columns are non-null and non-empty."""
    cond = None
    for c in cols:
        part = F.coalesce(F.col(c) != "", F.lit(False))
        cond = part if cond is None else cond & part
    return df.filter(cond)


def drop_null(df: DataFrame, cols=("context", "target")) -> DataFrame:
    """FLT4: keep rows whose columns are non-null (empty strings stay)."""
    return df.dropna(subset=list(cols))


def cap(df: DataFrame, n: int, order_by, by: str | None = None) -> DataFrame:
    """FLT5: first ``n`` rows in ``order_by`` order, per ``by`` group.

    One plan for every ``n``: the n-th key of each group is selected from
    counts, then rows are compared with it (:mod:`tunesmith.operators.select`).
    Null is a group of its own.
    """
    return first_rows(df, n, order_by, by)


def with_prefix(df: DataFrame, prefix: str, col: str = "prompt") -> DataFrame:
    """FLT6: prepend a source prefix to every prompt."""
    return df.withColumn(col, F.concat(F.lit(prefix), F.col(col)))
