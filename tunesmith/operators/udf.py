"""User functions (UDF1): opaque Python callbacks on Arrow batches.

Built-in expressions are the first choice (``df.transform(f)`` with a
``DataFrame -> DataFrame`` function).  For callbacks that only exist as
Python, rows travel in Arrow record batches to pandas functions with a
declared output schema -- never one row at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from tunesmith.session import ship_package


def map_batches(df: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame],
                schema) -> DataFrame:
    """Batched column map: ``fn(pandas batch) -> pandas batch`` (may drop rows)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield fn(b)

    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[dict], dict], schema) -> DataFrame:
    """Row map through Arrow batches: ``fn(row dict) -> row dict``."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([fn(r) for r in b.to_dict("records")])

    return map_batches(df, run, schema)


def filter_rows(df: DataFrame, predicate: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Row predicate evaluated on Arrow batches; schema unchanged."""

    def run(b: pd.DataFrame) -> pd.DataFrame:
        return b[predicate(b).astype(bool).values]

    return map_batches(df, run, df.schema)


def row_metric(df: DataFrame, fn: Callable[[str, str], float], pred: str = "predict",
               ref: str = "labels", out: str = "metric") -> DataFrame:
    """Metric callback ``fn(prediction, reference) -> float`` per row, run on
    Arrow batches (the scripts' ``compute_metrics`` hook)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DoubleType

    @F.pandas_udf(DoubleType())
    def apply(p: pd.Series, r: pd.Series) -> pd.Series:
        return pd.Series([float(fn(a, b)) for a, b in zip(p, r)], dtype="float64")

    ship_package(df.sparkSession)
    return df.withColumn(out, apply(F.col(pred), F.col(ref)))
