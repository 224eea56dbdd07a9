"""Every registered query equals its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

from tunesmith.plans import registry

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()
NAMES = sorted(registry.oracle_sql())
# Spark type -> DuckDB type name the oracle must produce for the same column
TYPE_NAMES = {"LongType()": "BIGINT", "StringType()": "VARCHAR", "DoubleType()": "DOUBLE",
              "BooleanType()": "BOOLEAN", "IntegerType()": "INTEGER"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = registry.queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [r.asDict() for r in df.collect()]
    rel = duck.sql(registry.oracle_sql()[name])
    assert cols == sorted(rel.columns)
    spark_types = {f.name: TYPE_NAMES.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert spark_types == duck_types
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert _rows(got, cols) == _rows(want, cols)
