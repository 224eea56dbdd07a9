"""Registered queries that have SQL, against DuckDB on the given tables."""
import zlib

import duckdb
import pytest

NAMES = ["op11_threshold_topk", "op12_prefix_trie", "op13_merkle_manifest"]


def connection(sf_dir):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def test_crc32_in_sql():
    from tunesmith.llm.oracle import crc32
    con = duckdb.connect()
    for n in (0, 7, 123, 99999, -5, 2 ** 62):
        assert con.sql(f"SELECT {crc32(repr(str(n)))}").fetchall() == [(zlib.crc32(str(n).encode()),)]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name, sf):
    from tunesmith.llm.queries import ORACLE, QUERIES
    sf_dir = f"/root/testdata/{sf}"
    out = QUERIES[name](spark, sf_dir)
    want = connection(sf_dir).sql(ORACLE[name])
    cols = sorted(out.columns)
    assert cols == sorted(want.columns)
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN"}
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: kinds[t] for c, t in out.dtypes} == types
    got = sorted((tuple(r[c] for c in cols) for r in out.collect()), key=str)
    assert got == sorted(want.select(*cols).fetchall(), key=str) and got
