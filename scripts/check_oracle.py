"""Run registered queries in Spark and their oracle SQL in DuckDB, compare.

Usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
Comparison: same column names, row count, and the same multiset of rows
after rounding doubles to 6 digits.
"""

from __future__ import annotations

import math
import sys
import time
import traceback

import duckdb

sys.path.insert(0, __file__.rsplit("/scripts/", 1)[0])

from tunesmith.plans import registry  # noqa: E402
from tunesmith.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows_of(records, cols):
    out = [tuple(norm(r[c]) for c in cols) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    pats = sys.argv[2:]
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = registry.queries(), registry.oracle_sql()
    ok = bad = 0
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            cols = sorted(df.columns)
            srows = [r.asDict(recursive=True) for r in df.collect()]
            dt = time.time() - t0
            if name not in sqls:
                print(f"ROWS  {name}: {len(srows)} rows ({dt:.1f}s) no oracle")
                continue
            rel = con.sql(sqls[name])
            dcols = sorted(rel.columns)
            drows = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
            if cols != dcols:
                print(f"FAIL  {name}: columns {cols} vs {dcols}")
                bad += 1
                continue
            a, b = rows_of(srows, cols), rows_of(drows, cols)
            if a == b:
                ok += 1
                print(f"OK    {name}: {len(a)} rows ({dt:.1f}s)")
            else:
                bad += 1
                diff = [x for x in a if x not in set(b)][:2]
                diff2 = [x for x in b if x not in set(a)][:2]
                print(f"FAIL  {name}: {len(a)} vs {len(b)} rows\n  spark-only {str(diff)[:600]}\n  duck-only  {str(diff2)[:600]}")
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:800]}")
            traceback.print_exc(limit=3)
    print(f"ok={ok} bad={bad}")
    spark.stop()


if __name__ == "__main__":
    main()
