"""Registry of named queries: a Spark callable and, where the operator is
SQL-expressible, the DuckDB text that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from tunesmith.plans.oracle import with_views

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = with_views(sql)
        return fn

    return deco


def load_all() -> None:
    # importing the modules registers their queries
    from tunesmith.plans import (  # noqa: F401
        q_prompts, q_position, q_tokens, q_layout, q_evaluate, q_ngram,
        q_io, q_flows)


def queries() -> dict[str, Callable]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE)
