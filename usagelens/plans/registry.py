"""Registered queries: name -> (callable(spark, sf_dir) -> DataFrame, DuckDB SQL | None).

Each query reads the supplied tables (through an activity adapter) in full.
The SQL twin runs on the same Parquet tables in DuckDB and must produce the
same columns (names and values); keys without SQL are checked by row count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query key {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _load_all() -> None:
    # Importing the modules registers their queries.
    from usagelens.plans import (  # noqa: F401
        q_churn,
        q_etl,
        q_kpis,
        q_reconcile,
        q_segments,
        q_users,
        q_warehouse,
    )


def queries() -> dict[str, QueryFn]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
