"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver's
test tables bound to the operator's role.  The oracle is ANSI SQL over the
same tables, written independently (brute force where possible), with the
same output column names.  Doubles are rounded to 6 decimals and counts are
BIGINT on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
