"""Registry of named queries: name -> (Spark plan builder, oracle SQL or None)."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[QueryFn, str | None]] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with its oracle SQL.

    ``sql`` is None only for operators that SQL cannot express (iterative or
    metadata-driven ones); those get a row-count check only.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")
        QUERIES[name] = (fn, sql)
        return fn
    return deco
