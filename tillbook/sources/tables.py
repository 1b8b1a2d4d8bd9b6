"""Parquet table loader for the input warehouse folder (one parquet per table).

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so a
loader never selects or filters on its own.
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_LOADED: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a lazy DataFrame. The relation (file listing and Parquet
    footer schema) is resolved once per session and path and then reused:
    a DataFrame is an immutable plan, so every query can start from it."""
    if name not in TABLES:
        raise KeyError(f"unknown table {name!r}")
    path = table_path(sf_dir, name)
    if spark.sparkContext._jsc is None:          # a stopped session: nothing cached may be reused
        _LOADED.pop(spark, None)
        return spark.read.parquet(path)
    per_session = _LOADED.setdefault(spark, {})
    df = per_session.get(path)
    if df is None:
        df = per_session[path] = spark.read.parquet(path)
    return df
