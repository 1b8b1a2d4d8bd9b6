"""Deterministic de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dedup_by_key(df: DataFrame, keys: list[str] | str, order: list[str] | None = None) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple (default: all
    other columns ascending, so the choice never depends on partitioning).

    Written as a grouped ``min_by`` over a struct, which Spark evaluates with a
    partial (map-side) aggregate: a hot key is combined before the shuffle
    instead of landing whole in one window partition.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = order or rest
    if not rest:
        return df.select(*keys).distinct()
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def distinct_by_key(df: DataFrame, key: str) -> DataFrame:
    """The distinct rows, for rows of which few are equal and which are next joined
    or grouped on ``key``: they leave partitioned and sorted by it.

    ``distinct()`` holds a task's rows in two hash tables, before and after the
    exchange or, below a join on the key, both at once. Here a task sorts its rows
    once and drops those equal to the one before; a merge join takes that order.
    """
    w = Window.partitionBy(key, *[c for c in df.columns if c != key]).orderBy(key)
    return df.repartition(key).withColumn("_nth", F.row_number().over(w)).where("_nth = 1").drop("_nth")


def fingerprint(df: DataFrame, columns: list[str] | None = None) -> Column:
    """128 bits of a row: equal for rows that are not distinct in SQL's sense,
    different otherwise (but for a chance of about n^2 / 2^129 among n rows).
    NULL differs from every value and 0.0 equals -0.0."""
    names = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for c in names:
        value = F.col(c) + F.lit(0.0).cast(types[c]) if isinstance(types[c], (T.FloatType, T.DoubleType)) else F.col(c)
        parts += [value, F.col(c).isNull()]            # a hash skips NULLs, so they are told by a flag
    return F.struct(F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit(1), *parts).alias("h2"))


def count_duplicates(df: DataFrame) -> DataFrame:
    """One row: total rows, distinct rows, duplicate rows (total - distinct).
    Rows are told apart by their fingerprints: 16 bytes of each are shuffled, whatever its width."""
    per_row = df.select(fingerprint(df).alias("f")).groupBy("f").agg(F.count(F.lit(1)).alias("n"))
    return per_row.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("total_rows"), F.count(F.lit(1)).alias("distinct_rows")) \
        .withColumn("duplicate_rows", F.col("total_rows") - F.col("distinct_rows"))
