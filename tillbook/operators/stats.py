"""Distributed exact order statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.global_window import segmented


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float]) -> DataFrame:
    """Exact quantiles with linear interpolation (the PERCENTILE / pandas rule),
    NULLs ignored: rows (column_name, prob, value).

    With n values and h = (n - 1) * p, the result interpolates between the
    values at 0-based positions floor(h) and ceil(h) with Spark's weights:
    (ceil(h) - h) * lower + (h - floor(h)) * upper.

    Values are counted per distinct value first (a hot value becomes one row);
    a running count per column (segmented scan) locates the needed positions.
    Unlike a percentile aggregate, no task holds every distinct value of a column.
    """
    long = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("_v"))
                                          for c in cols])).alias("x"))
            .select("x.*").dropna())
    counts = long.groupBy("column_name", "_v").agg(F.count(F.lit(1)).alias("_cnt"))
    seq = segmented(counts, ["column_name"], [("_v", False)], value="_cnt", row_col="_r", sum_col="_cum")
    # wanted positions: one row per (column, prob), bounded by len(cols) * len(probs)
    targets = (counts.groupBy("column_name").agg(F.sum("_cnt").alias("_n"))
               .select("column_name", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"), "_n")
               .withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("prob"))
               .withColumn("_lo", F.floor("_h")).withColumn("_hi", F.ceil("_h")))

    def covers(pos0):                     # 0-based position pos0 falls in this value's run
        return (F.col("_cum") - F.col("_cnt") <= pos0) & (pos0 < F.col("_cum"))

    hits = (seq.join(F.broadcast(targets), "column_name").filter(covers(F.col("_lo")) | covers(F.col("_hi")))
            .groupBy("column_name", "prob")
            .agg(F.max(F.when(covers(F.col("_lo")), F.col("_v"))).alias("_vl"),
                 F.max(F.when(covers(F.col("_hi")), F.col("_v"))).alias("_vh"),
                 F.first("_h").alias("_h"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")))
    value = F.when(F.col("_lo") == F.col("_hi"), F.col("_vl")).otherwise(
        (F.col("_hi") - F.col("_h")) * F.col("_vl") + (F.col("_h") - F.col("_lo")) * F.col("_vh"))
    return hits.select("column_name", "prob", value.alias("value"))


def exact_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact medians: rows (column_name, median)."""
    q = exact_quantiles(df, cols, [0.5])
    return q.select("column_name", F.col("value").alias("median"))
