"""Unpartitioned window functions without a single-partition exchange.

``Window.orderBy(...)`` with no PARTITION BY makes Spark move every row into
one task. The operators below compute the same values in parallel:

1. range-partition the rows on the total order (sort keys + a unique
   tie-break) and sort each partition; hot sort values are split too, because
   the tie-break makes every key distinct;
2. checkpoint (reliable, in ``spark.checkpoint.dir``) so partition contents
   and ids stay fixed while two passes read them;
3. per-partition row counts and sums: one row per partition;
4. exclusive prefix over those P rows (P is the partition count we chose, so
   the broadcast size is bounded by a parameter, not by the data);
5. a window partitioned by the range id (one range per task after a range
   exchange on the id) adds the local running values to the partition offset.

Ties of the sort value (RANK, RANGE frames) are handled by first aggregating
per distinct sort value, running over those, and joining back on the value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillbook.session import ensure_checkpoint_dir

_RP = "_rp"


def _num_partitions(df: DataFrame, requested: int | None) -> int:
    if requested:
        return requested
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _sort_exprs(order: list[tuple[str, bool]]):
    return [F.col(c).desc() if desc else F.col(c).asc() for c, desc in order]


def running(df: DataFrame, order: list[tuple[str, bool]], value: str | None = None,
            row_col: str = "row_number", sum_col: str = "running_sum", num_partitions: int | None = None,
            total_count_col: str | None = None, total_sum_col: str | None = None) -> DataFrame:
    """Append the global 1-based row number (and running sum of ``value``) under
    ``order`` = [(column, descending), ...]. The order must be total: end it
    with a unique key. Frame: ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW.

    ``total_count_col`` / ``total_sum_col`` add the grand totals (COUNT(*) OVER (),
    SUM(value) OVER ()) from the same per-partition statistics, so callers never
    re-run the input plan for a total.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    p = _num_partitions(df, num_partitions)
    sort = _sort_exprs(order)
    ranged = (df.repartitionByRange(p, *sort).sortWithinPartitions(*sort)
              .withColumn(_RP, F.spark_partition_id()))
    ranged = ranged.checkpoint(eager=True)

    aggs = [F.count(F.lit(1)).alias("_n")]
    if value:
        aggs.append(F.sum(value).alias("_s"))
    stats = ranged.groupBy(_RP).agg(*aggs)
    w = Window.orderBy(_RP).rowsBetween(Window.unboundedPreceding, -1)   # P rows: bounded by the parameter p
    everything = Window.partitionBy()
    offsets = stats.select(_RP, F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off_n"),
                           *([F.sum("_s").over(w).alias("_off_s")] if value else []),
                           F.sum("_n").over(everything).alias("_tot_n"),
                           *([F.sum("_s").over(everything).alias("_tot_s")] if value else []))

    # local pass: a range exchange on the partition id puts exactly one range in
    # each task, which is the clustering the window needs (no Python, exact decimals)
    local_w = Window.partitionBy(_RP).orderBy(*sort)
    local = (ranged.repartitionByRange(p, _RP)
             .withColumn("_lrow", F.row_number().over(local_w).cast("long")))
    if value:
        local = local.withColumn("_lsum", F.sum(value).over(local_w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = local.join(F.broadcast(offsets), _RP)
    cols = [c for c in df.columns] + [(F.col("_lrow") + F.col("_off_n")).alias(row_col)]
    if value:
        cols.append((F.col("_lsum") + F.coalesce(F.col("_off_s"), F.lit(0))).alias(sum_col))
    if total_count_col:
        cols.append(F.col("_tot_n").alias(total_count_col))
    if total_sum_col and value:
        cols.append(F.col("_tot_s").alias(total_sum_col))
    return joined.select(*cols)


def global_ntile(df: DataFrame, n_buckets: int, order: list[tuple[str, bool]], out_col: str = "ntile",
                 num_partitions: int | None = None) -> DataFrame:
    """NTILE(n) OVER (ORDER BY ...) computed from the global row number.

    With N rows, q = N div n and r = N mod n: the first r buckets hold q+1 rows.
    """
    numbered = running(df, order, row_col="_rn", num_partitions=num_partitions, total_count_col="_N")
    total = F.col("_N")
    q = F.floor(total / n_buckets).cast("long")
    r = (total % n_buckets).cast("long")
    i = F.col("_rn")
    big = r * (q + 1)
    bucket = F.when(i <= big, F.floor((i - 1) / (q + 1)) + 1).otherwise(r + F.floor((i - big - 1) / q) + 1)
    return numbered.withColumn(out_col, bucket.cast("long")).drop("_rn", "_N")


def global_rank(df: DataFrame, value: str, descending: bool = True, out_col: str = "rank",
                dense: bool = False, num_partitions: int | None = None) -> DataFrame:
    """RANK() / DENSE_RANK() OVER (ORDER BY value): ties share a rank.

    Distinct values are counted first (a hot value collapses to one row), the
    running count over distinct values gives the rank, and the rank is joined
    back on the value (AQE splits a skewed join side).
    """
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)          # read twice below: compute the input plan once
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_cnt"))
    ranked = running(counts, [(value, descending)], value="_cnt", row_col="_dr", sum_col="_cum",
                     num_partitions=num_partitions)
    rank_expr = F.col("_dr") if dense else (F.col("_cum") - F.col("_cnt") + 1)
    ranks = ranked.select(F.col(value).alias("_rv"), rank_expr.cast("long").alias(out_col))
    return df.join(ranks, df[value].eqNullSafe(ranks["_rv"])).drop("_rv")


def range_running_sum(df: DataFrame, order_value: str, value: str, descending: bool = True,
                      out_col: str = "running_sum", num_partitions: int | None = None) -> DataFrame:
    """SUM(value) OVER (ORDER BY order_value) with the default RANGE frame:
    rows with equal ``order_value`` share one running total."""
    ensure_checkpoint_dir(df.sparkSession)
    df = df.checkpoint(eager=True)          # read twice below: compute the input plan once
    per_value = df.groupBy(order_value).agg(F.sum(value).alias("_vs"))
    run = running(per_value, [(order_value, descending)], value="_vs", row_col="_dr", sum_col="_cum",
                  num_partitions=num_partitions)
    totals = run.select(F.col(order_value).alias("_rv"), F.col("_cum").alias(out_col))
    return df.join(totals, df[order_value].eqNullSafe(totals["_rv"])).drop("_rv")


def segmented(df: DataFrame, group: list[str], order: list[tuple[str, bool]], value: str | None = None,
              lag_cols: tuple[str, ...] = (), row_col: str = "row_number", sum_col: str = "running_sum",
              num_partitions: int | None = None) -> DataFrame:
    """ROW_NUMBER / running SUM / LAG per group (PARTITION BY ``group`` ORDER BY
    ``order``, ROWS frame) where one group may be huge.

    A plain ``Window.partitionBy(group)`` sends a whole group to one task. Here
    rows are range-partitioned on (group, order) so a hot group is cut into
    several tasks; each task computes the values locally per (range, group) and
    then adds a carry for the group it starts with: the rows of that group in
    earlier ranges. The carries come from one row per range (last group, its
    local count / sum, its last row), i.e. a table bounded by the partition
    count. ``order`` must be total within a group.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    p = _num_partitions(df, num_partitions)
    sort = [F.col(g).asc() for g in group] + _sort_exprs(order)
    ranged = (df.repartitionByRange(p, *sort).sortWithinPartitions(*sort)
              .withColumn(_RP, F.spark_partition_id())).checkpoint(eager=True)

    gkey = F.struct(*[F.col(g) for g in group])
    local_w = Window.partitionBy(_RP, *group).orderBy(*_sort_exprs(order))
    local = (ranged.repartitionByRange(p, _RP)
             .withColumn("_lrow", F.row_number().over(local_w).cast("long")))
    if value:
        local = local.withColumn("_lsum", F.sum(value).over(local_w.rowsBetween(Window.unboundedPreceding, 0)))
    for c in lag_cols:
        local = local.withColumn(f"_llag_{c}", F.lag(c).over(local_w))

    # one row per range: its first group, and its last row (group, local count/sum, lag values)
    # group columns sort ascending, so a range starts at its smallest group and
    # ends at its largest group's highest local row number (whatever the order directions)
    last_key = F.struct(gkey, F.col("_lrow"))
    last_row = F.struct(gkey.alias("g"), F.col("_lrow").alias("n"),
                        *([F.col("_lsum").alias("s")] if value else []),
                        *[F.col(c).alias(f"v_{c}") for c in lag_cols])
    per_range = local.groupBy(_RP).agg(F.min(gkey).alias("_first_g"), F.max_by(last_row, last_key).alias("_last"))
    by_group = Window.partitionBy("_last.g").orderBy(_RP).rowsBetween(Window.unboundedPreceding, 0)
    prev = Window.orderBy(_RP)                       # P rows: bounded by the parameter p
    t = per_range.select(_RP, "_first_g", F.col("_last.g").alias("_lg"),
                         F.sum("_last.n").over(by_group).alias("_cum_n"),
                         *([F.sum("_last.s").over(by_group).alias("_cum_s")] if value else []),
                         *[F.col(f"_last.v_{c}").alias(f"_lv_{c}") for c in lag_cols])
    carry_cols = ["_lg", "_cum_n"] + (["_cum_s"] if value else []) + [f"_lv_{c}" for c in lag_cols]
    t = t.select(_RP, "_first_g", *[F.lag(c).over(prev).alias(f"_p{c}") for c in carry_cols])
    continues = F.col("_p_lg").eqNullSafe(F.col("_first_g")) & F.col("_p_lg").isNotNull()
    carries = t.select(_RP, "_first_g", F.when(continues, F.col("_p_cum_n")).otherwise(F.lit(0)).alias("_cn"),
                       *([F.when(continues, F.col("_p_cum_s")).alias("_cs")] if value else []),
                       *[F.when(continues, F.col(f"_p_lv_{c}")).alias(f"_cv_{c}") for c in lag_cols])

    joined = local.join(F.broadcast(carries), _RP)
    in_first = gkey.eqNullSafe(F.col("_first_g"))
    cols = list(df.columns) + [(F.col("_lrow") + F.when(in_first, F.col("_cn")).otherwise(F.lit(0))).alias(row_col)]
    if value:
        cols.append(F.when(in_first & F.col("_cs").isNotNull(), F.col("_lsum") + F.col("_cs"))
                    .otherwise(F.col("_lsum")).alias(sum_col))
    for c in lag_cols:
        first_row = in_first & (F.col("_lrow") == 1)
        cols.append(F.when(first_row, F.col(f"_cv_{c}")).otherwise(F.col(f"_llag_{c}")).alias(f"prev_{c}"))
    return joined.select(*cols)
