"""Dimension merges as pure DataFrame plans (no lake-format MERGE needed).

Each merge returns the complete new version of the dimension; publishing it
(``sources.snapshots.publish``) is one atomic step, so a failure never leaves
a half-merged table behind.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions.dates import ntz_literal

SCD2_COLS = ("effective_date", "end_date", "is_current")


def assert_unique_keys(df: DataFrame, key: str | list[str]) -> None:
    """Raise when a key occurs twice (a MERGE source must be unique per key).
    Runs one aggregation job that returns at most one row."""
    keys = [key] if isinstance(key, str) else list(key)
    dup = df.groupBy(*keys).count().filter(F.col("count") > 1).limit(1).collect()
    if dup:
        raise ValueError(f"merge source has duplicate keys, e.g. {dup[0].asDict()}")


def _changed(t_cols: list[Column], s_cols: list[Column], null_safe: bool) -> Column:
    if null_safe:
        diffs = [~t.eqNullSafe(s) for t, s in zip(t_cols, s_cols)]
    else:   # SQL '<>': a NULL on either side counts as "no change"
        diffs = [F.coalesce(t != s, F.lit(False)) for t, s in zip(t_cols, s_cols)]
    return reduce(lambda a, b: a | b, diffs)


def drop_null_keys(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Rows whose key columns are all set. A merge can neither find nor replace any other."""
    return df.dropna(subset=[key] if isinstance(key, str) else list(key))


def _sides(target: DataFrame, source: DataFrame, key: str) -> tuple[DataFrame, Column, Column]:
    """The full outer join of both sides as ``t`` and ``s``, and which of them a
    joined row has. That is marked by columns of their own, as a key may be null."""
    t = target.withColumn("__in", F.lit(True)).alias("t")
    s = drop_null_keys(source, key).withColumn("__in", F.lit(True)).alias("s")
    joined = t.join(s, F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return joined, F.col("t.__in").isNotNull(), F.col("s.__in").isNotNull()


# ---------------------------------------------------------------- SCD type 1
def scd1_merge(target: DataFrame, source: DataFrame, key: str, update_cols: list[str],
               check_unique: bool = True) -> DataFrame:
    """Upsert: matched keys take ``update_cols`` from the source (other columns
    keep the target value), new keys are inserted whole, target-only keys stay.
    Target rows with a NULL key stay as they are; source rows with one are left out."""
    if check_unique:
        assert_unique_keys(drop_null_keys(source, key), key)
    cols = target.columns
    j, in_t, in_s = _sides(target, source, key)
    out = []
    for c in cols:
        if c == key:
            out.append(F.coalesce(F.col(f"t.{c}"), F.col(f"s.{c}")).alias(c))
        elif c in update_cols:
            out.append(F.when(in_s, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c))
        else:
            out.append(F.when(in_t, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c))
    return j.select(*out)


def merge_validation(df: DataFrame, key: str) -> DataFrame:
    """One row: total rows, distinct keys, keys occurring more than once."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").cast("long").alias("total_rows"), F.count(F.lit(1)).alias("distinct_keys"),
                       F.count_if(F.col("n") > 1).alias("duplicate_keys"))


# ---------------------------------------------------------------- SCD type 2
def scd2_init(df: DataFrame, effective_ts) -> DataFrame:
    """First load: every row current from ``effective_ts``, open end."""
    return (df.withColumn("effective_date", ntz_literal(effective_ts))
            .withColumn("end_date", F.lit(None).cast("timestamp_ntz"))
            .withColumn("is_current", F.lit(True)))


def scd2_merge(target: DataFrame, batch: DataFrame, key: str, compare_cols: list[str], batch_ts,
               null_safe: bool = True, check_unique: bool = True) -> DataFrame:
    """New dimension version after applying ``batch`` at ``batch_ts``.

    * closed history rows pass through untouched;
    * a current row whose key is absent from the batch stays current;
    * unchanged key (all ``compare_cols`` equal): target row kept as is;
    * changed key: target row closed (end_date = batch_ts, is_current = false)
      and the batch row added as the new current version;
    * new key: batch row added as current.

    One full outer join of *current* rows with the batch does all of it; each
    joined row emits one or two output rows through a small array + explode.
    ``null_safe=False`` reproduces SQL ``<>`` (NULL <-> value is not a change).
    Target rows with a NULL key stay as they are; batch rows with one are left
    out, since every batch would add them anew.
    """
    if check_unique:
        assert_unique_keys(drop_null_keys(batch, key), key)
    base_cols = [c for c in target.columns if c not in SCD2_COLS]
    ts = ntz_literal(batch_ts)
    history = target.filter(~F.col("is_current"))
    j, in_t, in_s = _sides(target.filter(F.col("is_current")), batch.select(*base_cols), key)
    changed = in_t & in_s & _changed([F.col(f"t.{c}") for c in compare_cols],
                                     [F.col(f"s.{c}") for c in compare_cols], null_safe)

    def row(side: str, eff, end, cur):
        return F.struct(*[F.col(f"{side}.{c}").alias(c) for c in base_cols],
                        eff.alias("effective_date"), end.alias("end_date"), cur.alias("is_current"))

    keep_t = row("t", F.col("t.effective_date"), F.col("t.end_date"), F.col("t.is_current"))
    close_t = row("t", F.col("t.effective_date"), ts, F.lit(False))
    new_s = row("s", ts, F.lit(None).cast("timestamp_ntz"), F.lit(True))
    emitted = (F.when(changed, F.array(close_t, new_s))
               .when(in_t, F.array(keep_t))
               .otherwise(F.array(new_s)))
    merged = j.select(F.explode(emitted).alias("r")).select("r.*")
    return history.select(*merged.columns).unionByName(merged)


def scd2_changes(target: DataFrame, batch: DataFrame, key: str, compare_cols: list[str], null_safe: bool = True) -> DataFrame:
    """The rows of ``batch`` that ``scd2_merge`` would act on: those with a new
    key, and those that differ from the current row. Merging them gives the same
    dimension as merging the whole batch, and tells which keys are touched."""
    current = target.filter(F.col("is_current")).select(F.col(key).alias("__key"), *(F.col(c).alias(f"__{c}") for c in compare_cols if c != key))
    rows = drop_null_keys(batch, key).join(current.withColumn("__in", F.lit(True)), F.col(key) == F.col("__key"), "left")
    changed = _changed([F.col(f"__{c}") for c in compare_cols if c != key], [F.col(c) for c in compare_cols if c != key], null_safe)
    return rows.where(F.col("__in").isNull() | changed).select(*batch.columns)


def scd2_invariants(dim: DataFrame, key: str) -> DataFrame:
    """One row: keys with more than one current row, and rows whose interval is
    inverted (end before start). Both must be 0. One grouped pass."""
    per_key = dim.groupBy(key).agg(F.count_if(F.col("is_current")).alias("cur"),
                                   F.count_if(F.col("end_date") < F.col("effective_date")).alias("inv"))
    return per_key.agg(F.count_if(F.col("cur") > 1).alias("keys_with_many_current"),
                       F.sum("inv").cast("long").alias("inverted_intervals"))
