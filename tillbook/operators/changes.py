"""What changed between two states of a table, and sums that follow the changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.dedup import fingerprint


def row_changes(before: DataFrame, after: DataFrame, change_col: str = "change") -> DataFrame:
    """The rows that ``after`` has more (``change`` copies) or less often (minus
    as many) than ``before``; rows that both have equally often are left out.

    Both need the same columns, of any types but maps. Rows are counted by their
    fingerprints, so what all rows cost is a shuffle of 24 bytes each, and only
    changed rows move whole. A row that repeats very often is counted on the map side.
    """
    if before.schema.names != after.schema.names:
        raise ValueError("the states have different columns")
    rows = before.withColumn("_sign", F.lit(-1).cast("long")).unionAll(after.withColumn("_sign", F.lit(1).cast("long")))
    rows = rows.select(fingerprint(rows, before.columns).alias("_print"), "*")
    changed = (rows.groupBy("_print").agg(F.sum("_sign").alias(change_col)).where(F.col(change_col) != 0)
               .withColumnRenamed("_print", "_changed"))
    whole = rows.select("_print", F.struct(*before.columns).alias("_row"))
    # one of the equal rows stands for them; they are combined on the map side
    return (whole.join(changed, F.col("_print") == F.col("_changed")).groupBy("_print", change_col)
            .agg(F.any_value("_row").alias("_row")).select("_row.*", change_col))


def add_partials(state: DataFrame, before: DataFrame, after: DataFrame, groups: list[str], rows_col: str = "n_rows") -> DataFrame:
    """``state`` with the partial sums ``before`` taken off and ``after`` added.

    All three have the ``groups`` (NULL is a group) and the same sums; ``rows_col``
    counts a group's rows, and a group without any is gone. Exact for integers and decimals.
    """
    sums = [c for c in state.columns if c not in groups]
    off = before.select(*groups, *[(-F.col(c)).alias(c) for c in sums])
    total = state.unionByName(after).unionByName(off).groupBy(*groups).agg(
        *[F.sum(c).cast(state.schema[c].dataType).alias(c) for c in sums])
    return total.where(F.col(rows_col) != 0).select(*state.columns)
