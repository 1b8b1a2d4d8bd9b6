"""Distinct counts that add up: exact sets of integer ids as bitmaps.

``COUNT(DISTINCT id)`` of a month cannot be had from those of its days. Bitmaps
can: an id is one bit of the bitmap of its bucket (32,768 ids), so a row per
group and bucket holds a group's ids exactly, groups are merged by OR, and
counted by their bits. A fine grain is computed once; every coarser one follows
from its rows, and a new day is merged into the totals without reading old rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def id_bitmaps(df: DataFrame, groups: list[str], id_col: str) -> DataFrame:
    """``(groups..., bucket, bits)``: the different ids, 0 or more, of each group. NULL ids are left out."""
    number = F.col(id_col).cast("long") + 1
    return (df.where(F.col(id_col).isNotNull()).groupBy(*groups, F.bitmap_bucket_number(number).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits")))


def merge_bitmaps(bitmaps: DataFrame, groups: list[Column | str]) -> DataFrame:
    """The same for coarser groups, or for several sets of rows of the same groups."""
    return bitmaps.groupBy(*groups, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def count_ids(bitmaps: DataFrame, groups: list[str], out_col: str = "distinct_ids") -> DataFrame:
    """``(groups..., out_col)``: how many different ids each group has. Its buckets must have been merged."""
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).cast("long").alias(out_col))
