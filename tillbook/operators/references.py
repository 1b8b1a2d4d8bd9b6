"""References without their row, without shuffling the table that refers.

Integer keys of the referenced table become exact bitmaps, 4 KB for each 32,768
numbers. If they are few enough to be sent to every task, a reference is found or
not by one bit, where the row is read. There is no false answer, so nothing is
looked up again. Keys that are spread too wide, too many or no integers take an
ordinary anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of a bucket's bitmap, and of all bitmaps that may be sent to a task.
BITMAP = 4096
MAX_BYTES = 64 << 20


def _has_bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, (position % 8).cast("int")).bitwiseAND(F.lit(1)) == 1


def key_bitmaps(parent: DataFrame, ref_column: str, max_bytes: int = MAX_BYTES) -> DataFrame | None:
    """``(bucket, bits)`` of the integer keys, or None if they would take more
    than ``max_bytes``. Their size is counted before any is built."""
    keys = parent.select(F.col(ref_column).cast("long").alias("key")).where("key IS NOT NULL")
    bucket = F.bitmap_bucket_number("key").alias("bucket")
    if keys.select(bucket).distinct().count() * BITMAP > max_bytes:
        return None
    return keys.groupBy(bucket).agg(F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bits"))


def missing_references(child: DataFrame, column: str, parent: DataFrame, ref_column: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """The rows of ``child`` whose ``column`` is not NULL and equals no ``ref_column`` of ``parent``.

    Repeated rows stay, each on its own; an empty parent leaves every reference
    missing. NULL keys of the parent match nothing.
    """
    integers = all(isinstance(df.schema[c].dataType, T.IntegralType) for df, c in ((child, column), (parent, ref_column)))
    bitmaps = key_bitmaps(parent, ref_column, max_bytes) if integers else None
    # the row as a struct, so that its names can be any
    refers = child.where(F.col(column).isNotNull()).select(F.struct("*").alias("row"), F.col(column).alias("own"))
    if bitmaps is None:
        found = refers.join(parent.select(F.col(ref_column).alias("key")), F.col("own") == F.col("key"), "left_anti")
    else:
        at = refers.withColumn("own", F.col("own").cast("long")).withColumn("of", F.bitmap_bucket_number("own"))
        found = (at.join(F.broadcast(bitmaps), F.col("of") == F.col("bucket"), "left")
                 .where(F.col("bits").isNull() | ~_has_bit(F.col("bits"), F.bitmap_bit_position("own"))))
    return found.select("row.*")
