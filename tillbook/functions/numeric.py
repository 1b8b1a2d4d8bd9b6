"""Numeric guards."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def clip_null_safe(c, lo, hi) -> Column:
    """Clamp to [lo, hi] but keep NULL as NULL (bare greatest/least would not)."""
    x = _c(c)
    return F.when(x.isNull(), x).otherwise(F.greatest(F.lit(lo), F.least(F.lit(hi), x)))


def pct_change(current, previous) -> Column:
    """(current - previous) * 100 / previous rounded to 2; NULL when previous is 0 or NULL."""
    cur, prev = _c(current).cast("decimal(38,4)"), _c(previous).cast("decimal(38,4)")
    return F.round(F.try_divide((cur - prev) * 100, prev), 2).cast("double")
