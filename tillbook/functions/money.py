"""Money arithmetic.

Money is carried as DECIMAL so that sums do not depend on the order in which
partial aggregates are combined (a double sum does), and so that rounding is
exact HALF_UP. Values leave as DOUBLE only at the very end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"


def money(c) -> Column:
    """A price column as DECIMAL(18,2)."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def net_amount(amount, discount_fraction) -> Column:
    """Line amount after discount: amount * (1 - discount), in decimal (scale 4)."""
    amt = money(amount)
    disc = (F.col(discount_fraction) if isinstance(discount_fraction, str) else discount_fraction).cast(RATE)
    return amt * (F.lit(1) - disc)


def to_double_2(c: Column) -> Column:
    """Round a decimal HALF_UP to 2 places, then hand it out as DOUBLE."""
    return F.round(c, 2).cast("double")


def avg_exact(sum_col: Column, count_col: Column) -> Column:
    """Average as double(sum) / double(count): one IEEE division of exact inputs."""
    return sum_col.cast("double") / count_col.cast("double")


def pct_half_up(num: Column, den: Column) -> Column:
    """round(num * 100 / den, 2) for integer counts, exact HALF_UP; NULL when den = 0.

    Computed in integer arithmetic: floor((20000 * num + den) / (2 * den)) / 100.
    """
    n = num.cast("long")
    d = den.cast("long")
    scaled = F.floor(F.try_divide((n * 20000 + d).cast("decimal(38,0)"), (d * 2).cast("decimal(38,0)")))
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(scaled.cast("double") / 100.0)


def ratio_pct(num: Column, den: Column) -> Column:
    """round(num * 100 / den, 2) for decimal money values; NULL when den = 0."""
    q = F.try_divide(num.cast("decimal(38,4)") * 100, den.cast("decimal(38,4)"))
    return F.round(q, 2).cast("double")
