"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def parse_multi_date(c, formats=("M/d/yyyy", "d-M-yyyy")) -> Column:
    """First format that parses wins; unparsable text gives NULL (never raises).

    ``d-M-yyyy`` accepts both ``01-02-2014`` and ``1-2-2014`` (a strict
    ``dd-MM-yyyy`` pattern rejects the latter).
    """
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_date(s, f) for f in formats])


def parse_multi_timestamp(c, formats=("yyyy-MM-dd HH:mm:ss", "d-M-yyyy", "yyyy-MM-dd")) -> Column:
    """Timestamp (without time zone) parse trying the formats in order, after trimming."""
    s = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def parse_timestamp(c) -> Column:
    """Default-format text -> timestamp without time zone; garbage gives NULL."""
    return F.try_to_timestamp(_c(c).cast("string")).cast("timestamp_ntz")


def ntz_literal(value) -> Column:
    """A wall-clock timestamp literal that does not depend on any time zone
    (built from text, never from a Python datetime)."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    text = value.isoformat(sep=" ") if hasattr(value, "hour") else f"{value.isoformat()} 00:00:00"
    return F.lit(text).cast("timestamp_ntz")


def year_month(c) -> Column:
    """'yyyy-MM' text of a date/timestamp."""
    return F.date_format(_c(c), "yyyy-MM")


def month_index(c) -> Column:
    """Months since year 0: year * 12 + month - 1 (calendar months, not months_between)."""
    return F.year(_c(c)) * 12 + F.month(_c(c)) - 1


def month_number(start, end) -> Column:
    """Whole calendar months from ``start`` to ``end``."""
    return month_index(end) - month_index(start)


def day_gap(later, earlier) -> Column:
    """Calendar days between two dates/timestamps (time of day ignored)."""
    return F.datediff(F.to_date(_c(later)), F.to_date(_c(earlier)))
