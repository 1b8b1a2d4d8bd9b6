"""Text cleanup expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the cleaning rules:
# an e-mail is local@domain.tld with no blanks and exactly one '@'.
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
# numeric cleanup keeps digits and the decimal point only.
NON_NUMERIC = r"[^0-9.]"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def title_case(c) -> Column:
    """Title case where every letter run starts upper-case and the rest is lower.

    A new word starts after *any* non-letter ("t-shirt" -> "T-Shirt",
    "o'neil" -> "O'Neil"), unlike ``initcap`` which only splits on blanks.
    Input is trimmed first.
    """
    runs = F.regexp_extract_all(F.lower(F.trim(_c(c))), F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30))), "")
    )


def collapse_spaces(c) -> Column:
    """Runs of whitespace become one blank."""
    return F.regexp_replace(_c(c), r"\s+", " ")


def email_is_valid(c) -> Column:
    """True when the value looks like an e-mail; NULL counts as invalid (False)."""
    return F.coalesce(_c(c).rlike(EMAIL_PATTERN), F.lit(False))


def strip_non_numeric(c) -> Column:
    """Drop everything but digits and '.', then parse; empty or garbage gives NULL."""
    cleaned = F.regexp_replace(_c(c).cast("string"), NON_NUMERIC, "")
    return F.when(cleaned == "", F.lit(None).cast("double")).otherwise(cleaned.try_cast("double"))


def sanitize_name(name: str) -> str:
    """Column-name cleanup: blanks and hyphens become '_' (used over df.columns)."""
    return re.sub(r"[\s\-]+", "_", name.strip())
