"""Column expressions shared by all jobs. Every function returns a Column and
stays inside whole-stage codegen (no Python UDFs)."""

from tillbook.functions.money import money, net_amount, to_double_2, avg_exact, pct_half_up, ratio_pct
from tillbook.functions.dates import (parse_multi_date, parse_multi_timestamp, parse_timestamp, ntz_literal,
                                      year_month, month_index, month_number, day_gap)
from tillbook.functions.text import title_case, collapse_spaces, email_is_valid, strip_non_numeric, sanitize_name
from tillbook.functions.numeric import clip_null_safe, pct_change

__all__ = [
    "money", "net_amount", "to_double_2", "avg_exact", "pct_half_up", "ratio_pct",
    "parse_multi_date", "parse_multi_timestamp", "parse_timestamp", "ntz_literal", "year_month", "month_index", "month_number", "day_gap",
    "title_case", "collapse_spaces", "email_is_valid", "strip_non_numeric", "sanitize_name",
    "clip_null_safe", "pct_change",
]
