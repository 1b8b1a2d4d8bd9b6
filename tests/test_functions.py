import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillbook.functions import (clip_null_safe, collapse_spaces, email_is_valid, parse_multi_date,
                                parse_multi_timestamp, pct_change, pct_half_up, strip_non_numeric, title_case)


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_title_case_capitalises_after_any_non_letter(spark):
    out = one(spark, title_case("s"), [("  t-shirt ",), ("SELF-HELP book",), ("o'neil",), (None,), ("1st place",)], "s string")
    assert out == ["T-Shirt", "Self-Help Book", "O'Neil", None, "1St Place"]


def test_collapse_spaces(spark):
    assert one(spark, collapse_spaces(F.col("s")), [("a   b  c",)], "s string") == ["a b c"]


def test_email_null_is_invalid(spark):
    out = one(spark, email_is_valid("e"), [("a@b.com",), ("ab.com",), (None,), ("a b@c.d",), ("a@@b.c",)], "e string")
    assert out == [True, False, False, False, False]


def test_clip_keeps_null(spark):
    out = one(spark, clip_null_safe("d", 0, 100), [(150.0,), (-5.0,), (50.0,), (None,)], "d double")
    assert out == [100.0, 0.0, 50.0, None]


def test_pct_half_up_exact(spark):
    out = one(spark, pct_half_up(F.col("a"), F.col("b")), [(1, 8), (1, 32), (2, 3), (1, 0), (0, 5)], "a long, b long")
    assert out == [12.5, 3.13, 66.67, None, 0.0]


def test_pct_change_zero_base_is_null(spark):
    out = one(spark, pct_change("c", "p"), [(Decimal("110"), Decimal("100")), (Decimal("5"), Decimal("0"))],
              "c decimal(10,2), p decimal(10,2)")
    assert out == [10.0, None]


def test_two_date_formats(spark):
    out = one(spark, parse_multi_date("s"), [("8/27/2014",), ("09-01-2014",), ("1-2-2014",), ("garbage",), (None,)], "s string")
    assert out == [dt.date(2014, 8, 27), dt.date(2014, 1, 9), dt.date(2014, 2, 1), None, None]


def test_order_date_formats(spark):
    out = one(spark, parse_multi_timestamp("s"), [("2025-01-05 10:11:12",), (" 05-01-2025 ",), ("2025-01-05",), ("x",)],
              "s string")
    assert out == [dt.datetime(2025, 1, 5, 10, 11, 12), dt.datetime(2025, 1, 5), dt.datetime(2025, 1, 5), None]


def test_strip_non_numeric(spark):
    out = one(spark, strip_non_numeric("s"), [("\u20b91,299.00",), ("Rs.1,299.00",), ("abc",), (None,), ("0.0",)],
              "s string")
    # the dot of an 'Rs.' prefix survives the strip and spoils the number, as the rule does
    assert out == [1299.0, None, None, None, 0.0]
