"""Distinct counts that add up, and duplicates by fingerprint."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tillbook.operators.dedup import count_duplicates, fingerprint
from tillbook.operators.rollup import count_ids, id_bitmaps, merge_bitmaps
from tillbook.plans.shop_analytics import customers_by_grain


def test_days_add_up_to_months(spark):
    rng = random.Random(1)
    first = dt.date(2024, 1, 25)
    rows = [(first + dt.timedelta(days=rng.randrange(40)), rng.choice([0, 1, 32767, 32768, 70000, rng.randrange(10**9), None])) for _ in range(3000)]
    df = spark.createDataFrame(rows, "day date, customer_id long")
    daily = id_bitmaps(df, ["day"], "customer_id")
    got = {(r.grain, r.bucket_start.date()): r.unique_customers for r in customers_by_grain(daily).collect()}
    for grain in ("day", "week", "month", "year"):
        direct = (df.where("customer_id IS NOT NULL").groupBy(F.date_trunc(grain, "day").alias("b")).agg(F.count_distinct("customer_id").alias("n")).collect())
        assert {(grain, r.b.date()): r.n for r in direct} == {k: v for k, v in got.items() if k[0] == grain}
    # a later day is merged into the kept bitmaps without the old rows
    late = id_bitmaps(spark.createDataFrame([(first, 5), (first, 0)], "day date, customer_id long"), ["day"], "customer_id")
    merged = merge_bitmaps(daily.unionAll(late), ["day"])
    both = df.unionAll(spark.createDataFrame([(first, 5), (first, 0)], "day date, customer_id long"))
    assert (sorted(map(tuple, count_ids(merged, ["day"]).collect()))
            == sorted(map(tuple, both.where("customer_id IS NOT NULL").groupBy("day").agg(F.count_distinct("customer_id")).collect())))
    assert customers_by_grain(daily.limit(0)).count() == 0


def test_duplicates_by_fingerprint(spark):
    rows = [(1, "a", None, 0.0), (1, "a", None, -0.0), (1, None, "a", 0.0), (None, "a", None, 0.0), (1, "a", None, None),
            (1, "a", None, float("nan")), (1, "a", None, float("nan")), (1, "a", "", 0.0), (None, None, None, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "k long, a string, b string, x double")
    assert count_duplicates(df).first()[:] == (10, df.distinct().count(), 10 - df.distinct().count()) == (10, 7, 3)
    assert count_duplicates(df.limit(0)).first()[:] == (0, 0, 0)
    plan = count_duplicates(df)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert exchanged and not any("a#" in line or "b#" in line for line in exchanged)
    assert df.select(fingerprint(df, ["k", "a"]).alias("f")).distinct().count() == 4
