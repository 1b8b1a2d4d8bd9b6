"""Invariants of the named queries on the warehouse tables."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tillbook.operators.scd import scd2_invariants
from tillbook.plans.model import raw_items

SF = "/root/testdata/sf0.001"


def q(spark, name):
    return E.queries()[name](spark, SF)


def test_cumulative_share_ends_at_100(spark):
    rows = q(spark, "w8_cumulative_share").orderBy(F.col("cumulative_revenue").desc()).limit(1).collect()
    assert rows[0].cumulative_percent == 100.0


def test_quartile_sizes_differ_by_at_most_one(spark):
    sizes = [r["count"] for r in q(spark, "w8_ltv_quartiles").groupBy("quartile").count().collect()]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1


def test_scd2_dimension_is_consistent(spark):
    dim = q(spark, "m_scd2_merge")
    inv = scd2_invariants(dim, "customer_id").collect()[0]
    assert inv.keys_with_many_current == 0 and inv.inverted_intervals == 0
    current = dim.filter("is_current").count()
    assert current == dim.select("customer_id").distinct().count()


def test_merge_validation_has_no_duplicates(spark):
    v = q(spark, "w7_merge_validation").collect()[0]
    assert v.total_rows == v.distinct_keys and v.duplicate_keys == 0


def test_split_covers_every_row(spark):
    total = sum(r.n_rows for r in q(spark, "q_split_valid").collect())
    assert total == raw_items(spark, SF).count()


def test_retention_month_zero_bounds(spark):
    rows = q(spark, "w8_cohort_retention").collect()
    assert all(0 <= r.month_number <= 3 and 0 <= r.retention_rate_percent <= 100 for r in rows)


def test_every_foreign_key_of_the_sales_lines_has_its_row(spark):
    from tillbook.sources.tables import load
    t = {n: load(spark, SF, n) for n in ("lineitem", "orders", "customer", "part", "nation", "region")}
    for child, key, parent, own in (("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
                                    ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
                                    ("nation", "n_regionkey", "region", "r_regionkey")):
        assert t[child].join(t[parent], F.col(key) == F.col(own), "left_anti").count() == 0
        assert t[parent].count() == t[parent].select(own).distinct().count()


def test_the_fixtures_hold_the_cases(spark):
    """Each of these queries meets at least one row of the case that it is about."""
    inner = q(spark, "w2_inner_join").count()
    assert q(spark, "w2_left_join").count() > inner < q(spark, "w2_right_join").count()
    assert q(spark, "w2_full_join").count() > max(q(spark, "w2_left_join").count(), q(spark, "w2_right_join").count())
    ranked = q(spark, "w3_rank_customers")
    assert ranked.select("rank").distinct().count() < ranked.count()
    dup = q(spark, "w5_dedup_counts").first()
    assert dup.duplicate_rows > 0
    raw = q(spark, "w3_raw_counts").first()
    assert raw.total_rows > raw.distinct_rows
    assert q(spark, "w2_price_tier").select("price_tier").distinct().count() == 3
    assert q(spark, "w5_dual_format_dates").first().n_unparsed > 0
    counts = {r.table_name: r.n_rows for r in q(spark, "m_bronze_counts").collect()}
    for name, table in (("m_silver_zip", "customers"), ("m_silver_sellers", "sellers"), ("m_silver_orders", "orders"),
                        ("m_silver_items", "order_items"), ("m_silver_payments", "order_payments")):
        assert q(spark, name).count() < counts[table]
    assert q(spark, "m_silver_orders").filter("order_approved_at is null").count() > 0
    assert q(spark, "m_silver_payments").groupBy("order_id", "payment_value").count().filter("count > 1").count() > 0
    assert {r.change for r in q(spark, "m_schema_drift").select("change").distinct().collect()} == {"new", "missing", "type_changed", "same"}
    dim = q(spark, "m_scd2_products")
    assert dim.filter("end_date < timestamp_ntz'2024-02-01'").count() > 0 and dim.filter("is_current and product_weight_g is null").count() > 0
    assert q(spark, "q_constraints").filter("kind = 'FOREIGN KEY' and violations > 0").count() > 0
