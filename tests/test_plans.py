"""Physical-plan properties the jobs rely on at scale."""

import re

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(spark, name):
    return E.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_date_range_reaches_the_scan(spark):
    plan = _plan(spark, "w2_filter_between_not")
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan
    plan = _plan(spark, "w8_period_summary")
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "w3_sales_by_category")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert "struct<l_partkey:bigint,l_extendedprice:double>" in schemas


def test_top_n_per_group_limits_before_the_shuffle(spark):
    plan = _plan(spark, "m_top5_sellers")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filter_below_projection_on_hidden_column(spark):
    plan = _plan(spark, "w6_electronics")
    assert "EqualTo(p_type,PROMO)" in plan


def test_global_windows_stay_in_the_jvm(spark):
    for name in ("w8_ltv_quartiles", "w8_cumulative_share", "w3_rank_customers", "w8_order_gaps"):
        plan = _plan(spark, name)
        assert "Python" not in plan and "CartesianProduct" not in plan


def test_sql_over_registered_views_matches_the_dataframe_query(spark):
    from tillbook.plans.views import register_views
    register_views(spark, SF)
    sql = spark.sql("""
        WITH mr AS (SELECT date_format(o.order_purchase_timestamp, 'yyyy-MM') AS month, SUM(p.payment_value) AS revenue
                    FROM silver_orders o JOIN silver_order_payments p ON o.order_id = p.order_id GROUP BY 1)
        SELECT month, CAST(revenue AS DOUBLE) AS revenue,
               CAST(LAG(revenue) OVER (ORDER BY month) AS DOUBLE) AS prev_month_revenue
        FROM mr""")
    df = E.queries()["m_mom_growth"](spark, SF).drop("mom_growth_pct")
    assert sorted(sql.collect()) == sorted(df.collect())
