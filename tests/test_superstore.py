"""The flat sales lines and ORDERS: rows from tables with repeated and null keys, and plans."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tillbook.operators.dedup import distinct_by_key
from tillbook.plans.model import superstore
from tillbook.plans.superstore import ss_orders

SF = "/root/testdata/sf0.001"
D1, D2 = dt.datetime(1995, 1, 2), dt.datetime(1995, 3, 4)
TABLES = {
    "region": ("r_regionkey long, r_name string", [(0, "ASIA")]),
    "nation": ("n_nationkey long, n_name string, n_regionkey long", [(0, "JAPAN", 0), (1, "CHINA", 0)]),
    "customer": ("c_custkey long, c_name string, c_mktsegment string, c_nationkey long",
                 [(1, "a", "S", 0), (1, "a", "S", 0), (1, "a", "S", 1), (2, None, "S", 1), (None, "n", "S", 0)]),
    "part": ("p_partkey long, p_type string, p_brand string, p_name string, p_retailprice double",
             [(1, "T", "B", "p", 2.0), (1, "T", "B", "p", 2.0), (1, "T", "B", "p", 3.0), (2, "T", None, "q", None)]),
    # order 2 is one that arrives twice, 3 is there twice, 4 with two customers, 5 without one, 6 has no line
    "orders": ("o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string",
               [(1, 1, D1, "1"), (2, 1, D1, None), (3, 2, D1, "1"), (3, 2, D1, "1"), (4, 1, D1, "1"), (4, 2, D1, "1"),
                (5, None, D1, "1"), (6, 1, D1, "1"), (None, 1, D1, "1")]),
    "lineitem": ("l_orderkey long, l_partkey long, l_extendedprice double, l_quantity double, l_discount double, l_shipdate timestamp_ntz",
                 [(k, p, x, q, 0.1, s) for k in (1, 2, 3, 4, 5, 7, None) for p, x, q, s in
                  ((1, 1000.0, 1.0, D1), (1, 1200.0, 1.0, D1), (1, 1000.0, 0.0, D2), (2, 2000.0, 2.0, None), (2, None, 1.0, D1))]),
}


@pytest.fixture()
def folder(spark, scratch):
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{scratch}/{name}.parquet")
    return scratch


def _rows(df):
    return sorted(df.collect(), key=str)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_distinct_by_key_is_distinct(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (1, None), (None, "a"), (None, "a"), (2, "a")], "k long, v string")
    assert _rows(distinct_by_key(df, "k")) == _rows(df.distinct())


def test_orders_are_the_distinct_rows_of_the_lines(spark, folder):
    lines = superstore(spark, folder, dims=("order",))
    got = ss_orders(spark, folder)
    assert _rows(got) == _rows(lines.select(*got.columns).distinct())
    assert got.count() < lines.count()


def test_orders_are_sorted_once_and_held_in_no_hash_table(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(ss_orders(spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "HashAggregate" not in plan
    assert len(re.findall(r"\bSort \[", plan)) == len(re.findall(r"\bExchange hashpartitioning", plan)) == 2


@pytest.mark.parametrize("name", ["w3_normalise_orders", "w3_above_average", "w3_customer_totals", "w3_above_avg_customers", "w3_top5", "w3_bottom5",
                                  "w3_max_per_customer_ties", "w3_single_line", "w3_single_line_orders"])
def test_no_hash_table_has_all_columns_of_orders(spark, name):
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)\]", _plan(E.queries()[name](spark, SF)))
    assert not [k for k in keys if "ship_date" in k]


def test_raw_counts_of_repeated_and_null_keys(spark, folder):
    lines = superstore(spark, folder)
    got = E.queries()["w3_raw_counts"](spark, folder).first()
    assert got == lines.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(F.struct(*lines.columns)).alias("distinct_rows")).first()
    assert got.total_rows > got.distinct_rows > 0


def test_raw_counts_shuffles_no_whole_lines(spark):
    """Lines are dealt out by keys and by fingerprints, and names of customers come with the orders."""
    plan = _plan(E.queries()["w3_raw_counts"](spark, SF))
    assert "HashAggregate(keys=[struct(order_id" not in plan and "HashAggregate(keys=[f#" in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(E.queries()["w3_raw_counts"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(o_custkey" in plan or "hashpartitioning(customer_id" in plan
    # an exchange by customer is one of orders: no line is below it
    tree = plan.split("\n")
    at = next(n for n, x in enumerate(tree) if re.search(r"Exchange hashpartitioning\((o_custkey|customer_id)", x))
    depth = re.search(r"Exchange", tree[at]).start()
    below = []
    for x in tree[at + 1:]:
        m = re.search(r"[A-Za-z]", x)
        if not m or m.start() <= depth:
            break
        below.append(x)
    assert any("orders.parquet" in x for x in below) and not any("lineitem.parquet" in x for x in below)
