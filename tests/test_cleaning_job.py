"""Jobs that write: the report's text, cleaned files, the listing, and normalised tables by name."""

import os

from pyspark.sql import functions as F

from tillbook.plans import catalog
from tillbook.plans import cleaning as C
from tillbook.plans import cleaning_job as J
from tillbook.plans.model import raw_items, raw_orders, raw_products, shop_customers
from tillbook.sources.files import read_csv
from tillbook.sources.snapshots import SnapshotStore

SF = "/root/testdata/sf0.001"

# The counts of the shipped report and its text.
GOLDEN_COUNTS = [("orders", "missing_customer_id", 59), ("orders", "dd_mm_yyyy_dates", 102), ("products", "messy_product_name", 45),
                 ("order_items", "negative_quantity", 99), ("customers", "invalid_email", 5), ("order_items", "orphan_items", 0)]
GOLDEN_IDS = [122, 198, 251, 407, 446]
GOLDEN_TEXT = """=== DATA CLEANING REPORT ===
[orders] 59 rows had missing customer_id -> set to NULL (kept as NaN)
[orders] 102 rows had DD-MM-YYYY date format -> normalized to YYYY-MM-DD HH:MM:SS
[products] 45 rows had messy product_name (extra spaces/mixed case) -> normalized
[order_items] 99 rows have negative quantity (treated as returns, kept)
[customers] 5 customer_ids have invalid emails: [122, 198, 251, 407, 446]
[order_items] No orphan order_items found (referential integrity OK)"""


def lines(df):
    return [r["value"] for r in df.orderBy("line").collect()]


def test_report_replays_the_golden_text(spark):
    report = spark.createDataFrame(GOLDEN_COUNTS, "table_name string, check_name string, n_rows long")
    ids = spark.createDataFrame([(i,) for i in reversed(GOLDEN_IDS)], "customer_id long")
    assert "\n".join(lines(J.report_lines(report, ids, ids.limit(0)))) == GOLDEN_TEXT


def test_report_shows_the_first_ids(spark):
    report = spark.createDataFrame([("order_items", "orphan_items", 11), ("customers", "invalid_email", 10)], "table_name string, check_name string, n_rows long")
    got = lines(J.report_lines(report, spark.range(10), spark.range(100, 111)))
    assert got[1] == "[customers] 10 customer_ids have invalid emails: [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]"
    assert got[2] == "[order_items] 11 items reference non-existent order_id: [100, 101, 102, 103, 104, 105, 106, 107, 108, 109]..."


def test_cleaning_writes_files_and_report(spark, scratch):
    raw = shop_customers(spark, SF), raw_products(spark, SF), raw_orders(spark, SF), raw_items(spark, SF)
    J.run_cleaning(*raw, scratch)
    with open(os.path.join(scratch, "data_quality_report", next(n for n in os.listdir(f"{scratch}/data_quality_report") if n.startswith("part-")))) as f:
        assert f.read().splitlines() == lines(J.report_lines_q(spark, SF))
    products = read_csv(spark, f"{scratch}/products_clean", raw[1].schema, mode="FAILFAST")
    want = C.clean_products(raw[1]).select(*raw[1].columns).distinct()
    assert sorted(map(repr, products.collect())) == sorted(map(repr, want.collect())) and products.count() > 0
    items = read_csv(spark, f"{scratch}/order_items_clean", raw[3].schema, mode="FAILFAST")
    orders = read_csv(spark, f"{scratch}/orders_clean", "order_id long, customer_id long, order_date timestamp_ntz, status string")
    assert items.count() == items.distinct().count() == C.clean_items(raw[3], raw[2]).select(*raw[3].columns).distinct().count()
    assert items.join(orders, "order_id", "left_anti").count() == 0
    assert items.where("discount_percent > 100 OR discount_percent < 0").count() == 0
    assert read_csv(spark, f"{scratch}/customers_clean", raw[0].schema).count() == raw[0].distinct().count()


def test_normalised_tables_are_found_by_name(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "named"))
    assert J.save_normalised(spark, SF, store) == {"customers": 0, "orders": 0, "products": 0}
    for name, table in J.NORMALISED.items():
        assert sorted(map(repr, store.read(name).collect())) == sorted(map(repr, table(spark, SF).collect()))
    counts = {r["table_name"]: r["n_rows"] for r in J.loaded_counts(store, list(J.NORMALISED)).collect()}
    assert counts == {n: store.read(n).count() for n in J.NORMALISED}
    # counts tell of the sink, not of what was meant for it
    store.publish("products", store.read("products").limit(3))
    assert J.loaded_counts(store, ["products"]).first()["n_rows"] == 3


def test_views_of_the_listing(spark):
    schema = "title string, final_price string, rating double"
    rows = [("a", "99.5", 4.5), ("b", "100", 4.9), ("c", "Rs.5", 5.0), ("d", None, 4.1), ("e", "1", 4.0), ("f", "1", None)]
    df = spark.createDataFrame(rows, schema)
    assert sorted(map(tuple, J.top_rated(df).collect())) == [("a", 99.5, 4.5), ("b", 100.0, 4.9), ("c", None, 5.0), ("d", None, 4.1)]
    assert [r.title for r in J.top_rated(df, 100).collect()] == ["a"]


def test_queries_meet_their_cases(spark):
    q = catalog.queries()
    ranks = q["w8_dense_rank_lines"](spark, "/root/testdata/sf0.01")
    assert ranks.groupBy("category", "rank_in_category").count().where("count > 1").count() > 10
    assert q["w3_single_line_orders"](spark, SF).count() > 0
    assert q["w8_report_lines"](spark, SF).where(F.col("value").contains("...")).count() > 0
