import datetime as dt
import os

from pyspark.sql import functions as F

from tillbook.operators.scd import scd2_invariants
from tillbook.plans import medallion as M
from tillbook.plans.lake import run_lake
from tillbook.sources.snapshots import SnapshotStore

SF = "/root/testdata/sf0.001"


def test_two_lake_runs_keep_dimension_history(spark, scratch):
    root = os.path.join(scratch, "lake")
    v1, drift1 = run_lake(spark, SF, root, dt.datetime(2024, 1, 1))
    assert v1["dim_customers"] == 0 and {r.change for r in drift1.collect()} == {"baseline"}
    moved = M.silver_customers(spark, SF).withColumn(
        "customer_city", F.when(F.col("customer_id") % 10 == 1, F.concat("customer_city", F.lit("*")))
        .otherwise(F.col("customer_city")))
    v2, drift2 = run_lake(spark, SF, root, dt.datetime(2024, 2, 1), customers=moved)
    assert v2["dim_customers"] == 1 and drift2.count() == 0
    store = SnapshotStore(spark, root)
    dim = store.read("dim_customers")
    n_moved = moved.filter(F.col("customer_id") % 10 == 1).count()
    assert dim.count() == store.read("dim_customers", 0).count() + n_moved
    inv = scd2_invariants(dim, "customer_id").collect()[0]
    assert inv.keys_with_many_current == 0 and inv.inverted_intervals == 0
    assert store.read("gold_sales_by_category").count() > 0
    assert set(store.read("bronze_customers").columns) >= {"_ingestion_timestamp", "_source_file"}
    assert v2["dim_products"] == 1 and scd2_invariants(store.read("dim_products"), "product_id").collect()[0][:] == (0, 0)
    # the lake's layers are the same rows as the queries over the raw views
    for name, query in (("gold_sales_by_category", M.gold_category), ("gold_customer_rfm", M.gold_rfm), ("silver_orders", M.silver_orders)):
        assert sorted(map(repr, store.read(name).collect())) == sorted(map(repr, query(spark, SF).collect()))


def test_bronze_from_landed_csv(spark, scratch):
    from tillbook.plans.lake import export_landing_csv
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    export_landing_csv(spark, SF, landing)
    versions, drift = run_lake(spark, SF, root, dt.datetime(2024, 1, 1), landing_dir=landing)
    store = SnapshotStore(spark, root)
    bronze = store.read("bronze_customers")
    assert bronze.count() == M.mk_customers(spark, SF).count()
    assert bronze.filter(F.col("_source_file").endswith(".csv")).count() == bronze.count()
    assert {r.change for r in drift.collect()} == {"baseline"}


def test_a_landed_row_reaches_gold(spark, scratch):
    from tillbook.plans.lake import export_landing_csv
    landing, root = os.path.join(scratch, "landing"), os.path.join(scratch, "lake")
    export_landing_csv(spark, SF, landing)
    store = SnapshotStore(spark, root)
    run_lake(spark, SF, root, dt.datetime(2024, 1, 1), landing_dir=landing)
    before = {r.seller_id: r.total_items_sold for r in store.read("gold_seller_performance").collect()}
    # one more file with a line of seller 1 and a free one, in the same columns
    with open(os.path.join(landing, "order_items", "late.csv"), "w") as f:
        f.write("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
                "999999,1,1,1,1998-01-01 00:00:00,12.50,1.0\n999999,2,1,1,1998-01-01 00:00:00,0.00,1.0\n")
    run_lake(spark, SF, root, dt.datetime(2024, 2, 1), landing_dir=landing)
    after = {r.seller_id: r.total_items_sold for r in store.read("gold_seller_performance").collect()}
    assert after == before | {1: before[1] + 1}
    assert store.read("gold_seller_performance", 0).count() == len(before)
    zips = store.read("silver_geolocation").select(F.length("geolocation_zip_code_prefix").alias("n")).distinct().collect()
    assert [r.n for r in zips] == [5]
    times = dict(store.read("silver_orders").dtypes)
    assert all(times[c].startswith("timestamp") for c in M.ORDER_TIMES if c in times)
