"""One run of the marketplace lake: bronze -> silver -> gold -> dimension
history -> schema drift, each table published as a new snapshot version.

The steps run in the original order and the first exception stops the run
(no scheduler). Silver reads the bronze versions just published, gold the silver
ones. The customer and product dimensions are read back from their previous
published version (initialised when none exists yet), merged with this run's
silver rows and published as the next version; drift compares each bronze schema
with the snapshot recorded by the previous run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillbook.operators.drift import check_and_record
from tillbook.operators.scd import scd2_changes, scd2_init, scd2_merge
from tillbook.plans import medallion as M
from tillbook.sources.files import read_csv
from tillbook.sources.snapshots import SnapshotStore

#: table -> (cleaning function, the bronze tables that it reads)
SILVER = {"customers": (M.clean_customers, ["customers"]), "sellers": (M.clean_sellers, ["sellers"]),
          "orders": (M.clean_orders, ["orders"]), "order_items": (M.clean_items, ["order_items"]),
          "order_payments": (M.clean_payments, ["order_payments"]), "order_reviews": (M.clean_reviews, ["order_reviews"]),
          "products": (M.clean_products, ["products", "product_category_name_translation"]),
          "geolocation": (M.clean_geolocation, ["geolocation"])}
#: table -> (aggregate, the silver tables that it reads)
GOLD = {"sales_by_category": (M.category_sales, ["order_items", "products"]),
        "revenue_by_state": (M.state_revenue, ["orders", "customers", "order_payments"]),
        "seller_performance": (M.seller_performance, ["order_items", "sellers"]),
        "customer_rfm": (M.customer_rfm, ["orders", "order_payments"])}
#: dimension -> (key, compared columns); its batch is the silver table of the same name
DIMENSIONS = {"customers": ("customer_id", M.SCD_COMPARE), "products": ("product_id", M.PRODUCT_COMPARE)}
LINEAGE = ("_ingestion_timestamp", "_source_file")


def export_landing_csv(spark: SparkSession, sf_dir: str, landing_dir: str) -> None:
    """Write every raw marketplace table as CSV files under ``landing_dir/<table>/``
    (the shape in which the raw extracts arrive)."""
    for name, view in M._MK_RAW.items():
        (view(spark, sf_dir).write.mode("overwrite").option("header", True).option("escape", '"')
         .csv(f"{landing_dir}/{name}"))


def run_lake(spark: SparkSession, sf_dir: str, root: str, batch_ts, customers: DataFrame | None = None,
             landing_dir: str | None = None) -> tuple[dict[str, int], DataFrame]:
    """Publish every layer under ``root``; returns (published versions, drift rows).
    ``customers`` overrides this run's customer batch (for example a later extract).
    With ``landing_dir`` the bronze layer ingests the landed CSV files instead of
    the warehouse views (types inferred, source file from the scan metadata)."""
    store = SnapshotStore(spark, root)
    versions: dict[str, int] = {}
    for name, view in M._MK_RAW.items():
        if landing_dir:
            raw = read_csv(spark, f"{landing_dir}/{name}", infer=True)
            src = None                                     # per-row file name from the scan
        else:
            raw, src = view(spark, sf_dir), name
        versions[f"bronze_{name}"] = store.publish(
            f"bronze_{name}", M.bronze(raw, ingested_at=batch_ts, source_file=src),
            allow_schema_change=True)                      # bronze accepts schema evolution
    # every layer reads what the one before has published, and keeps its schema
    for name, (clean, inputs) in SILVER.items():
        versions[f"silver_{name}"] = store.publish(
            f"silver_{name}", clean(*(store.read(f"bronze_{t}").drop(*LINEAGE) for t in inputs)))
    for name, (aggregate, inputs) in GOLD.items():
        versions[f"gold_{name}"] = store.publish(f"gold_{name}", aggregate(*(store.read(f"silver_{t}") for t in inputs)))

    for name, (key, compared) in DIMENSIONS.items():
        batch = customers if name == "customers" and customers is not None else store.read(f"silver_{name}")
        table = f"dim_{name}"
        if store.exists(table):              # only the buckets of new and changed keys are read again and written
            versions[table] = store.merge_keyed(
                table, scd2_changes(store.read(table), batch, key, compared), key,
                lambda dim, changes, key=key, compared=compared: scd2_merge(dim, changes, key, compared, batch_ts))
        else:
            versions[table] = store.publish_keyed(table, scd2_init(batch, batch_ts), key)

    drift = None
    for name in M._MK_RAW:
        d = check_and_record(spark, store.read(f"bronze_{name}"), name, f"{root}/_schema_history")
        drift = d if drift is None else drift.unionByName(d)
    return versions, drift
