"""Temp views for SQL users: every business view and silver table by name.

``register_views(spark, sf_dir)`` lets analysts run their SQL text with
``spark.sql`` over the same lazy plans the named queries use (tables named in
SQL instead of paths). Views are lazy: registering reads no data.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillbook.plans import medallion as M
from tillbook.plans.model import VIEWS

SILVER = {"silver_customers": M.silver_customers, "silver_sellers": M.silver_sellers,
          "silver_orders": M.silver_orders, "silver_order_items": M.silver_items,
          "silver_order_payments": M.silver_payments, "silver_order_reviews": M.silver_reviews,
          "silver_geolocation": M.silver_geolocation}


def register_views(spark: SparkSession, sf_dir: str, silver: bool = True) -> list[str]:
    names = []
    for name, v in VIEWS.items():
        v.build(spark, sf_dir).createOrReplaceTempView(name)
        names.append(name)
    if silver:
        for name, fn in SILVER.items():
            fn(spark, sf_dir).createOrReplaceTempView(name)
            names.append(name)
    return names
