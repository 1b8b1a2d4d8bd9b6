"""Task-6 order lines: projection with a hidden filter column, rename + cast,
AND / OR filters, 18 % tax column, null-user cleanup."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillbook.plans.model import oracle, task_lines
from tillbook.plans.registry import register

CATEGORY = "PROMO"
AMOUNT_FLOOR = 50000
# Fixed value of the tax rule: final price = base price * 1.18, rounded to 2 places.
TAX_FACTOR = "1.18"

_ALL = ("product_id, old_name, category, CAST(price AS DOUBLE) AS price, CAST(base_price AS DOUBLE) AS base_price, "
        "status, CAST(amount AS DOUBLE) AS amount, user_id, region, priority")


def _flat(df):
    return df.select("product_id", "old_name", "category", F.col("price").cast("double").alias("price"),
                     F.col("base_price").cast("double").alias("base_price"), "status",
                     F.col("amount").cast("double").alias("amount"), "user_id", "region", "priority")


def with_tax(df):
    return df.withColumn("final_price", F.round(F.col("base_price") * F.lit(TAX_FACTOR).cast("decimal(3,2)"), 2))


@register("w6_electronics", oracle(["task_lines"], f"""
SELECT product_id, CAST(price AS DOUBLE) AS price FROM task_lines WHERE category = '{CATEGORY}'"""))
def electronics(spark, d):
    t = task_lines(spark, d)
    # filter first on the column that is not selected; Catalyst pushes it below the projection anyway
    return t.filter(F.col("category") == CATEGORY).select("product_id", F.col("price").cast("double").alias("price"))


@register("w6_rename_cast", oracle(["task_lines"], """
SELECT product_id, old_name AS new_name, category, CAST(price AS DOUBLE) AS price FROM task_lines"""))
def rename_cast(spark, d):
    t = task_lines(spark, d)
    return (t.withColumnsRenamed({"old_name": "new_name"}).withColumn("price", F.col("price").cast("double"))
            .select("product_id", "new_name", "category", "price"))


@register("w6_completed_high", oracle(["task_lines"], f"""
SELECT {_ALL} FROM task_lines WHERE status = 'Completed' AND amount > {AMOUNT_FLOOR}"""))
def completed_high(spark, d):
    t = task_lines(spark, d)
    return _flat(t.filter((F.col("status") == "Completed") & (F.col("amount") > AMOUNT_FLOOR)))


@register("w6_region_or_priority", oracle(["task_lines"], f"""
SELECT {_ALL} FROM task_lines WHERE region = 'North' OR priority = 'High'"""))
def region_or_priority(spark, d):
    t = task_lines(spark, d)
    return _flat(t.filter((F.col("region") == "North") | (F.col("priority") == "High")))


@register("w6_tax", oracle(["task_lines"], f"""
SELECT product_id, CAST(base_price AS DOUBLE) AS base_price,
       CAST(ROUND(base_price * CAST({TAX_FACTOR} AS DECIMAL(3,2)), 2) AS DOUBLE) AS final_price FROM task_lines"""))
def tax(spark, d):
    t = with_tax(task_lines(spark, d))
    return t.select("product_id", F.col("base_price").cast("double").alias("base_price"),
                    F.col("final_price").cast("double").alias("final_price"))


@register("w6_tax_known_users", oracle(["task_lines"], f"""
SELECT {_ALL}, CAST(ROUND(base_price * CAST({TAX_FACTOR} AS DECIMAL(3,2)), 2) AS DOUBLE) AS final_price
FROM task_lines WHERE user_id IS NOT NULL"""))
def tax_known_users(spark, d):
    """read -> tax -> drop null users (the written Parquet/CSV content)."""
    t = with_tax(task_lines(spark, d)).filter(F.col("user_id").isNotNull())
    return _flat_with_tax(t)


def _flat_with_tax(t):
    return t.select("product_id", "old_name", "category", F.col("price").cast("double").alias("price"),
                    F.col("base_price").cast("double").alias("base_price"), "status",
                    F.col("amount").cast("double").alias("amount"), "user_id", "region", "priority",
                    F.col("final_price").cast("double").alias("final_price"))


@register("w5_store_revenue", oracle(["task_lines"], """
SELECT region, CAST(SUM(COALESCE(price, 0)) AS DOUBLE) AS revenue
FROM (SELECT DISTINCT * FROM task_lines) GROUP BY region ORDER BY revenue DESC"""))
def store_revenue(spark, d):
    """dedup -> missing price as 0 -> revenue per store (region) -> order by revenue."""
    t = task_lines(spark, d).dropDuplicates().fillna({"price": 0})
    return (t.groupBy("region").agg(F.sum("price").cast("double").alias("revenue"))
            .orderBy(F.col("revenue").desc()))
