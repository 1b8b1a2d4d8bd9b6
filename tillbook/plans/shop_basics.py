"""Shop A: selections, filters, aggregates, the join kinds, CASE tiers.

Filter constants are query parameters sized to the warehouse data (retail
prices here run from 900 to 1,000); they play the roles of the original
'Electronics above 2000', 'joined in 2024 in Maharashtra', and so on.
Year filters are written as half-open ranges on the raw column so Parquet
min/max statistics can skip row groups (``year(col) = k`` cannot be pushed).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tillbook.functions import avg_exact
from tillbook.plans.model import oracle, shopa_customers, shopa_items, shopa_orders, shopa_products
from tillbook.plans.registry import register

CATEGORY = "PROMO"
PRICE_FLOOR = 990
YEAR = 1996
STATE = "EUROPE"
DATE_FROM, DATE_TO = dt.date(1996, 8, 10), dt.date(1996, 8, 25)
BRANDS = ("Brand#1", "Brand#7")
HAVING_AVG = 950
# Fixed values of the price tier rule.
TIER_BUDGET_BELOW = 905
TIER_MID_UPTO = 910


def _dbl(c):
    return F.col(c).cast("double")


@register("w2_select_all", oracle(["shopa_customers"], "SELECT * FROM shopa_customers"))
def select_all(spark, d):
    return shopa_customers(spark, d).select("*")


@register("w2_select_columns", oracle(["shopa_customers"], "SELECT first_name, last_name, city FROM shopa_customers"))
def select_columns(spark, d):
    return shopa_customers(spark, d).select("first_name", "last_name", "city")


@register("w2_distinct_category", oracle(["shopa_products"], "SELECT DISTINCT category FROM shopa_products"))
def distinct_category(spark, d):
    return shopa_products(spark, d).select("category").distinct()


@register("w2_filter_status", oracle(["shopa_orders"], """
SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount
FROM shopa_orders WHERE status = 'Delivered'"""))
def filter_status(spark, d):
    o = shopa_orders(spark, d)
    return o.filter(F.col("status") == "Delivered").withColumn("total_amount", _dbl("total_amount"))


@register("w2_filter_and", oracle(["shopa_products"], f"""
SELECT product_id, product_name, category, brand, CAST(unit_price AS DOUBLE) AS unit_price, stock_qty
FROM shopa_products WHERE category = '{CATEGORY}' AND unit_price > {PRICE_FLOOR}"""))
def filter_and(spark, d):
    p = shopa_products(spark, d)
    return (p.filter((F.col("category") == CATEGORY) & (F.col("unit_price") > PRICE_FLOOR))
            .withColumn("unit_price", _dbl("unit_price")))


@register("w2_filter_year_range", oracle(["shopa_customers"], f"""
SELECT * FROM shopa_customers
WHERE join_date >= DATE '{YEAR}-01-01' AND join_date < DATE '{YEAR + 1}-01-01' AND state = '{STATE}'"""))
def filter_year_range(spark, d):
    c = shopa_customers(spark, d)
    return c.filter((F.col("join_date") >= F.lit(dt.date(YEAR, 1, 1))) & (F.col("join_date") < F.lit(dt.date(YEAR + 1, 1, 1)))
                    & (F.col("state") == STATE))


@register("w2_filter_year", oracle(["shopa_customers"], f"""
SELECT * FROM shopa_customers WHERE join_date >= DATE '{YEAR}-01-01' AND join_date < DATE '{YEAR + 1}-01-01'"""))
def filter_year(spark, d):
    c = shopa_customers(spark, d)
    return c.filter((F.col("join_date") >= F.lit(dt.date(YEAR, 1, 1))) & (F.col("join_date") < F.lit(dt.date(YEAR + 1, 1, 1))))


@register("w2_filter_between_not", oracle(["shopa_orders"], f"""
SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount
FROM shopa_orders WHERE order_date BETWEEN DATE '{DATE_FROM}' AND DATE '{DATE_TO}' AND status != 'Cancelled'"""))
def filter_between_not(spark, d):
    o = shopa_orders(spark, d)
    return (o.filter(F.col("order_date").between(F.lit(DATE_FROM), F.lit(DATE_TO)) & (F.col("status") != "Cancelled"))
            .withColumn("total_amount", _dbl("total_amount")))


@register("w2_filter_in", oracle(["shopa_products"], f"""
SELECT product_id, product_name, category, brand, CAST(unit_price AS DOUBLE) AS unit_price, stock_qty
FROM shopa_products WHERE brand IN {BRANDS!r}"""))
def filter_in(spark, d):
    p = shopa_products(spark, d)
    return p.filter(F.col("brand").isin(*BRANDS)).withColumn("unit_price", _dbl("unit_price"))


@register("w2_global_count", oracle(["shopa_orders"], "SELECT COUNT(*) AS n_orders FROM shopa_orders"))
def global_count(spark, d):
    return shopa_orders(spark, d).agg(F.count(F.lit(1)).alias("n_orders"))


@register("w2_sum_delivered", oracle(["shopa_orders"], """
SELECT CAST(SUM(total_amount) AS DOUBLE) AS delivered_amount FROM shopa_orders WHERE status = 'Delivered'"""))
def sum_delivered(spark, d):
    o = shopa_orders(spark, d)
    return o.filter(F.col("status") == "Delivered").agg(F.sum("total_amount").cast("double").alias("delivered_amount"))


@register("w2_avg_by_category", oracle(["shopa_products"], """
SELECT category, CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price FROM shopa_products GROUP BY category"""))
def avg_by_category(spark, d):
    p = shopa_products(spark, d)
    return p.groupBy("category").agg(avg_exact(F.sum("unit_price"), F.count("unit_price")).alias("avg_price"))


@register("w2_status_summary", oracle(["shopa_orders"], """
SELECT status, COUNT(*) AS n_orders, CAST(SUM(total_amount) AS DOUBLE) AS total_amount
FROM shopa_orders GROUP BY status ORDER BY SUM(total_amount) DESC"""))
def status_summary(spark, d):
    o = shopa_orders(spark, d)
    return (o.groupBy("status").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("total_amount").alias("t"))
            .orderBy(F.col("t").desc()).select("status", "n_orders", _dbl("t").alias("total_amount")))


@register("w2_minmax_by_category", oracle(["shopa_products"], """
SELECT category, CAST(MAX(unit_price) AS DOUBLE) AS max_price, CAST(MIN(unit_price) AS DOUBLE) AS min_price
FROM shopa_products GROUP BY category"""))
def minmax_by_category(spark, d):
    p = shopa_products(spark, d)
    return p.groupBy("category").agg(F.max("unit_price").cast("double").alias("max_price"),
                                     F.min("unit_price").cast("double").alias("min_price"))


@register("w2_having_avg", oracle(["shopa_products"], f"""
SELECT category, CAST(SUM(unit_price) AS DOUBLE) / COUNT(unit_price) AS avg_price
FROM shopa_products GROUP BY category HAVING SUM(unit_price) / COUNT(unit_price) > {HAVING_AVG}"""))
def having_avg(spark, d):
    p = shopa_products(spark, d)
    return (p.groupBy("category").agg(F.sum("unit_price").alias("s"), F.count("unit_price").alias("n"))
            .filter(F.col("s") / F.col("n") > HAVING_AVG)
            .select("category", avg_exact(F.col("s"), F.col("n")).alias("avg_price")))


@register("w2_inner_join", oracle(["shopa_orders", "shopa_customers"], """
SELECT o.order_id, o.order_date, c.first_name, c.last_name, CAST(o.total_amount AS DOUBLE) AS total_amount
FROM shopa_orders o INNER JOIN shopa_customers c ON o.customer_id = c.customer_id"""))
def inner_join(spark, d):
    o, c = shopa_orders(spark, d), shopa_customers(spark, d)
    return (o.join(c, "customer_id", "inner")
            .select("order_id", "order_date", "first_name", "last_name", _dbl("total_amount").alias("total_amount")))


_ORDER_SIDE = "o.order_id, o.customer_id AS order_customer_id, o.order_date, o.status, CAST(o.total_amount AS DOUBLE) AS total_amount"
_CUST_SIDE = "c.customer_id, c.first_name, c.last_name, c.email, c.city, c.state, c.join_date, c.is_premium"


def _two_sided(spark, d, how):
    c = shopa_customers(spark, d)
    o = (shopa_orders(spark, d).withColumnRenamed("customer_id", "order_customer_id")
         .withColumn("total_amount", _dbl("total_amount")))
    return c.join(o, c.customer_id == o.order_customer_id, how)


@register("w2_left_join", oracle(["shopa_customers", "shopa_orders"], f"""
SELECT {_CUST_SIDE}, {_ORDER_SIDE} FROM shopa_customers c LEFT JOIN shopa_orders o ON c.customer_id = o.customer_id"""))
def left_join(spark, d):
    return _two_sided(spark, d, "left")


@register("w2_right_join", oracle(["shopa_customers", "shopa_orders"], f"""
SELECT {_CUST_SIDE}, {_ORDER_SIDE} FROM shopa_customers c RIGHT JOIN shopa_orders o ON c.customer_id = o.customer_id"""))
def right_join(spark, d):
    return _two_sided(spark, d, "right")


@register("w2_full_join", oracle(["shopa_customers", "shopa_orders"], f"""
SELECT {_CUST_SIDE}, {_ORDER_SIDE} FROM shopa_customers c FULL OUTER JOIN shopa_orders o ON c.customer_id = o.customer_id"""))
def full_join(spark, d):
    return _two_sided(spark, d, "full")


@register("w2_three_way_join", oracle(["shopa_orders", "shopa_items", "shopa_products"], """
SELECT o.order_id, p.product_name, oi.quantity, CAST(oi.line_amount AS DOUBLE) AS line_amount,
       CAST(oi.discount_pct AS DOUBLE) AS discount_pct
FROM shopa_orders o JOIN shopa_items oi ON o.order_id = oi.order_id JOIN shopa_products p ON oi.product_id = p.product_id"""))
def three_way_join(spark, d):
    o = shopa_orders(spark, d).select("order_id")
    oi = shopa_items(spark, d)
    p = shopa_products(spark, d).select("product_id", "product_name")
    return (oi.join(o, "order_id").join(p, "product_id")
            .select("order_id", "product_name", "quantity", _dbl("line_amount").alias("line_amount"),
                    _dbl("discount_pct").alias("discount_pct")))


@register("w2_price_tier", oracle(["shopa_products"], f"""
SELECT product_name, CAST(unit_price AS DOUBLE) AS unit_price,
       (['Budget', 'Mid-Range', 'Premium'])[1 + CAST(unit_price >= {TIER_BUDGET_BELOW} AS INTEGER) + CAST(unit_price > {TIER_MID_UPTO} AS INTEGER)] AS price_tier
FROM shopa_products"""))
def price_tier(spark, d):
    p = shopa_products(spark, d)
    u = F.col("unit_price")
    tier = (F.when(u < TIER_BUDGET_BELOW, "Budget").when(u.between(TIER_BUDGET_BELOW, TIER_MID_UPTO), "Mid-Range")
            .otherwise("Premium"))
    return p.select("product_name", _dbl("unit_price").alias("unit_price"), tier.alias("price_tier"))


@register("w2_delivered_pivot", oracle(["shopa_orders"], """
SELECT COUNT(*) FILTER (status = 'Delivered') AS delivered_orders, COUNT(status) - COUNT(*) FILTER (status = 'Delivered') AS not_delivered_orders
FROM shopa_orders"""))
def delivered_pivot(spark, d):
    o = shopa_orders(spark, d)
    # NULL status lands in neither bucket, as with the CASE form
    return o.agg(F.count_if(F.col("status") == "Delivered").alias("delivered_orders"),
                 F.count_if(F.col("status") != "Delivered").alias("not_delivered_orders"))


PREMIUM_FROM, PREMIUM_TO = dt.date(1995, 1, 1), dt.date(1995, 12, 31)


@register("w5_premium_between", oracle(["shopa_customers"], f"""
SELECT customer_id, first_name, last_name, join_date FROM shopa_customers
WHERE join_date BETWEEN DATE '{PREMIUM_FROM}' AND DATE '{PREMIUM_TO}' AND is_premium"""))
def premium_between(spark, d):
    """Inclusive range on one attribute AND a flag (the 'age 18-30 and Premium' filter)."""
    c = shopa_customers(spark, d)
    return (c.filter(F.col("join_date").between(F.lit(PREMIUM_FROM), F.lit(PREMIUM_TO)) & F.col("is_premium"))
            .select("customer_id", "first_name", "last_name", "join_date"))
