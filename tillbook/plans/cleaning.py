"""Cleaning and profiling jobs: Shop B raw inputs -> cleaned tables + quality
report; product-listing cleanup; column profiles.

Every defect count is a conditional count inside ONE aggregate per table,
and the report is the union of those one-row aggregates turned long.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbook.functions import (clip_null_safe, collapse_spaces, email_is_valid, ntz_literal, parse_multi_timestamp,
                                strip_non_numeric, title_case)
from tillbook.functions.dates import parse_timestamp
from tillbook.functions.text import EMAIL_PATTERN
from tillbook.operators.dedup import count_duplicates, fingerprint
from tillbook.operators.quality import describe_exact, null_counts, schema_frame
from tillbook.plans.model import (TITLE_SQL, listing, oracle, raw_items, raw_orders, raw_products, shop_customers,
                                  superstore)
from tillbook.plans.registry import register
from tillbook.sources.files import rename_strict
from tillbook.sources.tables import load

AS_OF = dt.datetime(2001, 6, 30)        # "now" of the cleaning run, a parameter for determinism
# Fixed values of the cleaning rules.
VALID_STATUSES = ("PLACED", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
ORDER_DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "d-M-yyyy", "yyyy-MM-dd")
DD_MM_PATTERN = r"^\d{2}-\d{2}-\d{4}$"

_SQL_DATE = ("COALESCE(try_strptime(trim(order_date), '%Y-%m-%d %H:%M:%S'), try_strptime(trim(order_date), '%d-%m-%Y'), "
             "try_strptime(trim(order_date), '%Y-%m-%d'))")
_SQL_CLEAN_ORDERS = f"""
SELECT order_id,
       TRY_CAST(NULLIF(trim(customer_id), '') AS BIGINT) AS customer_id,
       {_SQL_DATE} AS order_date,
       status,
       COALESCE({_SQL_DATE} > TIMESTAMP '{AS_OF}', FALSE) AS is_future,
       COALESCE(status IN {VALID_STATUSES!r}, FALSE) AS status_valid,
       COALESCE(regexp_matches(order_date, '{DD_MM_PATTERN}'), FALSE) AS had_dd_mm_date,
       (customer_id IS NULL OR trim(customer_id) = '') AS had_missing_customer
FROM raw_orders"""


# ------------------------------------------------------------------ Shop B cleaners
def clean_orders(df: DataFrame, as_of=AS_OF) -> DataFrame:
    """Blank customer -> NULL, numeric id, multi-format date (unparsable -> NULL),
    flags for future dates, invalid status, DD-MM-YYYY text and missing customer."""
    cust = F.trim(F.col("customer_id"))
    parsed = parse_multi_timestamp("order_date", ORDER_DATE_FORMATS)
    return df.select(
        "order_id",
        F.when(cust == "", F.lit(None)).otherwise(cust).try_cast("long").alias("customer_id"),
        parsed.alias("order_date"), "status",
        F.coalesce(parsed > ntz_literal(as_of), F.lit(False)).alias("is_future"),
        F.coalesce(F.col("status").isin(*VALID_STATUSES), F.lit(False)).alias("status_valid"),
        F.coalesce(F.col("order_date").rlike(DD_MM_PATTERN), F.lit(False)).alias("had_dd_mm_date"),
        (F.col("customer_id").isNull() | (cust == "")).alias("had_missing_customer"))


def clean_products(df: DataFrame) -> DataFrame:
    """Trim + title case + collapse inner blanks; ``was_messy`` compares with
    trim + title case before the collapse (as the original count does)."""
    titled = title_case("product_name")
    return df.select("product_id", collapse_spaces(titled).alias("product_name"), "category", "subcategory",
                     "cost_price", (F.col("product_name") != titled).alias("was_messy"))


def flag_items(items: DataFrame) -> DataFrame:
    """Flag returns, zero quantities and out-of-range discounts (rows kept) and
    clamp discount to [0, 100] keeping NULL."""
    d = F.col("discount_percent")
    return items.select("item_id", "order_id", "product_id", "quantity", "line_amount",
                        clip_null_safe(d, 0, 100).alias("discount_percent"),
                        (F.col("quantity") < 0).alias("is_return"), (F.col("quantity") == 0).alias("is_zero"),
                        ((d < 0) | (d > 100)).alias("discount_was_invalid"))


def clean_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Flagged lines without those whose order is unknown."""
    return flag_items(items).join(orders.select("order_id"), "order_id", "left_semi")


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Lines whose order id is not an order (a NULL order id is an orphan too)."""
    return items.join(orders.select("order_id").dropna(), "order_id", "left_anti").select("item_id", "order_id")


def invalid_emails(customers: DataFrame) -> DataFrame:
    return customers.filter(~email_is_valid("email")).select("customer_id", "email")


@register("w8_clean_orders", oracle(["raw_orders"], _SQL_CLEAN_ORDERS))
def clean_orders_q(spark, d):
    return clean_orders(raw_orders(spark, d))


@register("w8_clean_products", oracle(["raw_products"], f"""
SELECT product_id, regexp_replace({TITLE_SQL.format(x='product_name')}, '\\s+', ' ', 'g') AS product_name, category,
       subcategory, CAST(cost_price AS DOUBLE) AS cost_price,
       product_name <> {TITLE_SQL.format(x='product_name')} AS was_messy
FROM raw_products"""))
def clean_products_q(spark, d):
    return clean_products(raw_products(spark, d)).withColumn("cost_price", F.col("cost_price").cast("double"))


@register("w8_invalid_emails", oracle(["shop_customers"], f"""
SELECT customer_id, email FROM shop_customers WHERE NOT COALESCE(regexp_matches(email, '{EMAIL_PATTERN}'), FALSE)"""))
def invalid_emails_q(spark, d):
    return invalid_emails(shop_customers(spark, d))


@register("w8_orphans", oracle(["raw_items", "raw_orders"], """
SELECT item_id, order_id FROM raw_items WHERE order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL)
   OR order_id IS NULL"""))
def orphans_q(spark, d):
    return orphan_items(raw_items(spark, d), raw_orders(spark, d))


@register("w8_clean_items", oracle(["raw_items", "raw_orders"], """
SELECT item_id, order_id, product_id, quantity, CAST(line_amount AS DOUBLE) AS line_amount,
       CAST(CASE WHEN discount_percent IS NULL THEN NULL ELSE greatest(0, least(100, discount_percent)) END AS DOUBLE) AS discount_percent,
       quantity < 0 AS is_return, quantity = 0 AS is_zero, (discount_percent < 0 OR discount_percent > 100) AS discount_was_invalid
FROM raw_items WHERE order_id IN (SELECT order_id FROM raw_orders)"""))
def clean_items_q(spark, d):
    out = clean_items(raw_items(spark, d), raw_orders(spark, d))
    return (out.withColumn("line_amount", F.col("line_amount").cast("double"))
            .withColumn("discount_percent", F.col("discount_percent").cast("double")))


def _long(one: DataFrame, table: str, checks: list[str]) -> DataFrame:
    stacked = F.explode(F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("check_name"),
                                           F.col(c).cast("long").alias("n_rows")) for c in checks]))
    return one.select(stacked.alias("x")).select("x.*")


def quality_report(customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame,
                   as_of=AS_OF) -> DataFrame:
    """(table_name, check_name, n_rows) for every defect found; checks with no
    finding are left out, except the referential-integrity line which always appears."""
    co = clean_orders(orders, as_of)
    cp = clean_products(products)
    lines = flag_items(items)
    known = orders.select(F.col("order_id").alias("of")).dropna().distinct()
    lines = lines.join(known, lines["order_id"] == known["of"], "left")
    # one aggregate per table finds its defects, and the rows that repeat as a whole
    o_one = co.agg(F.count_if("had_missing_customer").alias("missing_customer_id"),
                   F.count_if(F.col("order_date").isNull()).alias("unparseable_order_date"),
                   F.count_if("had_dd_mm_date").alias("dd_mm_yyyy_dates"),
                   F.count_if("is_future").alias("future_order_date"),
                   F.count_if(~F.col("status_valid")).alias("invalid_status"), _repeats(co))
    p_one = cp.agg(F.count_if("was_messy").alias("messy_product_name"), _repeats(cp))
    i_one = lines.agg(F.count_if("is_return").alias("negative_quantity"), F.count_if("is_zero").alias("zero_quantity"),
                      F.count_if("discount_was_invalid").alias("discount_out_of_range"),
                      _repeats(lines, [c for c in lines.columns if c != "of"], F.col("of").isNotNull()),
                      F.count_if(F.col("of").isNull()).alias("orphan_items"))
    c_one = customers.agg(F.count_if(~email_is_valid("email")).alias("invalid_email"), _repeats(customers))
    parts = [_long(o_one, "orders", ["missing_customer_id", "unparseable_order_date", "dd_mm_yyyy_dates",
                                     "future_order_date", "invalid_status", "duplicate_rows"]),
             _long(p_one, "products", ["messy_product_name", "duplicate_rows"]),
             _long(i_one, "order_items", ["negative_quantity", "zero_quantity", "discount_out_of_range", "duplicate_rows", "orphan_items"]),
             _long(c_one, "customers", ["invalid_email", "duplicate_rows"])]
    return reduce(DataFrame.unionByName, parts).filter((F.col("n_rows") > 0) | (F.col("check_name") == "orphan_items"))


def _repeats(df: DataFrame, columns: list[str] | None = None, where: Column | None = None) -> Column:
    """The rows (where a condition holds) less the different ones, by their fingerprints."""
    row = fingerprint(df, columns)
    row = row if where is None else F.when(where, row)
    return (F.count(row) - F.count_distinct(row)).alias("duplicate_rows")


def _sql_quality() -> str:
    return f"""
WITH co AS ({_SQL_CLEAN_ORDERS}),
cp AS (SELECT product_id, regexp_replace({TITLE_SQL.format(x='product_name')}, '\\s+', ' ', 'g') AS product_name, category,
              subcategory, cost_price, product_name <> {TITLE_SQL.format(x='product_name')} AS was_messy FROM raw_products),
ci AS (SELECT item_id, order_id, product_id, quantity, line_amount,
              CASE WHEN discount_percent IS NULL THEN NULL ELSE greatest(0, least(100, discount_percent)) END AS discount_percent,
              quantity < 0 AS is_return, quantity = 0 AS is_zero,
              (discount_percent < 0 OR discount_percent > 100) AS discount_was_invalid
       FROM raw_items WHERE order_id IN (SELECT order_id FROM raw_orders)),
r AS (
  SELECT 'orders' AS table_name, 'missing_customer_id' AS check_name, COUNT(*) FILTER (WHERE had_missing_customer) AS n_rows FROM co
  UNION ALL SELECT 'orders', 'unparseable_order_date', COUNT(*) FILTER (WHERE order_date IS NULL) FROM co
  UNION ALL SELECT 'orders', 'dd_mm_yyyy_dates', COUNT(*) FILTER (WHERE had_dd_mm_date) FROM co
  UNION ALL SELECT 'orders', 'future_order_date', COUNT(*) FILTER (WHERE is_future) FROM co
  UNION ALL SELECT 'orders', 'invalid_status', COUNT(*) FILTER (WHERE NOT status_valid) FROM co
  UNION ALL SELECT 'products', 'messy_product_name', COUNT(*) FILTER (WHERE was_messy) FROM cp
  UNION ALL SELECT 'order_items', 'negative_quantity', COUNT(*) FILTER (WHERE quantity < 0) FROM raw_items
  UNION ALL SELECT 'order_items', 'zero_quantity', COUNT(*) FILTER (WHERE quantity = 0) FROM raw_items
  UNION ALL SELECT 'order_items', 'discount_out_of_range', COUNT(*) FILTER (WHERE discount_percent < 0 OR discount_percent > 100) FROM raw_items
  UNION ALL SELECT 'customers', 'invalid_email', COUNT(*) FILTER (WHERE NOT COALESCE(regexp_matches(email, '{EMAIL_PATTERN}'), FALSE)) FROM shop_customers
  UNION ALL SELECT 'customers', 'duplicate_rows', (SELECT COUNT(*) FROM shop_customers) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM shop_customers))
  UNION ALL SELECT 'products', 'duplicate_rows', (SELECT COUNT(*) FROM cp) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM cp))
  UNION ALL SELECT 'orders', 'duplicate_rows', (SELECT COUNT(*) FROM co) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM co))
  UNION ALL SELECT 'order_items', 'duplicate_rows', (SELECT COUNT(*) FROM ci) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM ci)))
SELECT table_name, check_name, CAST(n_rows AS BIGINT) AS n_rows FROM r WHERE n_rows > 0
UNION ALL
SELECT 'order_items', 'orphan_items', COUNT(*) FROM raw_items
WHERE order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL) OR order_id IS NULL"""


@register("w8_quality_report", oracle(["raw_orders", "raw_products", "raw_items", "shop_customers"], _sql_quality()))
def quality_report_q(spark, d):
    return quality_report(shop_customers(spark, d), raw_products(spark, d), raw_orders(spark, d), raw_items(spark, d))


# ------------------------------------------------------------------ product listing chain
def clean_listing(df: DataFrame) -> DataFrame:
    """fill gaps -> numeric coercion -> dedup -> currency cleanup -> total amount."""
    filled = df.fillna({"discount": 0.0, "seller_name": "Unknown"})
    typed = filled.withColumn("final_price", F.col("final_price").try_cast("double"))   # no symbol stripping here
    deduped = typed.dropDuplicates()
    priced = deduped.withColumn("initial_price", strip_non_numeric("initial_price"))
    return priced.withColumn("total_amount", F.col("initial_price") * F.col("ratings_count"))


@register("w1_clean_listing", oracle(["listing"], """
WITH f AS (SELECT title, rating, TRY_CAST(final_price AS DOUBLE) AS final_price, initial_price,
                  COALESCE(discount, 0.0) AS discount, ratings_count, COALESCE(seller_name, 'Unknown') AS seller_name
           FROM listing),
d AS (SELECT DISTINCT * FROM f),
p AS (SELECT title, rating, final_price,
             CASE WHEN regexp_replace(initial_price, '[^0-9.]', '', 'g') = '' THEN NULL
                  ELSE TRY_CAST(regexp_replace(initial_price, '[^0-9.]', '', 'g') AS DOUBLE) END AS initial_price,
             discount, ratings_count, seller_name FROM d)
SELECT *, initial_price * ratings_count AS total_amount FROM p"""))
def clean_listing_q(spark, d):
    return clean_listing(listing(spark, d))


# ------------------------------------------------------------------ profiles
@register("w5_null_counts", oracle(["raw_orders"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null FROM raw_orders"
    for c in ("order_id", "customer_id", "order_date", "status"))))
def null_counts_q(spark, d):
    return null_counts(raw_orders(spark, d))


@register("w5_cast_rename", oracle(["raw_orders"], """
SELECT order_id, TRY_CAST(order_date AS TIMESTAMP) AS order_timestamp, status AS order_status FROM raw_orders
WHERE NOT regexp_matches(order_date, '^[0-9]{2}-')"""))
def cast_rename_q(spark, d):
    """Text to timestamp (garbage gives NULL) and renamed columns; texts in the other date form are left to the cleaning job."""
    raw = raw_orders(spark, d).select("order_id", "order_date", "status").where(~F.col("order_date").rlike("^[0-9]{2}-"))
    typed = raw.withColumn("order_date", parse_timestamp("order_date"))
    return rename_strict(typed, {"order_date": "order_timestamp", "status": "order_status"})


@register("w5_dedup_counts", oracle(["superstore"], """
SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS distinct_rows, CAST(SUM(n - 1) AS BIGINT) AS duplicate_rows
FROM (SELECT COUNT(*) AS n FROM superstore GROUP BY order_id, product_id, sales, quantity, discount, ship_date)"""))
def dedup_counts_q(spark, d):
    return count_duplicates(superstore(spark, d, dims=()))


_DESCRIBE_COLS = ("l_quantity", "l_extendedprice", "l_discount")


@register("w1_describe", "\nUNION ALL\n".join(f"""
SELECT '{c}' AS column_name, COUNT({c}) AS count,
       ROUND(AVG({c}), 6) AS mean, ROUND(STDDEV_SAMP({c}), 6) AS std,
       CAST(MIN({c}) AS DOUBLE) AS min, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
       quantile_cont({c}, 0.75) AS p75, CAST(MAX({c}) AS DOUBLE) AS max
FROM lineitem""" for c in _DESCRIBE_COLS))
def describe_q(spark, d):
    # the last digits of a mean depend on the order of partial sums
    return (describe_exact(load(spark, d, "lineitem"), list(_DESCRIBE_COLS))
            .withColumns({c: F.round(c, 6) for c in ("mean", "std")}))


@register("q_profile", oracle(["raw_orders"], "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, COUNT({c}) AS non_null FROM raw_orders"
    for c, t in (("order_id", "bigint"), ("customer_id", "string"), ("order_date", "string"), ("status", "string")))))
def profile_q(spark, d):
    return schema_frame(spark, raw_orders(spark, d))


@register("w5_valid_contacts", oracle(["shop_customers"], """
SELECT customer_id, customer_name, email FROM shop_customers WHERE email IS NOT NULL AND customer_name <> ''"""))
def valid_contacts_q(spark, d):
    """Drop rows with a missing e-mail or an empty name (a NULL name is dropped too)."""
    c = shop_customers(spark, d)
    return c.filter(F.col("email").isNotNull() & (F.col("customer_name") != "")).select("customer_id", "customer_name", "email")


_HEAD_ORDER = ["title", "rating", "final_price", "initial_price", "discount", "ratings_count", "seller_name"]


@register("w1_head_tail", oracle(["listing"], f"""
(SELECT 'head' AS part, * FROM listing ORDER BY {", ".join(c + " ASC NULLS FIRST" for c in _HEAD_ORDER)} LIMIT 5)
UNION ALL
(SELECT 'tail' AS part, * FROM listing ORDER BY {", ".join(c + " DESC NULLS LAST" for c in _HEAD_ORDER)} LIMIT 5)"""))
def head_tail_q(spark, d, n: int = 5):
    """First and last n rows under an explicit total order (head/tail have no meaning without one)."""
    df = listing(spark, d)
    head = df.orderBy(*[F.col(c).asc_nulls_first() for c in _HEAD_ORDER]).limit(n)
    tail = df.orderBy(*[F.col(c).desc_nulls_last() for c in _HEAD_ORDER]).limit(n)
    return (head.select(F.lit("head").alias("part"), "*")
            .unionByName(tail.select(F.lit("tail").alias("part"), "*")))
