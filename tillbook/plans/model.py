"""Business views over the warehouse tables.

The jobs were written against several shop schemas (a four-table shop with
constraints, a second shop with returns and messy inputs, a flat superstore
line table, a marketplace lake). Each schema is expressed here as a lazy
DataFrame over the warehouse tables, together with the same view written in
SQL for the oracle check. Defects that the cleaning jobs look for are derived
deterministically from keys (modulus rules), so both engines agree on them.

Scale notes: views only *describe* columns; joins are added only by the views
that need them (an inner join on a foreign key cannot be pruned by Catalyst,
so a query never pays for a dimension it does not read). No view hints a
broadcast: Spark decides by the sizes it measures.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions.money import MONEY, RATE
from tillbook.sources.tables import load

# Fixed model parameters (deterministic defect and attribute rules).
ORDER_NULL_CUSTOMER = (20, 7)       # o_orderkey % 20 = 7 -> order without customer id
EMAIL_BAD = (50, 3)                 # c_custkey % 50 = 3 -> e-mail without '@'
EMAIL_NULL = (50, 11)               # c_custkey % 50 = 11 -> e-mail missing
REGISTRATION_BASE = "1994-06-01"    # registration = base + (c_custkey * 37) % 1800 days
SHOPA_CANCELLED = (11, 4)           # o_orderkey % 11 = 4 -> order cancelled (shop A)
WEIGHT_NULL = 17                    # p_partkey % 17 = 0 -> product weight missing
UNTRANSLATED_CATEGORY = "PROMO"     # category without an English translation
REPEATED = (9, 2)                   # key % 9 = 2 -> the marketplace or superstore row arrives twice
FREE_ITEM = (29, 4)                 # l_orderkey % 29 = 4 -> line with price 0
SECOND_PAYMENT = (5, 1)             # o_orderkey % 5 = 1 -> paid in two equal instalments
NEGATIVE_PAYMENT = (31, 3)          # o_orderkey % 31 = 3 -> payment below 0
BAD_TIME = (41, 6)                  # o_orderkey % 41 = 6 -> approval time is no time
ZIP_PLACES = 700                    # places of the geolocation table
NO_SUCH_CUSTOMER = (7, 3)           # o_custkey % 7 = 3 -> shop A order of an unknown customer


@dataclass(frozen=True)
class View:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str


VIEWS: dict[str, View] = {}


def view(name: str, sql: str):
    def deco(fn):
        VIEWS[name] = View(name, fn, sql.strip())
        return fn
    return deco


def oracle(views: list[str], body: str) -> str:
    """Prefix ``body`` with the CTEs of ``views`` (and their dependencies)."""
    ordered: list[str] = []

    def add(v: str):
        if v in ordered:
            return
        for dep in VIEW_DEPS.get(v, ()):
            add(dep)
        ordered.append(v)

    for v in views:
        add(v)
    ctes = ",\n".join(f"{v} AS (\n{VIEWS[v].sql}\n)" for v in ordered)
    body = body.strip()
    if body[:4].upper() == "WITH":
        return f"WITH {ctes},\n{body[4:].lstrip()}"
    return f"WITH {ctes}\n{body}"


VIEW_DEPS = {
    "shop_orders_region": ("geo", "shop_orders"),
    "shopa_customers": ("geo",),
    "superstore": ("geo",),
    "mk_customers": ("geo",),
    "mk_sellers": ("geo",),
    "mk_orders_delivery": ("mk_orders",),
    "mk_products": ("mk_translation",),
    }


def _mod(col: str, rule: tuple[int, int]):
    return (F.col(col) % rule[0]) == rule[1]


# --------------------------------------------------------------------------------------
# geography: nation + region (fixed size)

@view("geo", """
SELECT n_nationkey AS nation_key, n_name AS nation_name, r_name AS region_name
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def geo(spark: SparkSession, d: str) -> DataFrame:
    nation, region = load(spark, d, "nation"), load(spark, d, "region")
    return (nation.join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("n_nationkey").alias("nation_key"), F.col("n_name").alias("nation_name"),
                    F.col("r_name").alias("region_name")))


# --------------------------------------------------------------------------------------
# Shop B: customers / products / orders / order_items (returns are negative quantities)

@view("shop_customers", f"""
SELECT c_custkey AS customer_id, c_name AS customer_name,
       CASE WHEN c_custkey % {EMAIL_NULL[0]} = {EMAIL_NULL[1]} THEN NULL
            WHEN c_custkey % {EMAIL_BAD[0]} = {EMAIL_BAD[1]} THEN lower(replace(c_name, '#', '.')) || '.example.com'
            ELSE lower(replace(c_name, '#', '.')) || '@example.com' END AS email,
       DATE '{REGISTRATION_BASE}' + CAST((c_custkey * 37) % 1800 AS INTEGER) AS registration_date,
       c_mktsegment AS customer_type, c_nationkey AS nation_key
FROM customer
""")
def shop_customers(spark, d):
    c = load(spark, d, "customer")
    handle = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit(".")))
    email = (F.when(_mod("c_custkey", EMAIL_NULL), F.lit(None).cast("string"))
             .when(_mod("c_custkey", EMAIL_BAD), F.concat(handle, F.lit(".example.com")))
             .otherwise(F.concat(handle, F.lit("@example.com"))))
    return c.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("customer_name"), email.alias("email"),
        F.date_add(F.lit(REGISTRATION_BASE).cast("date"), ((F.col("c_custkey") * 37) % 1800).cast("int"))
        .alias("registration_date"),
        F.col("c_mktsegment").alias("customer_type"), F.col("c_nationkey").alias("nation_key"))


@view("shop_products", f"""
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS subcategory,
       CAST(p_retailprice AS {MONEY.upper()}) AS cost_price
FROM part
""")
def shop_products(spark, d):
    p = load(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"), F.col("p_brand").alias("subcategory"),
                    F.col("p_retailprice").cast(MONEY).alias("cost_price"))


_STATUS_B = "CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'SHIPPED' ELSE 'PLACED' END"


@view("shop_orders", f"""
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % {ORDER_NULL_CUSTOMER[0]} = {ORDER_NULL_CUSTOMER[1]} THEN NULL ELSE o_custkey END AS customer_id,
       o_orderdate AS order_date, {_STATUS_B} AS status, o_custkey AS account_key
FROM orders
""")
def shop_orders(spark, d):
    o = load(spark, d, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "DELIVERED").when(F.col("o_orderstatus") == "O", "SHIPPED")
              .otherwise("PLACED"))
    return o.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(_mod("o_orderkey", ORDER_NULL_CUSTOMER), F.lit(None).cast("long")).otherwise(F.col("o_custkey"))
        .alias("customer_id"),
        F.col("o_orderdate").alias("order_date"), status.alias("status"), F.col("o_custkey").alias("account_key"))


@view("shop_orders_region", """
SELECT o.*, g.region_name AS region_code
FROM shop_orders o JOIN customer c ON c.c_custkey = o.account_key JOIN geo g ON g.nation_key = c.c_nationkey
""")
def shop_orders_region(spark, d):
    """Orders with the region of the buying account (one extra join on the customer key)."""
    c = load(spark, d, "customer").select("c_custkey", "c_nationkey")
    g = geo(spark, d)
    return (shop_orders(spark, d).join(c, F.col("account_key") == F.col("c_custkey"))
            .join(g, F.col("c_nationkey") == g.nation_key)
            .drop("c_custkey", "c_nationkey", "nation_key", "nation_name")
            .withColumnRenamed("region_name", "region_code"))


@view("shop_items", f"""
SELECT l_orderkey * 100 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(CASE WHEN l_returnflag = 'R' THEN -l_quantity ELSE l_quantity END AS INTEGER) AS quantity,
       CAST(l_extendedprice AS {MONEY.upper()}) AS line_amount,
       CAST(l_discount AS {RATE.upper()}) * 100 AS discount_percent,
       CAST(l_extendedprice AS {MONEY.upper()}) * (1 - CAST(l_discount AS {RATE.upper()})) AS net_amount
FROM lineitem
""")
def shop_items(spark, d):
    li = load(spark, d, "lineitem")
    amount = F.col("l_extendedprice").cast(MONEY)
    disc = F.col("l_discount").cast(RATE)
    return li.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("item_id"),
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity")).cast("int")
        .alias("quantity"),
        amount.alias("line_amount"), (disc * 100).alias("discount_percent"),
        (amount * (F.lit(1) - disc)).alias("net_amount"))


# --------------------------------------------------------------------------------------
# Shop A: constrained four-table shop

_STATUS_A = (f"CASE WHEN o_orderkey % {SHOPA_CANCELLED[0]} = {SHOPA_CANCELLED[1]} THEN 'Cancelled' "
             "WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Shipped' ELSE 'Pending' END")


@view("shopa_customers", f"""
SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
       lower(replace(c_name, '#', '.')) || '@example.com' AS email, g.nation_name AS city, g.region_name AS state,
       DATE '{REGISTRATION_BASE}' + CAST((c_custkey * 37) % 1800 AS INTEGER) AS join_date,
       c_acctbal > 5000 AS is_premium
FROM customer JOIN geo g ON g.nation_key = c_nationkey
""")
def shopa_customers(spark, d):
    c = load(spark, d, "customer")
    g = geo(spark, d)
    return c.join(g, c.c_nationkey == g.nation_key).select(
        F.col("c_custkey").alias("customer_id"), F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("nation_name").alias("city"), F.col("region_name").alias("state"),
        F.date_add(F.lit(REGISTRATION_BASE).cast("date"), ((F.col("c_custkey") * 37) % 1800).cast("int"))
        .alias("join_date"),
        (F.col("c_acctbal") > 5000).alias("is_premium"))


@view("shopa_products", """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
       CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price, p_size AS stock_qty
FROM part
""")
def shopa_products(spark, d):
    p = load(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
                    F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
                    F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
                    F.col("p_size").alias("stock_qty"))


@view("shopa_orders", f"""
SELECT o_orderkey AS order_id, IF(o_custkey % {NO_SUCH_CUSTOMER[0]} = {NO_SUCH_CUSTOMER[1]}, -o_custkey, o_custkey) AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       {_STATUS_A} AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount
FROM orders
""")
def shopa_orders(spark, d):
    o = load(spark, d, "orders")
    status = (F.when(_mod("o_orderkey", SHOPA_CANCELLED), "Cancelled")
              .when(F.col("o_orderstatus") == "F", "Delivered").when(F.col("o_orderstatus") == "O", "Shipped")
              .otherwise("Pending"))
    customer = F.when(_mod("o_custkey", NO_SUCH_CUSTOMER), -F.col("o_custkey")).otherwise(F.col("o_custkey"))
    return o.select(F.col("o_orderkey").alias("order_id"), customer.alias("customer_id"),
                    F.to_date("o_orderdate").alias("order_date"), status.alias("status"),
                    F.col("o_totalprice").cast("decimal(12,2)").alias("total_amount"))


@view("shopa_items", f"""
SELECT l_orderkey * 100 + l_linenumber AS item_id, l_orderkey AS order_id, l_partkey AS product_id,
       CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS {MONEY.upper()}) AS line_amount,
       CAST(l_discount AS {RATE.upper()}) * 100 AS discount_pct
FROM lineitem
""")
def shopa_items(spark, d):
    li = load(spark, d, "lineitem")
    return li.select((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("item_id"),
                     F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     F.col("l_quantity").cast("int").alias("quantity"),
                     F.col("l_extendedprice").cast(MONEY).alias("line_amount"),
                     (F.col("l_discount").cast(RATE) * 100).alias("discount_pct"))


# --------------------------------------------------------------------------------------
# Superstore flat lines: lineitem joined with its order, customer, geography and part

@view("superstore", f"""
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date,
       o_orderpriority AS ship_mode, c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
       g.nation_name AS state, g.region_name AS region, p_partkey AS product_id, p_type AS category,
       p_brand AS sub_category, p_name AS product_name,
       CAST(ROUND(l_extendedprice / 1000) * 1000 AS {MONEY.upper()}) AS sales, CAST(l_quantity AS INTEGER) AS quantity,
       CAST(l_discount AS {RATE.upper()}) AS discount,
       CAST(ROUND(l_extendedprice / 1000) * 1000 AS {MONEY.upper()}) * (1 - CAST(l_discount AS {RATE.upper()}))
         - CAST(l_quantity AS INTEGER) * CAST(p_retailprice AS {MONEY.upper()}) AS profit
FROM lineitem JOIN (VALUES (FALSE), (TRUE)) AS t(again) ON NOT again OR l_orderkey % {REPEATED[0]} = {REPEATED[1]} JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
     JOIN geo g ON g.nation_key = c_nationkey JOIN part ON p_partkey = l_partkey
""")
def superstore(spark, d, dims=("order", "customer", "product"), distinct_lines: bool = False):
    """Flat sales lines. ``dims`` limits the joins to what the caller reads:
    'order' (dates, ship mode), 'customer' (name, segment, state, region),
    'product' (category, names, profit). Dropping an unread dimension leaves the
    lines as they are only because every foreign key has its row, which
    ``tests/test_invariants.py`` checks. Sales are whole thousands, so customers
    tie, and the lines of some orders arrive twice."""
    li = _twice(load(spark, d, "lineitem"), "l_orderkey")
    amount = (F.round(F.col("l_extendedprice") / 1000) * 1000).cast(MONEY)
    df = li.select("l_orderkey", "l_partkey", amount.alias("sales"),
                   F.col("l_quantity").cast("int").alias("quantity"),
                   F.col("l_discount").cast(RATE).alias("discount"),
                   F.to_date("l_shipdate").alias("ship_date"))
    if distinct_lines:
        # dimension keys are unique (checked by the constraint jobs), so a duplicate
        # joined line is exactly a duplicate fact line: dedup the narrow fact first
        df = df.dropDuplicates()
    dims = set(dims)
    if "customer" in dims:
        dims.add("order")
    if "order" in dims:
        o = superstore_orders(spark, d)
        if "customer" in dims:
            # an order meets its customer before its lines do, which are several times as many
            c = load(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
            g = geo(spark, d)
            o = (o.join(c, F.col("customer_id") == F.col("c_custkey"))
                 .join(g, F.col("c_nationkey") == g.nation_key).drop("c_custkey")
                 .withColumnRenamed("c_name", "customer_name")
                 .withColumnRenamed("c_mktsegment", "segment").withColumnRenamed("nation_name", "state")
                 .withColumnRenamed("region_name", "region").drop("c_nationkey", "nation_key"))
        df = df.join(o, F.col("l_orderkey") == F.col("order_id")).drop("l_orderkey")
    else:
        df = df.withColumnRenamed("l_orderkey", "order_id")
    if "product" in dims:
        p = load(spark, d, "part").select("p_partkey", "p_type", "p_brand", "p_name", "p_retailprice")
        df = (df.join(p, F.col("l_partkey") == F.col("p_partkey"))
              .withColumn("profit", F.col("sales") * (F.lit(1) - F.col("discount"))
                          - F.col("quantity") * F.col("p_retailprice").cast(MONEY))
              .withColumnRenamed("p_partkey", "product_id").withColumnRenamed("p_type", "category")
              .withColumnRenamed("p_brand", "sub_category").withColumnRenamed("p_name", "product_name")
              .drop("p_retailprice", "l_partkey"))
    else:
        df = df.withColumnRenamed("l_partkey", "product_id")
    return df


def superstore_orders(spark, d):
    """What a flat line has from its order."""
    return load(spark, d, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.to_date("o_orderdate").alias("order_date"),
        F.col("o_orderpriority").alias("ship_mode"), F.col("o_custkey").alias("customer_id"))


# --------------------------------------------------------------------------------------
# Marketplace lake (bronze inputs)

def _zip(key_col: str):
    """Raw zip prefix as a number (CSV inference drops leading zeros); silver pads it."""
    return (F.col(key_col) * 7919) % 100000


_ZIP_SQL = "(({k} * 7919) % 100000)"


def _twice(rows: DataFrame, key: str, **changed) -> DataFrame:
    """``rows``, and the ones with a repeated key once more, with ``changed`` columns."""
    again = rows.filter(_mod(key, REPEATED)).withColumns(changed) if changed else rows.filter(_mod(key, REPEATED))
    return rows.unionByName(again)


def _time_text(c):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


@view("mk_customers", f"""
SELECT c_custkey AS customer_id, {_ZIP_SQL.format(k='c_custkey')} AS customer_zip_code_prefix,
       IF(again, 'zzz', c_name) AS customer_city, g.nation_name AS customer_state
FROM customer JOIN geo g ON g.nation_key = c_nationkey JOIN (VALUES (FALSE), (TRUE)) AS t(again)
  ON NOT again OR c_custkey % {REPEATED[0]} = {REPEATED[1]}
""")
def mk_customers(spark, d):
    c = load(spark, d, "customer")
    g = geo(spark, d)
    rows = c.join(g, c.c_nationkey == g.nation_key).select(
        F.col("c_custkey").alias("customer_id"), _zip("c_custkey").alias("customer_zip_code_prefix"),
        F.col("c_name").alias("customer_city"), F.col("nation_name").alias("customer_state"))
    return _twice(rows, "customer_id", customer_city=F.lit("zzz"))


@view("mk_sellers", f"""
SELECT s_suppkey AS seller_id, {_ZIP_SQL.format(k='s_suppkey')} AS seller_zip_code_prefix,
       IF(again, 'ZZZ', g.nation_name) AS seller_state
FROM supplier JOIN geo g ON g.nation_key = s_nationkey JOIN (VALUES (FALSE), (TRUE)) AS t(again)
  ON NOT again OR s_suppkey % {REPEATED[0]} = {REPEATED[1]}
""")
def mk_sellers(spark, d):
    s = load(spark, d, "supplier")
    g = geo(spark, d)
    rows = s.join(g, s.s_nationkey == g.nation_key).select(
        F.col("s_suppkey").alias("seller_id"), _zip("s_suppkey").alias("seller_zip_code_prefix"),
        F.col("nation_name").alias("seller_state"))
    return _twice(rows, "seller_id", seller_state=F.lit("ZZZ"))


_TIME_SQL = "strftime({t}, '%Y-%m-%d %H:%M:%S')"


@view("mk_orders", f"""
SELECT o_orderkey AS order_id, o_custkey AS customer_id, {_TIME_SQL.format(t='o_orderdate')} AS order_purchase_timestamp,
       CASE WHEN o_orderkey % {BAD_TIME[0]} = {BAD_TIME[1]} THEN 'soon' ELSE {_TIME_SQL.format(t='o_orderdate + INTERVAL 1 DAY')} END
         AS order_approved_at,
       CASE WHEN o_orderstatus <> 'O' THEN {_TIME_SQL.format(t='o_orderdate + INTERVAL 3 DAY')} END AS order_delivered_carrier_date,
       {_TIME_SQL.format(t='o_orderdate + INTERVAL 30 DAY')} AS order_estimated_delivery_date,
       IF(again, 'ZZ', o_orderstatus) AS order_status
FROM orders JOIN (VALUES (FALSE), (TRUE)) AS t(again) ON NOT again OR o_orderkey % {REPEATED[0]} = {REPEATED[1]}
""")
def mk_orders(spark, d):
    """Times arrive as text, some keys arrive twice with another status."""
    o = load(spark, d, "orders")
    at = lambda days: _time_text(F.col("o_orderdate") + F.expr(f"INTERVAL {days} DAYS"))
    rows = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                    _time_text("o_orderdate").alias("order_purchase_timestamp"),
                    F.when(_mod("o_orderkey", BAD_TIME), "soon").otherwise(at(1)).alias("order_approved_at"),
                    F.when(F.col("o_orderstatus") != "O", at(3)).alias("order_delivered_carrier_date"),
                    at(30).alias("order_estimated_delivery_date"), F.col("o_orderstatus").alias("order_status"))
    return _twice(rows, "order_id", order_status=F.lit("ZZ"))


@view("mk_orders_delivery", """
SELECT o.*, CASE WHEN o.order_status = 'F' THEN s.last_ship END AS order_delivered_customer_date
FROM mk_orders o LEFT JOIN (SELECT l_orderkey, strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') AS last_ship FROM lineitem GROUP BY l_orderkey) s
  ON s.l_orderkey = o.order_id
""")
def mk_orders_delivery(spark, d):
    """Orders with a delivery time: the last ship date of a finished order.
    The per-order max is hash-partitioned on the order key, which the join reuses."""
    last_ship = (load(spark, d, "lineitem").groupBy("l_orderkey")
                 .agg(_time_text(F.max("l_shipdate")).alias("last_ship")))
    o = mk_orders(spark, d)
    return (o.join(last_ship, o.order_id == last_ship.l_orderkey, "left")
            .withColumn("order_delivered_customer_date",
                        F.when(F.col("order_status") == "F", F.col("last_ship")))
            .drop("l_orderkey", "last_ship"))


@view("mk_items", f"""
SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id, l_suppkey AS seller_id,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipping_limit_date,
       CAST(CASE WHEN l_orderkey % {FREE_ITEM[0]} = {FREE_ITEM[1]} THEN 0 ELSE l_extendedprice END AS {MONEY.upper()}) AS price,
       CAST(l_extendedprice AS {MONEY.upper()}) * CAST(l_tax AS {RATE.upper()}) AS freight_value
FROM lineitem JOIN (VALUES (FALSE), (TRUE)) AS t(again) ON NOT again OR l_orderkey % {REPEATED[0]} = {REPEATED[1]}
""")
def mk_items(spark, d):
    li = load(spark, d, "lineitem")
    price = F.when(_mod("l_orderkey", FREE_ITEM), 0).otherwise(F.col("l_extendedprice")).cast(MONEY)
    rows = li.select(F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("order_item_id"),
                     F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
                     _time_text("l_shipdate").alias("shipping_limit_date"), price.alias("price"),
                     (F.col("l_extendedprice").cast(MONEY) * F.col("l_tax").cast(RATE)).alias("freight_value"))
    return _twice(rows, "order_id")


@view("mk_payments", f"""
SELECT o_orderkey AS order_id, CAST(IF(kind = 1, 2, 1) AS INTEGER) AS payment_sequential,
       CAST(CASE WHEN o_orderkey % {NEGATIVE_PAYMENT[0]} = {NEGATIVE_PAYMENT[1]} THEN -1 ELSE o_totalprice END AS {MONEY.upper()})
         AS payment_value
FROM orders JOIN (VALUES (0), (1), (2)) AS t(kind)
  ON kind = 0 OR (kind = 1 AND o_orderkey % {SECOND_PAYMENT[0]} = {SECOND_PAYMENT[1]})
     OR (kind = 2 AND o_orderkey % {REPEATED[0]} = {REPEATED[1]})
""")
def mk_payments(spark, d):
    """Instalments by number; two equal ones of an order are no repeated row."""
    o = load(spark, d, "orders")
    value = F.when(_mod("o_orderkey", NEGATIVE_PAYMENT), -1).otherwise(F.col("o_totalprice")).cast(MONEY)
    first = o.select(F.col("o_orderkey").alias("order_id"), F.lit(1).alias("payment_sequential"), value.alias("payment_value"))
    second = first.filter(_mod("order_id", SECOND_PAYMENT)).withColumn("payment_sequential", F.lit(2))
    return _twice(first, "order_id").unionByName(second)


@view("mk_translation", f"""
SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english
FROM part WHERE p_type <> '{UNTRANSLATED_CATEGORY}'
""")
def mk_translation(spark, d):
    p = load(spark, d, "part")
    return (p.filter(F.col("p_type") != UNTRANSLATED_CATEGORY)
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english")).distinct())


@view("mk_products", f"""
SELECT p_partkey AS product_id, IF(again, 'ZZ', p_type) AS product_category_name,
       CASE WHEN p_partkey % {WEIGHT_NULL} = 0 THEN NULL ELSE p_size * 10 END AS product_weight_g,
       p_size AS product_length_cm,
       CASE WHEN p_partkey % {WEIGHT_NULL} = 1 THEN NULL ELSE p_size % 7 + 1 END AS product_height_cm,
       p_size % 5 + 2 AS product_width_cm
FROM part JOIN (VALUES (FALSE), (TRUE)) AS t(again) ON NOT again OR p_partkey % {REPEATED[0]} = {REPEATED[1]}
""")
def mk_products(spark, d):
    p = load(spark, d, "part")
    rows = p.select(
        F.col("p_partkey").alias("product_id"), F.col("p_type").alias("product_category_name"),
        F.when(F.col("p_partkey") % WEIGHT_NULL == 0, F.lit(None).cast("int")).otherwise(F.col("p_size") * 10)
        .alias("product_weight_g"),
        F.col("p_size").alias("product_length_cm"),
        F.when(F.col("p_partkey") % WEIGHT_NULL == 1, F.lit(None).cast("int")).otherwise(F.col("p_size") % 7 + 1)
        .alias("product_height_cm"),
        (F.col("p_size") % 5 + 2).alias("product_width_cm"))
    return _twice(rows, "product_id", product_category_name=F.lit("ZZ"))


@view("mk_geolocation", f"""
SELECT {_ZIP_SQL.format(k=f'(c_custkey % {ZIP_PLACES})')} AS geolocation_zip_code_prefix,
       CAST(c_acctbal AS DECIMAL(18,2)) * 0.01 AS geolocation_lat, CAST(c_nationkey AS DECIMAL(18,2)) AS geolocation_lng
FROM customer
""")
def mk_geolocation(spark, d):
    c = load(spark, d, "customer")
    return c.select(((F.col("c_custkey") % ZIP_PLACES) * 7919 % 100000).alias("geolocation_zip_code_prefix"),
                    (F.col("c_acctbal").cast(MONEY) * F.lit(Decimal("0.01"))).alias("geolocation_lat"),
                    F.col("c_nationkey").cast(MONEY).alias("geolocation_lng"))


# --------------------------------------------------------------------------------------
# Task-6 order lines: line facts with product attributes

@view("task_lines", f"""
SELECT CAST(l_partkey AS VARCHAR) AS product_id, p_name AS old_name, p_type AS category,
       CAST(p_retailprice AS DECIMAL(10,2)) AS price, CAST(l_extendedprice AS {MONEY.upper()}) AS base_price,
       CASE l_returnflag WHEN 'N' THEN 'Completed' WHEN 'A' THEN 'Pending' ELSE 'Cancelled' END AS status,
       CAST(l_extendedprice AS {MONEY.upper()}) AS amount,
       CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE 'U' || CAST(l_suppkey AS VARCHAR) END AS user_id,
       CASE l_orderkey % 4 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East' ELSE 'West' END AS region,
       CASE WHEN l_discount >= 0.08 THEN 'High' WHEN l_discount >= 0.04 THEN 'Medium' ELSE 'Low' END AS priority
FROM lineitem JOIN part ON p_partkey = l_partkey
""")
def task_lines(spark, d):
    li = load(spark, d, "lineitem")
    p = load(spark, d, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")
    region = (F.when(F.col("l_orderkey") % 4 == 0, "North").when(F.col("l_orderkey") % 4 == 1, "South")
              .when(F.col("l_orderkey") % 4 == 2, "East").otherwise("West"))
    return li.join(p, li.l_partkey == p.p_partkey).select(
        F.col("l_partkey").cast("string").alias("product_id"), F.col("p_name").alias("old_name"),
        F.col("p_type").alias("category"), F.col("p_retailprice").cast("decimal(10,2)").alias("price"),
        F.col("l_extendedprice").cast(MONEY).alias("base_price"),
        F.when(F.col("l_returnflag") == "N", "Completed").when(F.col("l_returnflag") == "A", "Pending")
        .otherwise("Cancelled").alias("status"),
        F.col("l_extendedprice").cast(MONEY).alias("amount"),
        F.when(F.col("l_orderkey") % 5 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("U"), F.col("l_suppkey").cast("string"))).alias("user_id"),
        region.alias("region"),
        F.when(F.col("l_discount") >= 0.08, "High").when(F.col("l_discount") >= 0.04, "Medium").otherwise("Low")
        .alias("priority"))


# --------------------------------------------------------------------------------------
# Raw Shop B inputs with deterministic defects (what the cleaning jobs repair)

# defect rules: blank / missing / padded customer ids, DD-MM-YYYY and date-only
# texts, unparsable dates, unknown status, messy names, zero quantities,
# out-of-range discounts, orphan order lines
TITLE_SQL = "array_to_string(list_transform(regexp_extract_all(lower(trim({x})), '(\\p{{L}}+|[^\\p{{L}}]+)'), lambda w: upper(w[1]) || w[2:]), '')"


def _copies(where):
    """An extract that repeats whole rows: one copy of a row, or two."""
    return F.explode(F.when(where, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")


@view("raw_orders", f"""
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 20 = 7 THEN '' WHEN o_orderkey % 20 = 13 THEN NULL
            WHEN o_orderkey % 20 = 17 THEN ' ' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
       CASE WHEN o_orderkey % 10 = 3 THEN strftime(o_orderdate, '%d-%m-%Y')
            WHEN o_orderkey % 50 = 9 THEN 'unknown'
            WHEN o_orderkey % 10 = 5 THEN strftime(o_orderdate, '%Y-%m-%d')
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date,
       CASE WHEN o_orderkey % 97 = 5 THEN 'UNKNOWN' ELSE {_STATUS_B} END AS status
FROM orders, unnest(CASE WHEN o_orderkey % 401 = 2 THEN [1, 2] ELSE [1] END)
""")
def raw_orders(spark, d):
    o = load(spark, d, "orders")
    k, cust = F.col("o_orderkey"), F.col("o_custkey").cast("string")
    status = (F.when(k % 97 == 5, "UNKNOWN").when(F.col("o_orderstatus") == "F", "DELIVERED")
              .when(F.col("o_orderstatus") == "O", "SHIPPED").otherwise("PLACED"))
    return o.select(
        k.alias("order_id"),
        F.when(k % 20 == 7, F.lit("")).when(k % 20 == 13, F.lit(None).cast("string"))
        .when(k % 20 == 17, F.concat(F.lit(" "), cust)).otherwise(cust).alias("customer_id"),
        F.when(k % 10 == 3, F.date_format("o_orderdate", "dd-MM-yyyy")).when(k % 50 == 9, F.lit("unknown"))
        .when(k % 10 == 5, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("order_date"),
        status.alias("status"), _copies(k % 401 == 2)).drop("_copy")


@view("raw_products", f"""
SELECT p_partkey AS product_id,
       CASE p_partkey % 4 WHEN 1 THEN '  ' || upper(p_name) || ' ' WHEN 2 THEN replace(p_name, ' ', '   ')
            WHEN 3 THEN p_name ELSE {TITLE_SQL.format(x='p_name')} END AS product_name,
       p_type AS category, p_brand AS subcategory, CAST(p_retailprice AS {MONEY.upper()}) AS cost_price
FROM part, unnest(CASE WHEN p_partkey % 173 = 9 THEN [1, 2] ELSE [1] END)
""")
def raw_products(spark, d):
    from tillbook.functions.text import title_case
    p = load(spark, d, "part")
    k = F.col("p_partkey") % 4
    name = (F.when(k == 1, F.concat(F.lit("  "), F.upper("p_name"), F.lit(" ")))
            .when(k == 2, F.replace(F.col("p_name"), F.lit(" "), F.lit("   ")))
            .when(k == 3, F.col("p_name")).otherwise(title_case("p_name")))
    return p.select(F.col("p_partkey").alias("product_id"), name.alias("product_name"), F.col("p_type").alias("category"),
                    F.col("p_brand").alias("subcategory"), F.col("p_retailprice").cast(MONEY).alias("cost_price"),
                    _copies(F.col("p_partkey") % 173 == 9)).drop("_copy")


@view("raw_items", f"""
SELECT l_orderkey * 100 + l_linenumber AS item_id,
       CASE WHEN l_orderkey % 997 = 1 THEN -l_orderkey - 1 ELSE l_orderkey END AS order_id,
       l_partkey AS product_id,
       CAST(CASE WHEN (l_orderkey + l_linenumber) % 101 = 0 THEN 0 WHEN l_returnflag = 'R' THEN -l_quantity
                 ELSE l_quantity END AS INTEGER) AS quantity,
       CAST(l_extendedprice AS {MONEY.upper()}) AS line_amount,
       CASE WHEN (l_orderkey + l_linenumber) % 53 = 0 THEN CAST(150 AS DECIMAL(8,2))
            WHEN (l_orderkey + l_linenumber) % 59 = 0 THEN CAST(-5 AS DECIMAL(8,2))
            ELSE CAST(CAST(l_discount AS {RATE.upper()}) * 100 AS DECIMAL(8,2)) END AS discount_percent
FROM lineitem, unnest(CASE WHEN l_orderkey % 307 = 4 THEN [1, 2] ELSE [1] END)
""")
def raw_items(spark, d):
    li = load(spark, d, "lineitem")
    k = F.col("l_orderkey")
    s = k + F.col("l_linenumber")
    qty = (F.when(s % 101 == 0, F.lit(0)).when(F.col("l_returnflag") == "R", -F.col("l_quantity"))
           .otherwise(F.col("l_quantity"))).cast("int")
    disc = (F.when(s % 53 == 0, F.lit(150).cast("decimal(8,2)")).when(s % 59 == 0, F.lit(-5).cast("decimal(8,2)"))
            .otherwise((F.col("l_discount").cast(RATE) * 100).cast("decimal(8,2)")))
    return li.select((k * 100 + F.col("l_linenumber")).alias("item_id"),
                     F.when(k % 997 == 1, -k - 1).otherwise(k).alias("order_id"),
                     F.col("l_partkey").alias("product_id"), qty.alias("quantity"),
                     F.col("l_extendedprice").cast(MONEY).alias("line_amount"), disc.alias("discount_percent"),
                     _copies(k % 307 == 4)).drop("_copy")


@view("listing", """
SELECT p_name AS title, CAST(p_size % 50 AS DOUBLE) / 10 AS rating,
       CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 'Rs.' || CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR)
            ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS VARCHAR) END AS final_price,
       CASE WHEN p_partkey % 3 = 0 THEN '₹' || CAST(CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 1.25 AS DECIMAL(10,2)) AS VARCHAR)
            ELSE CAST(CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 1.25 AS DECIMAL(10,2)) AS VARCHAR) END AS initial_price,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size % 30 AS DOUBLE) END AS discount,
       p_size * 13 AS ratings_count,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS seller_name
FROM part
""")
def listing(spark, d):
    """Product listing as scraped: prices as text (some with a currency prefix), gaps."""
    p = load(spark, d, "part")
    k = F.col("p_partkey")
    fp = F.col("p_retailprice").cast("decimal(10,2)").cast("string")
    ip = (F.col("p_retailprice").cast("decimal(10,2)") * F.lit(Decimal("1.25"))).cast("decimal(10,2)").cast("string")
    return p.select(
        F.col("p_name").alias("title"), ((F.col("p_size") % 50).cast("double") / 10).alias("rating"),
        F.when(k % 7 == 0, F.lit(None).cast("string")).when(k % 5 == 0, F.concat(F.lit("Rs."), fp)).otherwise(fp)
        .alias("final_price"),
        F.when(k % 3 == 0, F.concat(F.lit("\u20b9"), ip)).otherwise(ip).alias("initial_price"),
        F.when(k % 9 == 0, F.lit(None).cast("double")).otherwise((F.col("p_size") % 30).cast("double")).alias("discount"),
        (F.col("p_size") * 13).alias("ratings_count"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("seller_name"))


@view("mk_reviews", """
SELECT event_id AS review_id, user_id AS order_id,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS review_comment_title,
       CASE WHEN event_id % 4 = 0 THEN NULL ELSE props END AS review_comment_message,
       CAST(ts AS VARCHAR) AS review_creation_date
FROM events
""")
def mk_reviews(spark, d):
    """Reviews as raw text rows (the creation time arrives as text)."""
    e = load(spark, d, "events")
    return e.select(F.col("event_id").alias("review_id"), F.col("user_id").alias("order_id"),
                    F.when(F.col("event_id") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type"))
                    .alias("review_comment_title"),
                    F.when(F.col("event_id") % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("props"))
                    .alias("review_comment_message"),
                    F.col("ts").cast("string").alias("review_creation_date"))
