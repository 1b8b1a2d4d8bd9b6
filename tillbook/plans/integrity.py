"""Constraint checks, accept/reject split, the order-batch stock update, and
the SCD type 1 upsert with its validation (Shop A / order tables)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.operators.quality import (Check, Default, ForeignKey, NotNull, TableRules, Unique,
                                        constraint_violations, row_metrics, split_valid)
from tillbook.operators.references import missing_references
from tillbook.operators.scd import drop_null_keys, merge_validation, scd1_merge
from tillbook.plans.model import oracle, raw_items, shopa_customers, shopa_items, shopa_orders, shopa_products
from tillbook.plans.registry import register

# The constrained shop schema (keys, checks, references, defaults).
SHOP_A_RULES = [
    TableRules("customers", [NotNull("customer_id"), NotNull("first_name"), NotNull("last_name"), NotNull("email"),
                             NotNull("city"), NotNull("state"), NotNull("join_date"), Unique(("customer_id",), False),
                             Unique(("email",)), Default("is_premium", False, "boolean")]),
    TableRules("products", [NotNull("product_id"), NotNull("product_name"), NotNull("category"), NotNull("brand"),
                            NotNull("unit_price"), Unique(("product_id",), False),
                            Check("chk_unit_price_positive", "unit_price > 0"),
                            Check("chk_stock_non_negative", "stock_qty >= 0"), Default("stock_qty", 0, "int")]),
    TableRules("orders", [NotNull("order_id"), NotNull("customer_id"), NotNull("order_date"), NotNull("status"),
                          NotNull("total_amount"), Unique(("order_id",), False),
                          Check("chk_status_known", "status IN ('Pending','Shipped','Delivered','Cancelled')"),
                          Check("chk_total_non_negative", "total_amount >= 0"),
                          ForeignKey(("customer_id",), "customers", ("customer_id",)),
                          Default("status", "Pending", "string")]),
    TableRules("order_items", [NotNull("item_id"), NotNull("order_id"), NotNull("product_id"), NotNull("quantity"),
                               Unique(("item_id",), False), Check("chk_quantity_positive", "quantity > 0"),
                               Check("chk_discount_range", "discount_pct BETWEEN 0 AND 100"),
                               ForeignKey(("order_id",), "orders", ("order_id",)),
                               ForeignKey(("product_id",), "products", ("product_id",)),
                               Default("discount_pct", 0, "decimal(5,2)")]),
]

_SQL_CONSTRAINTS = """
SELECT 'customers' AS table_name, 'not_null_customer_id' AS constraint_name, 'NOT NULL' AS kind, COUNT(*) FILTER (WHERE customer_id IS NULL) AS violations FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_first_name', 'NOT NULL', COUNT(*) FILTER (WHERE first_name IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_last_name', 'NOT NULL', COUNT(*) FILTER (WHERE last_name IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_email', 'NOT NULL', COUNT(*) FILTER (WHERE email IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_city', 'NOT NULL', COUNT(*) FILTER (WHERE city IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_state', 'NOT NULL', COUNT(*) FILTER (WHERE state IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'not_null_join_date', 'NOT NULL', COUNT(*) FILTER (WHERE join_date IS NULL) FROM shopa_customers
UNION ALL SELECT 'customers', 'unique_customer_id', 'UNIQUE', COALESCE(SUM(n), 0) FROM (SELECT customer_id, COUNT(*) n FROM shopa_customers GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'customers', 'unique_email', 'UNIQUE', COALESCE(SUM(n), 0) FROM (SELECT email, COUNT(*) n FROM shopa_customers WHERE email IS NOT NULL GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'products', 'not_null_product_id', 'NOT NULL', COUNT(*) FILTER (WHERE product_id IS NULL) FROM shopa_products
UNION ALL SELECT 'products', 'not_null_product_name', 'NOT NULL', COUNT(*) FILTER (WHERE product_name IS NULL) FROM shopa_products
UNION ALL SELECT 'products', 'not_null_category', 'NOT NULL', COUNT(*) FILTER (WHERE category IS NULL) FROM shopa_products
UNION ALL SELECT 'products', 'not_null_brand', 'NOT NULL', COUNT(*) FILTER (WHERE brand IS NULL) FROM shopa_products
UNION ALL SELECT 'products', 'not_null_unit_price', 'NOT NULL', COUNT(*) FILTER (WHERE unit_price IS NULL) FROM shopa_products
UNION ALL SELECT 'products', 'chk_unit_price_positive', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(unit_price > 0, TRUE)) FROM shopa_products
UNION ALL SELECT 'products', 'chk_stock_non_negative', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(stock_qty >= 0, TRUE)) FROM shopa_products
UNION ALL SELECT 'products', 'unique_product_id', 'UNIQUE', COALESCE(SUM(n), 0) FROM (SELECT product_id, COUNT(*) n FROM shopa_products GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'orders', 'not_null_order_id', 'NOT NULL', COUNT(*) FILTER (WHERE order_id IS NULL) FROM shopa_orders
UNION ALL SELECT 'orders', 'not_null_customer_id', 'NOT NULL', COUNT(*) FILTER (WHERE customer_id IS NULL) FROM shopa_orders
UNION ALL SELECT 'orders', 'not_null_order_date', 'NOT NULL', COUNT(*) FILTER (WHERE order_date IS NULL) FROM shopa_orders
UNION ALL SELECT 'orders', 'not_null_status', 'NOT NULL', COUNT(*) FILTER (WHERE status IS NULL) FROM shopa_orders
UNION ALL SELECT 'orders', 'not_null_total_amount', 'NOT NULL', COUNT(*) FILTER (WHERE total_amount IS NULL) FROM shopa_orders
UNION ALL SELECT 'orders', 'chk_status_known', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(status IN ('Pending','Shipped','Delivered','Cancelled'), TRUE)) FROM shopa_orders
UNION ALL SELECT 'orders', 'chk_total_non_negative', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(total_amount >= 0, TRUE)) FROM shopa_orders
UNION ALL SELECT 'orders', 'unique_order_id', 'UNIQUE', COALESCE(SUM(n), 0) FROM (SELECT order_id, COUNT(*) n FROM shopa_orders GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'orders', 'fk_customer_id_customers', 'FOREIGN KEY', COUNT(*) FROM shopa_orders o WHERE customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM shopa_customers c WHERE c.customer_id = o.customer_id)
UNION ALL SELECT 'order_items', 'not_null_item_id', 'NOT NULL', COUNT(*) FILTER (WHERE item_id IS NULL) FROM shopa_items
UNION ALL SELECT 'order_items', 'not_null_order_id', 'NOT NULL', COUNT(*) FILTER (WHERE order_id IS NULL) FROM shopa_items
UNION ALL SELECT 'order_items', 'not_null_product_id', 'NOT NULL', COUNT(*) FILTER (WHERE product_id IS NULL) FROM shopa_items
UNION ALL SELECT 'order_items', 'not_null_quantity', 'NOT NULL', COUNT(*) FILTER (WHERE quantity IS NULL) FROM shopa_items
UNION ALL SELECT 'order_items', 'chk_quantity_positive', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(quantity > 0, TRUE)) FROM shopa_items
UNION ALL SELECT 'order_items', 'chk_discount_range', 'CHECK', COUNT(*) FILTER (WHERE NOT COALESCE(discount_pct BETWEEN 0 AND 100, TRUE)) FROM shopa_items
UNION ALL SELECT 'order_items', 'unique_item_id', 'UNIQUE', COALESCE(SUM(n), 0) FROM (SELECT item_id, COUNT(*) n FROM shopa_items GROUP BY 1 HAVING COUNT(*) > 1)
UNION ALL SELECT 'order_items', 'fk_order_id_orders', 'FOREIGN KEY', COUNT(*) FROM shopa_items i WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM shopa_orders o WHERE o.order_id = i.order_id)
UNION ALL SELECT 'order_items', 'fk_product_id_products', 'FOREIGN KEY', COUNT(*) FROM shopa_items i WHERE product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM shopa_products p WHERE p.product_id = i.product_id)
"""


def shop_a_tables(spark, d):
    return {"customers": shopa_customers(spark, d), "products": shopa_products(spark, d),
            "orders": shopa_orders(spark, d), "order_items": shopa_items(spark, d)}


#: Defects of the landed tables, from keys by fixed rules: table -> (key, modulus, remainder, column, value as SQL or None)
LANDED_DEFECTS = {
    "customers": [("customer_id", 97, 5, "email", None), ("customer_id", 101, 7, "state", None)],
    "products": [("product_id", 83, 3, "unit_price", "-1"), ("product_id", 89, 4, "stock_qty", "-2"), ("product_id", 79, 6, "brand", None)],
    "orders": [("order_id", 113, 5, "status", "'Lost'"), ("order_id", 127, 3, "order_date", None), ("order_id", 131, 2, "total_amount", "-1")],
    "order_items": [("item_id", 61, 3, "quantity", "0"), ("item_id", 67, 5, "discount_pct", "150"), ("item_id", 71, 4, "order_id", None)],
}


def landed_tables(spark, d):
    """The shop tables as a faulty extract delivers them: whole, with defects for every kind of rule."""
    tables = shop_a_tables(spark, d)
    for t, defects in LANDED_DEFECTS.items():
        types = {f.name: f.dataType for f in tables[t].schema.fields}
        changed = {c: F.when(F.col(key) % m == r, F.expr(value or "NULL").cast(types[c])).otherwise(F.col(c)) for key, m, r, c, value in defects}
        tables[t] = tables[t].select(*(changed[c].alias(c) if c in changed else c for c in tables[t].columns))
    return tables


def _landed_sql() -> str:
    views = []
    for t, defects in LANDED_DEFECTS.items():
        source = "shopa_items" if t == "order_items" else f"shopa_{t}"
        cases = ", ".join(f"CASE WHEN {key} % {m} = {r} THEN {value or 'NULL'} ELSE {c} END AS {c}" for key, m, r, c, value in defects)
        views.append(f"landed_{source[6:]} AS (SELECT * REPLACE ({cases}) FROM {source})")
    return "WITH " + ", ".join(views)


@register("q_constraints", oracle(["shopa_customers", "shopa_products", "shopa_orders", "shopa_items"],
                                  f"{_landed_sql()} SELECT table_name, constraint_name, kind, CAST(violations AS BIGINT) AS violations "
                                  f"FROM ({_SQL_CONSTRAINTS.replace('shopa_', 'landed_')})"))
def constraints_q(spark, d):
    return constraint_violations(landed_tables(spark, d), SHOP_A_RULES)


_FK_SQL = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST({c} AS BIGINT) AS missing_key, COUNT(*) AS n_rows FROM landed_{v} "
    f"WHERE {c} NOT IN (SELECT {rc} FROM landed_{rt} WHERE {rc} IS NOT NULL) GROUP BY {c}"
    for t, v, c, rt, rc in (("orders", "orders", "customer_id", "customers", "customer_id"), ("order_items", "items", "order_id", "orders", "order_id"),
                            ("order_items", "items", "product_id", "products", "product_id")))


@register("q_missing_references", oracle(["shopa_customers", "shopa_products", "shopa_orders", "shopa_items"], f"{_landed_sql()} {_FK_SQL}"))
def missing_references_q(spark, d):
    """The references of each foreign key that have no row, with how often they occur."""
    tables, out = landed_tables(spark, d), None
    for tr in SHOP_A_RULES:
        for r in tr.rules:
            if isinstance(r, ForeignKey):
                found = (missing_references(tables[tr.table], r.columns[0], tables[r.ref_table], r.ref_columns[0])
                         .groupBy(F.col(r.columns[0]).cast("long").alias("missing_key")).agg(F.count(F.lit(1)).alias("n_rows"))
                         .select(F.lit(tr.table).alias("table_name"), F.lit(r.columns[0]).alias("column_name"), "missing_key", "n_rows"))
                out = found if out is None else out.unionAll(found)
    return out


def item_rules():
    return {"chk_quantity_positive": F.col("quantity") > 0,
            "chk_discount_range": F.col("discount_percent").between(0, 100)}


@register("q_split_valid", oracle(["raw_items"], """
WITH t AS (SELECT concat_ws(',', CASE WHEN NOT COALESCE(quantity > 0, TRUE) THEN 'chk_quantity_positive' END,
                             CASE WHEN NOT COALESCE(discount_percent BETWEEN 0 AND 100, TRUE) THEN 'chk_discount_range' END) AS reason
           FROM raw_items)
SELECT CASE WHEN reason = '' THEN 'accepted' ELSE 'rejected' END AS outcome, reason, COUNT(*) AS n_rows FROM t GROUP BY 1, 2"""))
def split_valid_q(spark, d):
    accepted, rejected = split_valid(raw_items(spark, d), item_rules())
    a = accepted.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("accepted").alias("outcome"), F.lit("").alias("reason"), "n_rows")
    r = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit("rejected").alias("outcome"), "reason", "n_rows")
    return a.filter(F.col("n_rows") > 0).unionByName(r)


BATCH_FROM, BATCH_TO = dt.date(1996, 8, 10), dt.date(1996, 8, 12)


def apply_order_batch(products, orders, items, batch_from=BATCH_FROM, batch_to=BATCH_TO):
    """Stock after an order batch: stock - ordered quantity per product, and
    whether the stock CHECK (>= 0) still holds. Validate first, publish after:
    the caller writes the new snapshot only when every row is valid."""
    batch = orders.filter(F.col("order_date").between(F.lit(batch_from), F.lit(batch_to))).select("order_id")
    ordered = items.join(batch, "order_id").groupBy("product_id").agg(F.sum("quantity").cast("long").alias("ordered_qty"))
    return (products.select("product_id", F.col("stock_qty").cast("long").alias("stock_before"))
            .join(ordered, "product_id")
            .withColumn("stock_after", F.col("stock_before") - F.col("ordered_qty"))
            .withColumn("is_valid", F.col("stock_after") >= 0))


@register("q_apply_order_batch", oracle(["shopa_products", "shopa_orders", "shopa_items"], f"""
WITH o AS (SELECT i.product_id, CAST(SUM(i.quantity) AS BIGINT) AS ordered_qty
           FROM shopa_items i JOIN shopa_orders b ON b.order_id = i.order_id
           WHERE b.order_date BETWEEN DATE '{BATCH_FROM}' AND DATE '{BATCH_TO}' GROUP BY 1)
SELECT p.product_id, CAST(p.stock_qty AS BIGINT) AS stock_before, o.ordered_qty,
       CAST(p.stock_qty AS BIGINT) - o.ordered_qty AS stock_after, CAST(p.stock_qty AS BIGINT) - o.ordered_qty >= 0 AS is_valid
FROM shopa_products p JOIN o ON o.product_id = p.product_id"""))
def apply_order_batch_q(spark, d):
    return apply_order_batch(shopa_products(spark, d), shopa_orders(spark, d), shopa_items(spark, d))


# ---------------------------------------------------------------- SCD1 upsert
UPDATE_COLS = ["status", "total_amount"]


def orders_target(spark, d):
    """Table before the increment: every order except the new tenth (key % 10 = 0)."""
    return shopa_orders(spark, d).filter(F.col("order_id") % 10 != 0)


def orders_increment(spark, d):
    """Increment: the new tenth plus corrections (key % 100 = 1: delivered, +5 %)."""
    o = shopa_orders(spark, d)
    new = o.filter(F.col("order_id") % 10 == 0)
    upd = (o.filter(F.col("order_id") % 100 == 1)
           .withColumn("status", F.lit("Delivered"))
           .withColumn("total_amount", (F.col("total_amount") * F.lit(Decimal("1.05"))).cast("decimal(12,2)")))
    return new.unionByName(upd)


_SQL_SCD1 = """
WITH t AS (SELECT * FROM shopa_orders WHERE order_id % 10 <> 0),
s AS (SELECT * FROM shopa_orders WHERE order_id % 10 = 0
      UNION ALL
      SELECT order_id, customer_id, order_date, 'Delivered' AS status, CAST(total_amount * 1.05 AS DECIMAL(12,2)) AS total_amount
      FROM shopa_orders WHERE order_id % 100 = 1),
m AS (SELECT COALESCE(t.order_id, s.order_id) AS order_id,
             CASE WHEN t.order_id IS NOT NULL THEN t.customer_id ELSE s.customer_id END AS customer_id,
             CASE WHEN t.order_id IS NOT NULL THEN t.order_date ELSE s.order_date END AS order_date,
             CASE WHEN s.order_id IS NOT NULL THEN s.status ELSE t.status END AS status,
             CASE WHEN s.order_id IS NOT NULL THEN s.total_amount ELSE t.total_amount END AS total_amount
      FROM t FULL OUTER JOIN s ON t.order_id = s.order_id)"""


@register("w7_scd1_merge", oracle(["shopa_orders"], _SQL_SCD1 + """
SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) AS total_amount FROM m"""))
def scd1_merge_q(spark, d):
    merged = scd1_merge(orders_target(spark, d), orders_increment(spark, d), "order_id", UPDATE_COLS)
    return merged.withColumn("total_amount", F.col("total_amount").cast("double"))


@register("w7_merge_validation", oracle(["shopa_orders"], _SQL_SCD1 + """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS distinct_keys,
       (SELECT COUNT(*) FROM (SELECT order_id FROM m GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys FROM m"""))
def merge_validation_q(spark, d):
    merged = scd1_merge(orders_target(spark, d), orders_increment(spark, d), "order_id", UPDATE_COLS, check_unique=False)
    return merge_validation(merged, "order_id")


@register("w7_append_validation", oracle(["shopa_orders"], """
WITH a AS (SELECT order_id FROM shopa_orders WHERE order_id % 10 <> 0
           UNION ALL SELECT order_id FROM shopa_orders WHERE order_id % 10 = 0
           UNION ALL SELECT order_id FROM shopa_orders WHERE order_id % 100 = 1)
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT order_id) AS distinct_keys,
       (SELECT COUNT(*) FROM (SELECT order_id FROM a GROUP BY 1 HAVING COUNT(*) > 1)) AS duplicate_keys FROM a"""))
def append_validation_q(spark, d):
    """What the validation says when an increment was appended instead of merged."""
    appended = orders_target(spark, d).select("order_id").unionAll(orders_increment(spark, d).select("order_id"))
    return merge_validation(appended, "order_id")


#: Columns without which an order cannot be merged.
MERGE_NEEDS = ["order_id", "customer_id", "order_date"]


@register("w7_upsert_landed", oracle(["shopa_customers", "shopa_products", "shopa_orders", "shopa_items"], f"""{_landed_sql()},
t AS (SELECT * FROM shopa_orders WHERE order_id % 10 <> 0),
s AS (SELECT * FROM landed_orders WHERE order_id % 10 < 2 AND {" AND ".join(f"{c} IS NOT NULL" for c in MERGE_NEEDS)})
SELECT t.order_id, t.customer_id, t.order_date, COALESCE(s.status, t.status) AS status,
       CAST(COALESCE(s.total_amount, t.total_amount) AS DOUBLE) AS total_amount FROM t LEFT JOIN s USING (order_id)
UNION ALL
SELECT order_id, customer_id, order_date, status, CAST(total_amount AS DOUBLE) FROM s WHERE order_id NOT IN (SELECT order_id FROM t)"""))
def upsert_landed_q(spark, d):
    """Rows of a landed extract that lack a needed column are dropped before the upsert."""
    landed = landed_tables(spark, d)["orders"].filter(F.col("order_id") % 10 < 2)
    merged = scd1_merge(orders_target(spark, d), drop_null_keys(landed, MERGE_NEEDS), "order_id", UPDATE_COLS)
    return merged.withColumn("total_amount", F.col("total_amount").cast("double"))


class Rejected(ValueError):
    """Rows that break a rule; nothing was published."""


def load_tables(store, tables: dict[str, DataFrame], registry: list[TableRules]) -> dict[str, int]:
    """All or nothing: the tables are written and checked against their rules,
    and become current together only if no row breaks one.

    Each table is computed once. Its NOT NULL and CHECK rules are counted by the
    write (observed metrics); UNIQUE and FOREIGN KEY then read only the key
    columns of what was written. A reference to a table that is not loaded now
    means the published one. What is rejected is deleted again.
    """
    rules = {tr.table: row_metrics(tr) for tr in registry if tr.table in tables}
    versions, counted = store.stage_many(tables, metrics=rules)
    written = {t: store.read(t, v) for t, v in versions.items()}
    loaded = [tr for tr in registry if tr.table in tables]
    for tr in loaded:
        for r in tr.rules:
            if isinstance(r, ForeignKey) and r.ref_table not in written:
                written[r.ref_table] = store.read(r.ref_table)
    by_key = {(r.table_name, r.constraint_name): r.violations
              for r in constraint_violations(written, loaded, row_rules=False).collect()}   # a row per rule
    broken = {(t, name): n for t, found in counted.items() for name, n in found.items() if name in rules.get(t, {})} | by_key
    broken = {rule: n for rule, n in broken.items() if n}
    if broken:
        store.abandon(versions)
        raise Rejected("; ".join(f"{t}.{name}: {n} rows" for (t, name), n in broken.items()))
    store.commit(versions)
    return versions


def publish_order_batch(store, products_table: str, orders, items, batch_from=BATCH_FROM, batch_to=BATCH_TO,
                        orders_table: str = "orders", items_table: str = "order_items") -> dict[str, int]:
    """One transaction: the batch's orders and items are appended and the stock
    is lowered, in three tables that become current together; or nothing is
    published, when any stock would go negative."""
    products = store.read(products_table)
    after = apply_order_batch(products, orders, items, batch_from, batch_to)
    bad = after.filter(~F.col("is_valid")).select("product_id", "stock_after").limit(1).collect()   # at most one row
    if bad:
        raise Rejected(f"order batch rejected: product {bad[0].product_id} would have stock {bad[0].stock_after}")
    updated = (products.join(after.select("product_id", "stock_after"), "product_id", "left")
               .withColumn("stock_qty", F.coalesce(F.col("stock_after"), F.col("stock_qty").cast("long"))
                           .cast(products.schema["stock_qty"].dataType))
               .select(*products.columns))
    new_orders = orders.filter(F.col("order_date").between(F.lit(batch_from), F.lit(batch_to)))
    new = {orders_table: new_orders, items_table: items.join(new_orders.select("order_id"), "order_id", "left_semi").select(*items.columns)}
    appended = {t: store.read(t).unionByName(df) if store.exists(t) else df for t, df in new.items()}
    return store.publish_many({products_table: updated, **appended})
