"""The marketplace lake kept up to date by what lands, instead of run anew.

``start`` publishes bronze and silver tables laid out by their keys, and next to
each gold table the partial sums that it follows from. ``land`` takes new rows:

* bronze: the buckets of the landed keys are written with them;
* silver: a table that is cleaned key by key is cleaned again for the landed
  keys only, from their buckets; others are cleaned whole if they got rows;
* gold: the orders that landed rows belong to are aggregated as they were and as
  they are, and the difference is added to the partial sums. Whole orders enter
  and leave, so the numbers of different orders add up too. Sums are built again
  only when a dimension that they group by got rows.

Every table is the same as after a run over all rows that ever landed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.functions import avg_exact
from tillbook.operators.changes import add_partials, row_changes
from tillbook.plans import medallion as M
from tillbook.plans.lake import LINEAGE, SILVER
from tillbook.plans.registry import register
from tillbook.sources.snapshots import SnapshotStore

#: raw table -> the key of its buckets
KEYS = {"customers": "customer_id", "sellers": "seller_id", "orders": "order_id", "order_items": "order_id",
        "order_payments": "order_id", "order_reviews": "review_id", "products": "product_id",
        "geolocation": "geolocation_zip_code_prefix", "product_category_name_translation": "product_category_name"}
#: silver tables whose rows depend on other keys' rows (medians, averages of padded codes)
WHOLE = ("products", "geolocation")
#: raw tables whose rows belong to an order
OF_ORDERS = ("orders", "order_items", "order_payments")


def _sum(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType
    total = F.sum(column)
    return total.cast(T.DecimalType(38, kind.scale)) if isinstance(kind, T.DecimalType) else total


def seller_partials(items: DataFrame) -> DataFrame:
    return items.groupBy("seller_id").agg(
        _sum(items, "price").alias("revenue"), F.count("order_item_id").alias("n_items"), _sum(items, "freight_value").alias("freight"),
        F.count("freight_value").alias("n_freight"), F.count(F.lit(1)).alias("n_rows"))


def category_partials(items: DataFrame, products: DataFrame) -> DataFrame:
    category = "product_category_name_english"
    sold = items.select("order_id", "product_id", "price").join(products.select("product_id", category), "product_id", "left")
    of_order = sold.groupBy("order_id", category).agg(_sum(sold, "price").alias("revenue"), F.count("price").alias("n_prices"),
                                                      F.count(F.lit(1)).alias("n_rows"))
    return of_order.groupBy(category).agg(_sum(of_order, "revenue").alias("revenue"), F.sum("n_prices").alias("n_prices"),
                                          F.count("order_id").alias("n_orders"), F.sum("n_rows").alias("n_rows"))


def state_partials(orders: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    paid = paid_orders(orders, payments).join(customers.select("customer_id", "customer_state"), "customer_id")
    return paid.groupBy("customer_state").agg(_sum(paid, "paid").alias("revenue"), F.count(F.lit(1)).alias("n_rows"))


def paid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    pay = payments.groupBy("order_id").agg(_sum(payments, "payment_value").alias("paid"))
    return orders.select("customer_id", "order_id", "order_purchase_timestamp").join(pay, "order_id").select(
        "customer_id", "order_id", "order_purchase_timestamp", "paid")


#: state -> (its groups, partial sums, what of orders they read, dimensions they group by)
STATES = {"sellers": (["seller_id"], seller_partials, ["order_items"], []),
          "categories": (["product_category_name_english"], category_partials, ["order_items"], ["products"]),
          "states": (["customer_state"], state_partials, ["orders", "order_payments"], ["customers"])}


def category_sales(state: DataFrame) -> DataFrame:
    return state.select("product_category_name_english", F.col("revenue").cast("double").alias("total_revenue"),
                        F.col("n_orders").alias("total_orders"), avg_exact(F.col("revenue"), F.col("n_prices")).alias("avg_price"))


def _gold(store: SnapshotStore) -> dict[str, DataFrame]:
    """The gold tables from the partial sums."""
    seller, category, state, paid = (store.read(f"state_{n}") for n in ("sellers", "categories", "states", "paid_orders"))
    last = paid.agg(F.max("order_purchase_timestamp")).scalar()
    return {
        "seller_performance": seller.join(store.read("silver_sellers").select("seller_id", "seller_state"), "seller_id").select(
            "seller_id", "seller_state", F.col("revenue").cast("double").alias("total_revenue"), F.col("n_items").alias("total_items_sold"),
            avg_exact(F.col("freight"), F.col("n_freight")).alias("avg_freight")),
        "sales_by_category": category_sales(category),
        "revenue_by_state": state.select("customer_state", F.col("revenue").cast("double").alias("total_revenue"),
                                         F.col("n_rows").alias("total_orders")),
        # an order later than all before makes every customer's recency another
        "customer_rfm": paid.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("frequency"), F.sum("paid").cast("double").alias("monetary"),
            F.max("order_purchase_timestamp").alias("last_order_date")).withColumn(
            "recency_days", F.datediff(F.to_date(last), F.to_date("last_order_date")).cast("long"))}


def _clean(store: SnapshotStore, name: str) -> DataFrame:
    clean, inputs = SILVER[name]
    return clean(*(store.read(f"bronze_{t}").drop(*LINEAGE) for t in inputs))


def _state(store: SnapshotStore, name: str) -> DataFrame:
    _, partials, facts, dims = STATES[name]
    return partials(*(store.read(f"silver_{t}") for t in facts + dims))


def start(spark: SparkSession, tables: dict[str, DataFrame], root: str, batch_ts, buckets: int = 64) -> dict[str, int]:
    """Publish every layer of the raw ``tables`` (all of ``KEYS``) under ``root``; returns the versions."""
    store, versions = SnapshotStore(spark, root), {}
    for name, key in KEYS.items():
        versions[f"bronze_{name}"] = store.publish_keyed(
            f"bronze_{name}", M.bronze(tables[name], ingested_at=batch_ts, source_file=name), key, buckets)
    for name in SILVER:
        versions[f"silver_{name}"] = store.publish_keyed(f"silver_{name}", _clean(store, name), KEYS[name], buckets)
    for name in STATES:
        versions[f"state_{name}"] = store.publish(f"state_{name}", _state(store, name))
    versions["state_paid_orders"] = store.publish_keyed(
        "state_paid_orders", paid_orders(store.read("silver_orders"), store.read("silver_order_payments")), "customer_id", buckets)
    return versions | {f"gold_{n}": store.publish(f"gold_{n}", df) for n, df in _gold(store).items()}


def _only(df: DataFrame, keys: DataFrame, key: str, how: str = "left_semi") -> DataFrame:
    """The rows of ``df`` with one of the ``keys`` (NULL is one too), or with none (``left_anti``)."""
    wanted = keys.select(F.col(key).alias("_wanted"))
    return df.join(wanted, F.col(key).eqNullSafe(F.col("_wanted")), how)


def land(spark: SparkSession, landed: dict[str, DataFrame], root: str, batch_ts) -> dict[str, int]:
    """Take in new raw rows of some tables; returns the versions that are new.
    Rows of known keys are further rows of these, as if all had landed at once."""
    store, versions = SnapshotStore(spark, root), {}
    before = store.current_versions()
    for name, rows in landed.items():
        table = f"bronze_{name}"
        versions[table] = store.merge_keyed(table, M.bronze(rows, ingested_at=batch_ts, source_file=name), KEYS[name],
                                            lambda old, new: old.unionByName(new))
    for name, (clean, inputs) in SILVER.items():
        table, key = f"silver_{name}", KEYS[name]
        if name in WHOLE and any(t in landed for t in inputs):
            versions[table] = store.publish_keyed(table, _clean(store, name), key, store.bucket_count(table))
        elif name not in WHOLE and name in landed:
            keys = landed[name].select(key).distinct()
            raw = _only(store.read_buckets(f"bronze_{name}", keys, key).drop(*LINEAGE), keys, key)
            versions[table] = store.merge_keyed(table, keys, key, lambda old, keys, key=key, raw=raw, clean=clean:
                                                _only(old, keys, key, "left_anti").unionByName(clean(raw)))
    of_orders = [landed[t].select("order_id") for t in OF_ORDERS if t in landed]
    if of_orders:
        orders = reduce(DataFrame.unionAll, of_orders).distinct()
        then, now = ({t: _only(store.read_buckets(f"silver_{t}", orders, "order_id", before[f"silver_{t}"] if old else None), orders, "order_id")
                      for t in OF_ORDERS} for old in (True, False))
        was, became = (paid_orders(x["orders"], x["order_payments"]) for x in (then, now))
        versions["state_paid_orders"] = store.merge_keyed(
            "state_paid_orders", was.unionAll(became), "customer_id",
            lambda old, _: _only(old, orders, "order_id", "left_anti").unionByName(became))
    for name, (groups, partials, facts, dims) in STATES.items():
        table = f"state_{name}"
        if any(f"silver_{t}" in versions for t in dims):
            versions[table] = store.publish(table, _state(store, name))
        elif of_orders and any(t in landed for t in facts):
            more = [store.read(f"silver_{t}") for t in dims]
            versions[table] = store.publish(table, add_partials(
                store.read(table), *(partials(*(x[t] for t in facts), *more) for x in (then, now)), groups))
    return versions | {f"gold_{n}": store.publish(f"gold_{n}", df) for n, df in _gold(store).items()}


# ------------------------------------------------------------------------- queries
def _changes_sql(before: str, after: str, columns: str) -> str:
    return f"""
WITH both_states AS (SELECT {columns}, -1 AS one FROM ({before}) UNION ALL SELECT {columns}, 1 FROM ({after}))
SELECT {columns}, CAST(SUM(one) AS BIGINT) AS change FROM both_states GROUP BY ALL HAVING SUM(one) <> 0"""


@register("m_customer_changes", M._m([], _changes_sql(
    "SELECT * FROM s_customers WHERE customer_id % 10 <> 0",
    "SELECT * REPLACE (IF(customer_id % 10 = 1, customer_city || ' (moved)', customer_city) AS customer_city) FROM s_customers",
    "customer_id, customer_zip_code_prefix, customer_city, customer_state")))
def customer_changes_q(spark, d):
    """What the second customer extract changes against the first load."""
    return row_changes(M.customers_v1(spark, d), M.customers_batch(spark, d))


_ITEMS_SQL = "* REPLACE (CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value) FROM mk_items"


@register("m_item_changes", M._m([], _changes_sql(
    f"SELECT {_ITEMS_SQL}", f"SELECT DISTINCT {_ITEMS_SQL} WHERE price > 0",
    "order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value")))
def item_changes_q(spark, d):
    """The rows, with their copies, that cleaning takes from the order lines."""
    raw = M.mk_items(spark, d)
    changed = row_changes(raw, raw.dropDuplicates().where("price > 0"))
    return changed.withColumns({c: F.col(c).cast("double") for c in ("price", "freight_value")})


@register("m_category_increment", M._m([], """
SELECT p.product_category_name_english, CAST(SUM(i.price) AS DOUBLE) AS total_revenue, COUNT(DISTINCT i.order_id) AS total_orders,
       CAST(SUM(i.price) AS DOUBLE) / COUNT(i.price) AS avg_price
FROM s_items i LEFT JOIN s_products p USING (product_id) GROUP BY 1"""))
def category_increment_q(spark, d):
    """Category sales from the partial sums of the lines without some orders, and
    with the first line only of others, to which these orders' lines are added."""
    items, products = M.silver_items(spark, d), M.silver_categories(spark, d)
    new, partial = F.col("order_id") % 10 == 3, F.col("order_id") % 10 == 4
    known = items.where(~new & ~(partial & (F.col("order_item_id") > 1)))
    state = category_partials(known, products)
    total = add_partials(state, category_partials(known.where(partial), products), category_partials(items.where(new | partial), products),
                         STATES["categories"][0])
    return category_sales(total)
