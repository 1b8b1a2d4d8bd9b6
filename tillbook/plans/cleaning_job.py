"""The jobs that write what cleaning and normalising give: cleaned CSV files with
the text report, the product listing, and the normalised tables by name.

What the queries return is read back from what was written.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillbook.functions import email_is_valid
from tillbook.plans import cleaning as C
from tillbook.plans import superstore as S
from tillbook.plans.model import listing, oracle, raw_items, raw_orders, raw_products, shop_customers
from tillbook.plans.registry import QUERIES, register
from tillbook.session import ensure_checkpoint_dir
from tillbook.sources.files import read_csv, write_csv
from tillbook.sources.snapshots import SnapshotStore

# Fixed texts of the report, in the order of its lines; the count stands before each.
REPORT_TITLE = "=== DATA CLEANING REPORT ==="
REPORT_LINES = (
    ("orders", "missing_customer_id", "rows had missing customer_id -> set to NULL (kept as NaN)"),
    ("orders", "unparseable_order_date", "rows had unparseable order_date -> set to NULL"),
    ("orders", "dd_mm_yyyy_dates", "rows had DD-MM-YYYY date format -> normalized to YYYY-MM-DD HH:MM:SS"),
    ("orders", "future_order_date", "rows have order_date in the future (flagged, not removed)"),
    ("orders", "invalid_status", "rows had invalid status values"),
    ("products", "messy_product_name", "rows had messy product_name (extra spaces/mixed case) -> normalized"),
    ("order_items", "negative_quantity", "rows have negative quantity (treated as returns, kept)"),
    ("order_items", "zero_quantity", "rows have quantity = 0 (flagged as invalid)"),
    ("order_items", "discount_out_of_range", "rows have discount_percent outside 0-100 (flagged)"),
    ("customers", "invalid_email", "customer_ids have invalid emails"),
    ("order_items", "orphan_items", "items reference non-existent order_id"),
    ("customers", "duplicate_rows", "duplicate rows found -> removed"),
    ("products", "duplicate_rows", "duplicate rows found -> removed"),
    ("orders", "duplicate_rows", "duplicate rows found -> removed"),
    ("order_items", "duplicate_rows", "duplicate rows found -> removed"),
)
NO_ORPHANS = "[order_items] No orphan order_items found (referential integrity OK)"
SHOWN_IDS = 10


def _first_ids(ids: DataFrame, table: str, check: str) -> DataFrame:
    """The smallest ids as the report shows them."""
    few = ids.select(F.col(ids.columns[0]).alias("id")).orderBy("id").limit(SHOWN_IDS + 1)
    held = few.agg(F.array_sort(F.collect_list("id")).alias("ids"))
    text = F.concat(F.lit(": ["), F.array_join(F.slice("ids", 1, SHOWN_IDS).cast("array<string>"), ", "), F.lit("]"),
                    F.when(F.size("ids") > SHOWN_IDS, "...").otherwise(""))
    return held.select(F.lit(table).alias("of_table"), F.lit(check).alias("of_check"), text.alias("shown"))


def report_lines(report: DataFrame, invalid_email_ids: DataFrame, orphan_ids: DataFrame) -> DataFrame:
    """``(line, value)``: the quality report (see ``quality_report``) as the lines of
    its text. Two lines show the first ids, of the one column that each frame has."""
    texts = report.sparkSession.createDataFrame([(n, *x) for n, x in enumerate(REPORT_LINES, 1)],
                                                "line int, table_name string, check_name string, message string")
    shown = _first_ids(invalid_email_ids, "customers", "invalid_email").unionAll(_first_ids(orphan_ids, "order_items", "orphan_items"))
    found = (report.join(texts, ["table_name", "check_name"])
             .join(shown, (F.col("table_name") == F.col("of_table")) & (F.col("check_name") == F.col("of_check")), "left"))
    value = F.concat(F.lit("["), "table_name", F.lit("] "), F.col("n_rows").cast("string"), F.lit(" "), "message", F.coalesce("shown", F.lit("")))
    value = F.when((F.col("check_name") == "orphan_items") & (F.col("n_rows") == 0), NO_ORPHANS).otherwise(value)
    title = report.sparkSession.createDataFrame([(0, REPORT_TITLE)], "line int, value string")
    return title.unionAll(found.select("line", value.alias("value")))


def _report(customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, as_of) -> DataFrame:
    return report_lines(C.quality_report(customers, products, orders, items, as_of),
                        customers.where(~email_is_valid("email")).select("customer_id"),
                        C.orphan_items(items, orders).select("item_id"))


def run_cleaning(customers: DataFrame, products: DataFrame, orders: DataFrame, items: DataFrame, folder: str, as_of=C.AS_OF) -> None:
    """Write ``<table>_clean`` as CSV folders and the report as a text file under
    ``folder``. Lines of unknown orders and repeated rows are left out."""
    clean = {"customers": customers, "products": C.clean_products(products).select(*products.columns),
             "orders": C.clean_orders(orders, as_of).select(*orders.columns),
             "order_items": C.clean_items(items, orders).select(*items.columns)}
    for name, df in clean.items():
        write_csv(df.dropDuplicates(), f"{folder}/{name}_clean")
    lines = _report(customers, products, orders, items, as_of)
    # at most a title and one line per check
    lines.orderBy("line").select("value").coalesce(1).write.mode("overwrite").text(f"{folder}/data_quality_report")


def _sql_report() -> str:
    messages = ", ".join(f"({n}, '{t}', '{c}', '{m}')" for n, (t, c, m) in enumerate(REPORT_LINES, 1))

    def ids(column: str, source: str) -> str:
        return (f"(SELECT ': [' || COALESCE(string_agg({column}::VARCHAR, ', ' ORDER BY {column}) FILTER (WHERE n <= {SHOWN_IDS}), '') || ']' || "
                f"IF(COUNT(*) > {SHOWN_IDS}, '...', '') FROM (SELECT {column}, row_number() OVER (ORDER BY {column}) AS n FROM {source}))")
    emails = ids("customer_id", f"shop_customers WHERE NOT COALESCE(regexp_matches(email, '{C.EMAIL_PATTERN}'), FALSE)")
    orphans = ids("item_id", "raw_items WHERE order_id IS NULL OR order_id NOT IN (SELECT order_id FROM raw_orders WHERE order_id IS NOT NULL)")
    return f"""
WITH report AS ({C._sql_quality()}), texts(line, table_name, check_name, message) AS (VALUES {messages})
SELECT 0 AS line, '{REPORT_TITLE}' AS value
UNION ALL
SELECT line, CASE WHEN check_name = 'orphan_items' AND n_rows = 0 THEN '{NO_ORPHANS}' ELSE
       '[' || table_name || '] ' || n_rows || ' ' || message
       || CASE check_name WHEN 'invalid_email' THEN {emails} WHEN 'orphan_items' THEN {orphans} ELSE '' END END
FROM report JOIN texts USING (table_name, check_name)"""


@register("w8_report_lines", oracle(["raw_orders", "raw_products", "raw_items", "shop_customers"], _sql_report()))
def report_lines_q(spark, d):
    return _report(shop_customers(spark, d), raw_products(spark, d), raw_orders(spark, d), raw_items(spark, d), C.AS_OF)


# ------------------------------------------------------------------ product listing
TOP_RATING = 4
LOW_PRICE = 1200
LISTING_CSV = ("title string, rating double, final_price double, initial_price double, discount double, ratings_count int, "
               "seller_name string, total_amount double")


def top_rated(df: DataFrame, below: float | None = None) -> DataFrame:
    """The listing's view of well rated products, and of those below a price. A
    price that is no number is below none."""
    rated = df.where(F.col("rating") > TOP_RATING).select("title", F.col("final_price").try_cast("double").alias("final_price"), "rating")
    return rated if below is None else rated.where(F.col("final_price") < below)


@register("w1_top_rated", oracle(["listing"], f"SELECT title, TRY_CAST(final_price AS DOUBLE) AS final_price, rating FROM listing WHERE rating > {TOP_RATING}"))
def top_rated_q(spark, d):
    return top_rated(listing(spark, d))


@register("w1_top_rated_cheap", oracle(["listing"], f"""
SELECT title, TRY_CAST(final_price AS DOUBLE) AS final_price, rating FROM listing
WHERE rating > {TOP_RATING} AND TRY_CAST(final_price AS DOUBLE) < {LOW_PRICE}"""))
def top_rated_cheap_q(spark, d):
    return top_rated(listing(spark, d), LOW_PRICE)


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@register("w1_listing_csv", QUERIES["w1_clean_listing"][1])
def listing_csv_q(spark, d):
    """The cleaned listing, written as CSV and read again."""
    path = _folder(spark, "listing")
    write_csv(C.clean_listing(listing(spark, d)).select(*(c.split()[0] for c in LISTING_CSV.split(", "))), path)
    return read_csv(spark, path, LISTING_CSV, mode="FAILFAST")


# ------------------------------------------------------------------ normalised tables
NORMALISED = {"customers": S.normalise_customers, "orders": S.normalise_orders, "products": S.normalise_products}


def loaded_counts(store: SnapshotStore, tables: list[str]) -> DataFrame:
    """``(table_name, n_rows)`` of the current versions, counted in the sink."""
    return reduce(DataFrame.unionAll, (store.read(t).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
                                       for t in tables))


def save_normalised(spark: SparkSession, d: str, store: SnapshotStore) -> dict[str, int]:
    """The flat lines as three tables by name, all current at once."""
    return store.publish_many({name: table(spark, d) for name, table in NORMALISED.items()})


@register("w3_normalised_tables", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS n_rows FROM ({QUERIES[f'w3_normalise_{name}'][1]}) AS {name}_rows" for name in NORMALISED))
def normalised_tables_q(spark, d):
    store = SnapshotStore(spark, _folder(spark, "normalised"))
    save_normalised(spark, d, store)
    return loaded_counts(store, list(NORMALISED))
