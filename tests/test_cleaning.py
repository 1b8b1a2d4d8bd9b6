"""Inline-row cases for the cleaning jobs (the edge cases the original tested by hand)."""

import datetime as dt
from decimal import Decimal

from tillbook.plans.cleaning import (clean_items, clean_orders, clean_products, invalid_emails, orphan_items,
                                     quality_report)
from tillbook.plans.integrity import apply_order_batch
from tillbook.plans.shop_analytics import validate_period


ITEMS = "item_id long, order_id long, product_id long, quantity int, line_amount decimal(18,2), discount_percent decimal(8,2)"
ORDERS = "order_id long, customer_id string, order_date string, status string"


def test_orphan_item_found_and_removed(spark):
    orders = spark.createDataFrame([(1, "5", "2025-01-01 10:00:00", "PLACED"), (2, "6", "2025-01-02", "SHIPPED")], ORDERS)
    items = spark.createDataFrame([(1, 1, 7, 1, Decimal("10"), Decimal("0")), (2, 2, 7, 1, Decimal("10"), Decimal("0")),
                                   (3, 999, 7, 1, Decimal("10"), Decimal("0"))], ITEMS)
    assert [r.item_id for r in orphan_items(items, orders).collect()] == [3]
    assert sorted(r.item_id for r in clean_items(items, orders).collect()) == [1, 2]


def test_discount_clipped_and_zero_quantity_kept(spark):
    orders = spark.createDataFrame([(1, "5", "2025-01-01", "PLACED")], ORDERS)
    items = spark.createDataFrame([(1, 1, 7, 0, Decimal("10"), Decimal("150")), (2, 1, 7, 5, Decimal("10"), Decimal("50")),
                                   (3, 1, 7, -2, Decimal("10"), None)], ITEMS)
    rows = {r.item_id: r for r in clean_items(items, orders).collect()}
    assert rows[1].discount_percent == 100 and rows[1].is_zero and rows[1].discount_was_invalid
    assert rows[2].discount_percent == 50 and not rows[2].discount_was_invalid
    assert rows[3].discount_percent is None and rows[3].is_return


def test_orders_dates_customers_status_future(spark):
    orders = spark.createDataFrame([(1, "", "05-01-2025", "PLACED"), (2, None, "2025-01-05 08:00:00", "BOGUS"),
                                    (3, " 42", "not a date", "SHIPPED"), (4, "7", "2035-01-01", "DELIVERED")], ORDERS)
    rows = {r.order_id: r for r in clean_orders(orders, as_of=dt.datetime(2026, 1, 1)).collect()}
    assert rows[1].customer_id is None and rows[1].had_missing_customer and rows[1].had_dd_mm_date
    assert rows[1].order_date == dt.datetime(2025, 1, 5)
    assert rows[2].customer_id is None and not rows[2].status_valid
    assert rows[3].customer_id == 42 and rows[3].order_date is None
    assert rows[4].is_future and not rows[1].is_future


def test_product_names_and_emails(spark):
    products = spark.createDataFrame([(1, "  wireless   MOUSE ", "c", "s", Decimal("1")), (2, "T-Shirt", "c", "s", Decimal("1"))],
                                     "product_id int, product_name string, category string, subcategory string, cost_price decimal(10,2)")
    rows = {r.product_id: r for r in clean_products(products).collect()}
    assert rows[1].product_name == "Wireless Mouse" and rows[1].was_messy
    assert rows[2].product_name == "T-Shirt" and not rows[2].was_messy
    customers = spark.createDataFrame([(1, "a@b.co"), (2, None), (3, "bad.mail")], "customer_id int, email string")
    assert sorted(r.customer_id for r in invalid_emails(customers).collect()) == [2, 3]


def test_report_lists_found_defects_and_integrity_line(spark):
    customers = spark.createDataFrame([(1, "x", "a@b.co"), (1, "x", "a@b.co")], "customer_id int, customer_name string, email string")
    products = spark.createDataFrame([(1, "Fine Name", "c", "s", Decimal("1"))],
                                     "product_id int, product_name string, category string, subcategory string, cost_price decimal(10,2)")
    orders = spark.createDataFrame([(1, "5", "2025-01-01", "PLACED")], ORDERS)
    items = spark.createDataFrame([(1, 1, 7, -1, Decimal("10"), Decimal("0"))], ITEMS)
    got = {(r.table_name, r.check_name): r.n_rows for r in quality_report(customers, products, orders, items, as_of=dt.datetime(2026, 1, 1)).collect()}
    assert got == {("customers", "duplicate_rows"): 1, ("order_items", "negative_quantity"): 1,
                   ("order_items", "orphan_items"): 0}


def test_empty_period_and_order_batch(spark):
    products = spark.createDataFrame([(1, 3), (2, 10)], "product_id long, stock_qty int")
    orders = spark.createDataFrame([(10, dt.date(2024, 8, 10)), (11, dt.date(1900, 1, 1))], "order_id long, order_date date")
    items = spark.createDataFrame([(10, 1, 5), (10, 2, 1), (11, 2, 1)], "order_id long, product_id long, quantity int")
    got = {r.product_id: (r.stock_after, r.is_valid) for r in
           apply_order_batch(products, orders, items, dt.date(2024, 8, 10), dt.date(2024, 8, 12)).collect()}
    assert got == {1: (-2, False), 2: (9, True)}
    assert apply_order_batch(products, orders, items, dt.date(1900, 1, 2), dt.date(1900, 1, 2)).count() == 0
    validate_period("monthly", dt.date(2025, 1, 1), dt.date(2025, 1, 31))


def test_order_batch_publishes_only_when_valid(spark, scratch):
    import os

    import pytest

    from tillbook.plans.integrity import publish_order_batch
    from tillbook.sources.snapshots import SnapshotStore
    store = SnapshotStore(spark, os.path.join(scratch, "lake"))
    store.publish("products", spark.createDataFrame([(1, 3), (2, 10)], "product_id long, stock_qty int"))
    orders = spark.createDataFrame([(10, dt.date(2024, 8, 10)), (11, dt.date(2024, 9, 1))], "order_id long, order_date date")
    items = spark.createDataFrame([(10, 1, 2), (10, 2, 1), (11, 1, 9)], "order_id long, product_id long, quantity int")
    versions = publish_order_batch(store, "products", orders, items, dt.date(2024, 8, 10), dt.date(2024, 8, 12))
    assert versions == {"products": 1, "orders": 0, "order_items": 0}
    assert [r.order_id for r in store.read("orders").collect()] == [10] and store.read("order_items").count() == 2
    assert sorted(tuple(r) for r in store.read("products").collect()) == [(1, 1), (2, 9)]
    with pytest.raises(ValueError):
        publish_order_batch(store, "products", orders, items, dt.date(2024, 9, 1), dt.date(2024, 9, 1))
    assert store.current_versions() == versions                           # nothing published
    late = publish_order_batch(store, "products", orders.filter("order_id = 11"), items.limit(0), dt.date(2024, 9, 1), dt.date(2024, 9, 1))
    assert late == {"products": 2, "orders": 1, "order_items": 1} and store.read("orders").count() == 2


def test_load_is_all_or_nothing(spark, scratch):
    import os

    import pytest

    from tillbook.operators.quality import Check, ForeignKey, NotNull, TableRules, Unique
    from tillbook.plans.integrity import Rejected, load_tables
    from tillbook.sources.snapshots import ConcurrentPublish, SnapshotStore
    store = SnapshotStore(spark, os.path.join(scratch, "lake"))
    registry = [TableRules("products", [Unique(("product_id",)), NotNull("product_id"), Check("chk_stock", "stock_qty >= 0")]),
                TableRules("items", [ForeignKey(("product_id",), "products", ("product_id",))])]
    products = spark.createDataFrame([(1, 3), (2, 10)], "product_id long, stock_qty int")
    items = spark.createDataFrame([(10, 1), (11, None)], "order_id long, product_id long")
    first = load_tables(store, {"products": products, "items": items}, registry)
    assert first == {"products": 0, "items": 0}
    bad = spark.createDataFrame([(1, -3), (1, 4)], "product_id long, stock_qty int")
    orphan = spark.createDataFrame([(10, 7)], "order_id long, product_id long")
    with pytest.raises(Rejected, match="unique_product_id: 2 rows") as e:
        load_tables(store, {"products": bad, "items": orphan}, registry)
    assert "chk_stock: 1 rows" in str(e.value) and "fk_product_id_products: 1 rows" in str(e.value)
    assert store.current_versions() == first
    # a writer that dies when all tables are written, but none is published
    broken = SnapshotStore(spark, store.root)
    broken._commit = lambda versions: (_ for _ in ()).throw(OSError("gone"))
    with pytest.raises(OSError):
        load_tables(broken, {"products": products.limit(1), "items": items.limit(1)}, registry)
    assert store.current_versions() == first and store.read("products").count() == 2
    # one that dies between its claim and the publication blocks others until it is given up
    store._claim(f"{store.root}/_published", store._listed(f"{store.root}/_published"))
    with pytest.raises(ConcurrentPublish):
        store.publish("products", products)
    store.recover()
    assert load_tables(store, {"products": products, "items": items}, registry).keys() == first.keys()
    assert store.publish("items", items, mode="append") == store.current_version("items") and store.read("items").count() == 4


def test_order_gaps_single_order_customer_is_normal(spark):
    from tillbook.plans.shop_analytics import order_gaps_frame
    orders = spark.createDataFrame(
        [(1, 10, dt.datetime(2025, 1, 1, 9)), (1, 11, dt.datetime(2025, 3, 1, 8)), (1, 12, dt.datetime(2025, 3, 1, 20)),
         (2, 20, dt.datetime(2025, 1, 5)), (None, 30, dt.datetime(2025, 1, 6))],
        "customer_id long, order_id long, order_date timestamp_ntz")
    out = order_gaps_frame(orders).collect()
    assert len(out) == 4                                     # the order without a customer is left out
    c1 = sorted((r for r in out if r.customer_id == 1), key=lambda r: (r.order_date, r.days_gap is not None, r.days_gap))
    # same-day orders keep order-id order: 10 -> 11 (59 days), 11 -> 12 (0 days)
    assert [r.days_gap for r in c1] == [None, 0, 59]
    assert {r.risk_flag for r in c1} == {"Normal"}          # mean gap (59 + 0) / 2 = 29.5
    only = [r for r in out if r.customer_id == 2]
    assert only[0].previous_order_date is None and only[0].days_gap is None and only[0].risk_flag == "Normal"


def test_previous_period_same_length():
    from tillbook.plans.shop_analytics import previous_period
    assert previous_period(dt.date(2025, 1, 1), dt.date(2025, 1, 31)) == (dt.date(2024, 12, 1), dt.date(2024, 12, 31))
    assert previous_period(dt.date(2025, 3, 10), dt.date(2025, 3, 10)) == (dt.date(2025, 3, 9), dt.date(2025, 3, 9))


def test_period_arguments_are_checked():
    import pytest

    from tillbook.plans.shop_analytics import validate_period
    validate_period("weekly", dt.date(2025, 1, 1), dt.date(2025, 1, 1))
    with pytest.raises(ValueError):
        validate_period("yearly", dt.date(2025, 1, 1), dt.date(2025, 1, 31))
    with pytest.raises(ValueError):
        validate_period("daily", dt.date(2025, 2, 1), dt.date(2025, 1, 31))


def test_period_report_by_day_texts(spark):
    import pytest

    from tillbook.plans.shop_analytics import parse_day, period_report
    sf = "/root/testdata/sf0.001"
    daily = period_report(spark, sf, "daily", "1997-01-01", " 1997-01-31 ").collect()
    monthly = period_report(spark, sf, "monthly", "1997-01-01", "1997-01-31").collect()
    assert len(monthly) == 1 < len(daily) and sum(r.total_orders for r in daily) == monthly[0].total_orders
    empty = period_report(spark, sf, "weekly", "1900-01-01", "1900-02-01").collect()
    assert [tuple(r) for r in empty] == [(None, 0, 0.0, 0)]
    assert parse_day("2024-02-29") == dt.date(2024, 2, 29)
    for bad in (("daily", "01/02/1997", "1997-01-31"), ("daily", "1997-02-30", "1997-03-01"), ("daily", "1997-02-01", "1997-01-01"), ("yearly", "1997-01-01", "1997-01-02")):
        with pytest.raises(ValueError):
            period_report(spark, sf, *bad)
