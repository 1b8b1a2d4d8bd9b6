"""Loading while validating: one read of each table, nothing published on a broken rule."""

import os
import re

import pytest
from pyspark.sql import functions as F

from tillbook.operators.quality import Check, ForeignKey, NotNull, TableRules, Unique, constraint_violations
from tillbook.plans.integrity import Rejected, constraints_q, load_tables
from tillbook.sources.snapshots import SnapshotStore

RULES = [TableRules("products", [NotNull("product_id"), Unique(("product_id",), False), Unique(("a", "b")), Check("chk_stock", "stock >= 0")]),
         TableRules("items", [NotNull("order_id"), ForeignKey(("product_id",), "products", ("product_id",)),
                              ForeignKey(("a", "b"), "products", ("a", "b"))])]
PRODUCTS, ITEMS = "product_id long, stock int, a string, b int", "order_id long, product_id int, a string, b long"


def test_every_kind_of_violation(spark):
    products = spark.createDataFrame([(1, 3, "x", 1), (1, -3, "x", 1), (None, None, None, 1), (None, 0, None, 1), (4, 0, "y,1", 2)], PRODUCTS)
    items = spark.createDataFrame([(1, 1, "x", 1), (None, 9, "x", 2), (2, None, None, 5), (3, 9, "y,1", 2), (4, 4, "y", 12)], ITEMS)
    got = {(r.table_name, r.constraint_name): (r.kind, r.violations)
           for r in constraint_violations({"products": products, "items": items}, RULES).collect()}
    assert got == {("products", "not_null_product_id"): ("NOT NULL", 2), ("products", "unique_product_id"): ("UNIQUE", 4),
                   ("products", "unique_a_b"): ("UNIQUE", 2), ("products", "chk_stock"): ("CHECK", 1),
                   ("items", "not_null_order_id"): ("NOT NULL", 1), ("items", "fk_product_id_products"): ("FOREIGN KEY", 2),
                   ("items", "fk_a_b_products"): ("FOREIGN KEY", 2)}
    none = constraint_violations({"products": products.limit(0), "items": items.limit(0)}, RULES).collect()
    assert len(none) == 7 and all(r.violations == 0 for r in none)


def test_each_table_is_read_once(spark):
    plan = constraints_q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    from tillbook.plans.integrity import landed_tables
    views = [df._jdf.queryExecution().optimizedPlan().toString() for df in landed_tables(spark, "/root/testdata/sf0.001").values()]
    scans = lambda text: len(re.findall(r"Relation \[", text))
    assert scans(plan) <= sum(map(scans, views))


def test_rows_are_computed_once_and_rejected_rows_leave_nothing(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "load"))
    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x

    watched = F.udf(touch, "int").asNondeterministic()
    products = spark.createDataFrame([(1, 3, "x", 1), (2, 3, "x", 2)], PRODUCTS).withColumn("stock", watched("stock"))
    items = spark.createDataFrame([(1, 1, "x", 1), (2, None, "x", None)], ITEMS)
    first = load_tables(store, {"products": products, "items": items}, RULES)
    assert first == {"products": 0, "items": 0} and seen.value == 2
    bad = items.unionAll(spark.createDataFrame([(None, 7, "x", 2)], ITEMS))
    with pytest.raises(Rejected) as e:
        load_tables(store, {"items": bad}, RULES)            # the parent is the published table
    assert str(e.value) == "items.not_null_order_id: 1 rows; items.fk_product_id_products: 1 rows"
    assert store.current_versions() == first and store.read("items").count() == 2
    assert sorted(f for f in os.listdir(os.path.join(scratch, "load", "items")) if f.startswith("v=")) == ["v=0"]
    assert load_tables(store, {"items": items}, RULES) == {"items": 2}


def test_counts_of_a_publication(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "counts"))
    df = spark.range(100).withColumn("x", F.col("id") % 7)
    versions, counted = store.stage_many({"t": df}, metrics={"t": {"zeros": F.count_if(F.col("x") == 0)}})
    assert counted == {"t": {"n_rows": 100, "zeros": 15}} and not store.exists("t")
    store.commit(versions)
    assert store.read("t").count() == 100
