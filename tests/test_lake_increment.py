"""The lake that follows what lands: the same tables as a run over everything, from the touched buckets only."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillbook.operators.changes import add_partials, row_changes
from tillbook.plans import lake_increment as L
from tillbook.plans import medallion as M
from tillbook.plans.lake import GOLD, SILVER
from tillbook.sources.snapshots import SnapshotStore

SF = "/root/testdata/sf0.001"
T0, T1, T2 = (dt.datetime(2024, n, 1) for n in (1, 2, 3))


def rows(df):
    return Counter(map(repr, df.select(*sorted(df.columns)).collect()))


def check(store, raw):
    """Every silver and gold table of the store against a run over all rows."""
    silver = {n: clean(*(raw[t] for t in inputs)) for n, (clean, inputs) in SILVER.items()}
    for n, df in silver.items():
        assert rows(store.read(f"silver_{n}")) == rows(df), n
    for n, (aggregate, inputs) in GOLD.items():
        assert rows(store.read(f"gold_{n}")) == rows(aggregate(*(silver[t] for t in inputs))), n


def written(store, table, version):
    return [n for n in os.listdir(f"{store.root}/{table}/v={version}") if n.startswith("_bucket=")]


def test_landed_rows_reach_every_layer(spark, scratch):
    raw = {n: view(spark, SF).cache() for n, view in M._MK_RAW.items()}
    late = F.col("order_id") % 40 == 7
    first = raw | {"orders": raw["orders"].where(~late), "customers": raw["customers"].where("customer_id % 25 <> 3"),
                   # some orders have a part of their lines and payments only
                   "order_items": raw["order_items"].where(~late & ~((F.col("order_id") % 40 == 9) & (F.col("order_item_id") > 1))),
                   "order_payments": raw["order_payments"].where("order_id % 30 <> 11")}
    store = SnapshotStore(spark, os.path.join(scratch, "lake"))
    L.start(spark, first, store.root, T0, buckets=16)
    check(store, first)
    rest = {n: row_changes(first[n], raw[n]).select("*", F.explode(F.sequence(F.lit(1), "change")).alias("n")).drop("n", "change")
            for n in ("orders", "order_items", "order_payments")}
    versions = L.land(spark, rest, store.root, T1)
    assert "silver_customers" not in versions and "state_states" in versions
    check(store, raw | {"customers": first["customers"]})
    # customers decide the states of orders that landed long before
    L.land(spark, {"customers": raw["customers"].where("customer_id % 25 = 3")}, store.root, T2)
    check(store, raw)


def test_one_landed_row_touches_one_bucket(spark, scratch):
    raw = {n: view(spark, SF).cache() for n, view in M._MK_RAW.items()}
    store = SnapshotStore(spark, os.path.join(scratch, "one"))
    L.start(spark, raw, store.root, T0, buckets=16)
    one = raw["order_items"].where("price > 0").limit(1).withColumns(
        {"order_item_id": F.lit(99).cast(raw["order_items"].schema["order_item_id"].dataType)}).cache()
    versions = L.land(spark, {"order_items": one}, store.root, T1)
    for table in ("bronze_order_items", "silver_order_items", "state_paid_orders"):
        assert len(written(store, table, versions[table])) <= 1
    assert not {"silver_orders", "silver_products", "state_states"} & set(versions)
    old, new = store.differing("silver_order_items", 0)
    assert 0 < len(old.inputFiles()) <= 2 and 0 < old.count() < raw["order_items"].count() / 4
    changed = row_changes(old, new).collect()
    assert [(r["order_item_id"], r["change"]) for r in changed] == [(99, 1)]
    check(store, raw | {"order_items": raw["order_items"].unionByName(one)})
    # the same row once more is a duplicate, which the silver layer leaves out
    L.land(spark, {"order_items": one}, store.root, T2)
    assert row_changes(*store.differing("silver_order_items", 1)).count() == 0
    check(store, raw | {"order_items": raw["order_items"].unionByName(one).unionByName(one)})


def test_lines_without_an_order_and_nothing_at_all(spark, scratch):
    raw = {n: view(spark, SF).cache() for n, view in M._MK_RAW.items()}
    store = SnapshotStore(spark, os.path.join(scratch, "null"))
    L.start(spark, raw, store.root, T0, buckets=4)
    lost = raw["order_items"].where("price > 0").limit(2).withColumn("order_id", F.lit(None).cast("long")).cache()
    L.land(spark, {"order_items": lost, "orders": raw["orders"].limit(0)}, store.root, T1)
    check(store, raw | {"order_items": raw["order_items"].unionByName(lost)})
    versions = L.land(spark, {"order_payments": raw["order_payments"].limit(0)}, store.root, T2)
    assert written(store, "silver_order_payments", versions["silver_order_payments"]) == []


def test_row_changes_count_copies(spark):
    schema = "id long, x double, s string, a array<int>"
    old = spark.createDataFrame([(1, 0.0, None, [1]), (1, 0.0, None, [1]), (2, float("nan"), "", None), (None, None, None, None), (4, 1.0, "gone", [])], schema)
    new = spark.createDataFrame([(1, -0.0, None, [1]), (2, float("nan"), "", None), (None, None, None, None), (4, 1.0, None, []), (5, 5.0, "v", [5])] + [(6, 1.0, "k", [])] * 3, schema)
    got = {(r["id"], r["s"]): r["change"] for r in row_changes(old, new).collect()}
    assert got == {(1, None): -1, (4, "gone"): -1, (4, None): 1, (5, "v"): 1, (6, "k"): 3}
    assert row_changes(old, old).count() == 0 and row_changes(old.limit(0), old).agg(F.sum("change")).first()[0] == 5
    with pytest.raises(ValueError, match="columns"):
        row_changes(old, new.drop("s"))


def test_partials_follow(spark):
    part = lambda r: spark.createDataFrame(r, "g string, s long, n_rows long")
    got = add_partials(part([("a", 5, 2), (None, 1, 1), ("b", 7, 1)]), part([("b", 7, 1), (None, 1, 1)]), part([(None, 4, 2), ("c", 1, 1)]), ["g"])
    assert sorted(map(tuple, got.collect()), key=repr) == [("a", 5, 2), ("c", 1, 1), (None, 4, 2)]
