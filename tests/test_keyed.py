"""Keyed tables (copy on write by bucket), appends that write only new rows, and merges with null keys."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillbook.operators.scd import scd1_merge, scd2_changes, scd2_init, scd2_merge
from tillbook.sources.snapshots import SchemaMismatch, SnapshotStore

T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folders(store, table, version):
    return sorted(n for n in os.listdir(f"{store.root}/{table}/v={version}") if n.startswith("_bucket="))


def test_a_small_batch_writes_only_its_buckets(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "keyed"))
    customers = spark.range(5000).select("id", (F.col("id") % 7).cast("string").alias("city"))
    store.publish_keyed("dim", scd2_init(customers, T0), "id", buckets=50)
    assert len(folders(store, "dim", 0)) == 50
    batch = customers.where("id IN (3, 4000)").withColumn("city", F.lit("new")).unionAll(spark.createDataFrame([(9999, "x")], "id long, city string"))
    merge = lambda dim, b: scd2_merge(dim, b, "id", ["city"], T1)
    whole = merge(store.read("dim"), batch)
    assert store.merge_keyed("dim", batch, "id", merge) == 1
    assert 1 <= len(folders(store, "dim", 1)) <= 3                  # 5 of 5,000 keys: at most three buckets
    assert rows(store.read("dim")) == rows(whole)
    assert store.read("dim").count() == 5003 and store.read("dim", 0).count() == 5000
    # merging the whole table's changes gives the same as merging the whole table
    full = customers.unionAll(batch.where("id = 9999")).withColumn("city", F.when(F.col("id") == 17, F.lit("moved")).otherwise(F.col("city")))
    changes = scd2_changes(store.read("dim"), full, "id", ["city"])
    assert sorted(r.id for r in changes.collect()) == [3, 17, 4000]
    second = lambda dim, b: scd2_merge(dim, b, "id", ["city"], T2)
    expected = rows(second(store.read("dim"), full))
    store.merge_keyed("dim", changes, "id", second)
    assert rows(store.read("dim")) == expected
    # an empty batch writes nothing new
    store.merge_keyed("dim", batch.limit(0), "id", second)
    assert folders(store, "dim", 3) == [] and rows(store.read("dim")) == expected
    store.expire("dim", keep=1)
    assert rows(store.read("dim")) == expected and store.committed_versions("dim") == [3]


def test_keyed_tables_guard_their_layout(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "guard"))
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id long, x string")
    store.publish("plain", df)
    with pytest.raises(ValueError, match="not keyed"):
        store.merge_keyed("plain", df, "id", lambda t, b: t)
    store.publish_keyed("keyed", df.limit(0), "id")
    assert store.read("keyed").count() == 0
    store.merge_keyed("keyed", df, "id", lambda t, b: t.unionAll(b))
    assert rows(store.read("keyed")) == rows(df)
    with pytest.raises(SchemaMismatch):
        store.merge_keyed("keyed", df, "id", lambda t, b: t.drop("x"))
    with pytest.raises(ValueError, match="merge_keyed"):
        store.publish("keyed", df, mode="append")


def test_an_append_leaves_old_rows_where_they_are(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "append"))
    old = spark.range(1000).select("id", F.lit("a").alias("x"))
    new = spark.createDataFrame([(1000, "b")], "id long, x string")
    store.publish("t", old)
    for _ in range(2):
        store.publish("t", new, mode="append")
    assert store.read("t").count() == 1002
    assert spark.read.parquet(f"{store.root}/t/v=2").count() == 1                     # only the new row was written
    store.publish("t", new.withColumn("y", F.lit(1)), mode="append", allow_schema_change=True)
    assert store.read("t").count() == 1003 and store.read("t").where("y = 1").count() == 1
    assert store.read("t", 1).count() == 1001
    store.publish("t", new.withColumn("y", F.lit(1)), mode="append")
    store.expire("t", keep=1)
    assert store.read("t").count() == 1004


def test_merges_with_null_keys(spark):
    schema = "id long, name string"
    target = spark.createDataFrame([(None, "keep me"), (1, "a"), (2, "b")], schema)
    batch = spark.createDataFrame([(None, "new null"), (None, "other"), (2, "c"), (3, "d")], schema)
    assert rows(scd1_merge(target, batch, "id", ["name"])) == rows(spark.createDataFrame([(None, "keep me"), (1, "a"), (2, "c"), (3, "d")], schema))
    dim = scd2_init(target, T0)
    once = scd2_merge(dim, batch, "id", ["name"], T1)
    twice = scd2_merge(once, batch, "id", ["name"], T2)
    assert rows(once) == rows(twice) == sorted([
        (None, "keep me", T0, None, True), (1, "a", T0, None, True), (2, "b", T0, T1, False), (2, "c", T1, None, True), (3, "d", T1, None, True)], key=repr)
