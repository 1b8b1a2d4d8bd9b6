"""Sketches that merge, references by bitmap, drift inside nested columns."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillbook.operators.drift import fits_into, nested_drift, path_values, schema_paths, type_change, values_lost
from tillbook.operators.references import key_bitmaps, missing_references
from tillbook.operators.sketch import merge_sketches, quantile_sketches, rank_errors, sketch_quantiles
from tillbook.plans import medallion as M
from tillbook.plans.integrity import landed_tables

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("seed", range(3))
def test_merged_sketches_keep_their_rank_error(spark, seed):
    df = spark.range(60_000).select((F.col("id") % 40).alias("part"), F.randn(seed).alias("a"), (F.floor(F.rand(seed) * 5) * 7).alias("b"),
                                    F.when(F.col("id") % 3 == 0, F.pow(F.rand(seed + 1), F.lit(8.0))).alias("c"), F.lit(None).cast("int").alias("none"))
    cols, probs = ["a", "b", "c", "none"], [0.0, 0.01, 0.25, 0.5, 0.9, 1.0]
    parts = quantile_sketches(df, cols, ["part"])
    assert parts.count() == 40 * 3                                   # a column of NULLs has no sketch
    twice = merge_sketches(merge_sketches(parts, [(F.col("part") % 7).alias("week")]))
    assert {r.column_name: r.n_values for r in twice.collect()} == {"a": 60_000, "b": 60_000, "c": 20_000}
    errors = rank_errors(df, sketch_quantiles(twice, probs)).collect()
    assert len(errors) == 3 * len(probs) and max(r.rank_error for r in errors) <= 0.01
    assert sketch_quantiles(quantile_sketches(df.limit(0), cols), probs).count() == 0
    assert rank_errors(df, sketch_quantiles(quantile_sketches(df.limit(0), cols), probs)).count() == 0


def test_a_new_batch_needs_only_the_old_sketches(spark, scratch):
    p = M.silver_categories(spark, SF)
    old, new = p.filter("product_id % 10 <> 0"), p.filter("product_id % 10 = 0")
    quantile_sketches(old, list(M.DIMENSION_COLS)).write.parquet(f"{scratch}/sketches")
    whole = merge_sketches(spark.read.parquet(f"{scratch}/sketches").unionAll(quantile_sketches(new, list(M.DIMENSION_COLS))))
    errors = rank_errors(p, sketch_quantiles(whole, [0.25, 0.5, 0.75])).collect()
    assert len(errors) == 12 and max(r.rank_error for r in errors) <= 0.01
    exact, approx = M.silver_products(spark, SF), M.silver_products(spark, SF, median="approx")
    assert approx.schema == exact.schema and approx.count() == exact.count()
    assert approx.filter(" OR ".join(f"{c} IS NULL" for c in M.DIMENSION_COLS)).count() == 0


def test_missing_references_are_those_of_an_anti_join(spark):
    rnd = random.Random(1)
    numbers = [rnd.randint(-100_000, 100_000) for _ in range(3000)] + [0, -1, 1, 32767, 32768, -32768, -32767, None, 2**63 - 1, -2**63]
    parents = rnd.sample(numbers, 1500) + [5, 5, None]
    child = spark.createDataFrame([(n, i % 3) for i, n in enumerate(numbers + numbers[:50])], "k long, __bucket int")
    parent = spark.createDataFrame([(n,) for n in parents], "id long")
    want = sorted(n for n in numbers + numbers[:50] if n is not None and n not in set(parents))
    got = missing_references(child, "k", parent, "id")
    assert sorted(r.k for r in got.select("k").collect()) == want and got.columns == child.columns
    small = missing_references(child, "k", parent, "id", max_bytes=4096)            # too wide: an ordinary anti join
    assert sorted(r.k for r in small.select("k").collect()) == want and key_bitmaps(parent, "id", 4096) is None
    texts = missing_references(child.withColumn("k", F.col("k").cast("string")), "k", parent.withColumn("id", F.col("id").cast("string")), "id")
    assert sorted(int(r.k) for r in texts.select("k").collect()) == want
    assert missing_references(child, "k", parent.limit(0), "id").count() == child.where("k IS NOT NULL").count()
    assert missing_references(child.limit(0), "k", parent, "id").count() == 0


def test_the_referring_table_is_not_shuffled(spark):
    t = landed_tables(spark, SF)
    plan = missing_references(t["order_items"], "product_id", t["products"], "product_id")._jdf.queryExecution().executedPlan().toString()
    read = missing_references(spark.read.parquet(f"{SF}/lineitem.parquet"), "l_partkey", spark.read.parquet(f"{SF}/part.parquet"), "p_partkey")
    join = read._jdf.queryExecution().executedPlan().toString()
    above = join[:join.index("l_partkey", join.index("BroadcastHashJoin"))]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in join and "Exchange hashpartitioning" not in above


def test_paths_of_a_schema():
    t = T._parse_datatype_string("id int, a struct<b: array<struct<c: long, d: string>>, m: map<string, array<int>>>")
    assert schema_paths(t) == {"id": "int", "a": "struct", "a.b": "array", "a.b[]": "struct", "a.b[].c": "bigint", "a.b[].d": "string",
                               "a.m": "map", "a.m{key}": "string", "a.m{value}": "array", "a.m{value}[]": "int"}


@pytest.mark.parametrize("a,b,change", [
    ("int", "bigint", "widened"), ("bigint", "int", "narrowed"), ("bigint", "string", "incompatible"), ("tinyint", "double", "widened"),
    ("bigint", "double", "incompatible"), ("float", "double", "widened"), ("decimal(10,2)", "decimal(12,2)", "widened"),
    ("decimal(10,2)", "decimal(10,3)", "incompatible"), ("decimal(12,4)", "decimal(10,2)", "narrowed"), ("bigint", "decimal(19,0)", "widened"),
    ("bigint", "decimal(18,0)", "incompatible"), ("date", "timestamp_ntz", "widened"), ("int", "array", "incompatible"), ("struct", "array", "incompatible")])
def test_type_changes(a, b, change):
    assert type_change(a, b) == change and fits_into(a, a)


def test_nested_drift_names_the_topmost_path():
    a = T._parse_datatype_string("id int, s struct<x: int, gone: struct<y: int>>, l array<struct<p: decimal(10,2)>>, m map<string, int>, aa int")
    b = T._parse_datatype_string("id long, s struct<x: string, fresh: array<int>>, l array<struct<p: decimal(8,2)>>, m array<int>, aa int")
    assert nested_drift(a, b) == [
        ("id", "widened", "int", "bigint"), ("l[].p", "narrowed", "decimal(10,2)", "decimal(8,2)"), ("m", "incompatible", "map", "array"),
        ("s.fresh", "new", None, "array"), ("s.gone", "missing", "struct", None), ("s.x", "incompatible", "int", "string")]
    assert nested_drift(a, a) == []


def test_values_lost_by_a_type(spark):
    rows = [(1, [(10, {"a": 1}), (300, {"b": 2, "c": None})]), (2, []), (3, None), (4, [(None, None)])]
    df = spark.createDataFrame(rows, "id int, l array<struct<n: int, m: map<string, int>>>")
    assert values_lost(df, "l[].n", "tinyint").first()[:] == (2, 1)
    assert values_lost(df, "l[].m{value}", "string").first()[:] == (2, 0)
    assert sorted(r.value for r in path_values(df, "l[].m{key}").collect()) == ["a", "b", "c"]
    assert values_lost(df.limit(0), "l[].n", "tinyint").first()[:] == (0, 0)
