import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillbook.operators.basket import pair_counts
from tillbook.operators.dedup import dedup_by_key
from tillbook.operators.global_window import global_ntile, global_rank, range_running_sum, running
from tillbook.operators.quality import (Check, ForeignKey, NotNull, TableRules, Unique, apply_defaults,
                                        constraint_violations, describe_exact, null_counts, split_valid)
from tillbook.operators.scd import (merge_validation, scd1_merge, scd2_init, scd2_invariants, scd2_merge)


def _values(n=400, seed=7, hot=True):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        v = 42 if hot and i % 3 == 0 else rnd.randint(0, 60)     # one value holds a third of the rows
        rows.append((i, Decimal(v) + Decimal("0.25")))
    return rows


def test_running_matches_window(spark):
    df = spark.createDataFrame(_values(), "k long, v decimal(10,2)")
    got = running(df, [("v", True), ("k", False)], value="v", sum_col="cum", num_partitions=5,
                  total_count_col="n", total_sum_col="t")
    w = Window.orderBy(F.col("v").desc(), "k").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("k", F.row_number().over(Window.orderBy(F.col("v").desc(), "k")).alias("rn"),
                     F.sum("v").over(w).alias("cum"))
    g = {r.k: (r.row_number, r.cum, r.n, r.t) for r in got.collect()}
    total = sum(v for _, v in _values())
    for r in want.collect():
        assert g[r.k][0] == r.rn and g[r.k][1] == r.cum and g[r.k][2] == 400 and g[r.k][3] == total


def test_ntile_bucket_sizes(spark):
    for n in (1, 7, 10, 401):
        df = spark.createDataFrame([(i, i % 13) for i in range(n)], "k long, v long")
        got = global_ntile(df, 4, [("v", True), ("k", False)], out_col="q", num_partitions=3)
        want = df.select("k", F.ntile(4).over(Window.orderBy(F.col("v").desc(), "k")).alias("q"))
        assert sorted(got.select("k", "q").collect()) == sorted(want.collect())


@pytest.mark.parametrize("dense", [False, True])
def test_rank_with_ties(spark, dense):
    df = spark.createDataFrame(_values(), "k long, v decimal(10,2)")
    got = global_rank(df, "v", descending=True, out_col="r", dense=dense, num_partitions=4)
    fn = F.dense_rank() if dense else F.rank()
    want = df.select("k", fn.over(Window.orderBy(F.col("v").desc())).alias("r"))
    assert sorted((r.k, r.r) for r in got.collect()) == sorted((r.k, r.r) for r in want.collect())


def test_range_frame_running_sum(spark):
    df = spark.createDataFrame(_values(), "k long, v decimal(10,2)")
    got = range_running_sum(df, "v", "v", descending=True, out_col="s", num_partitions=4)
    want = df.select("k", F.sum("v").over(Window.orderBy(F.col("v").desc())).alias("s"))
    assert sorted((r.k, r.s) for r in got.collect()) == sorted((r.k, r.s) for r in want.collect())


def test_pair_counts_equals_self_join(spark):
    rnd = random.Random(3)
    rows = [(o, p, f"name{p % 5}") for o in range(60) for p in rnd.sample(range(30), rnd.randint(1, 8))]
    rows += [(999, p, f"name{p % 5}") for p in range(30)] * 2          # a hot order, every line twice
    df = spark.createDataFrame(rows, "o long, p long, name string")
    a, b = df.alias("a"), df.alias("b")
    want = (a.join(b, (F.col("a.o") == F.col("b.o")) & (F.col("a.p") < F.col("b.p")))
            .groupBy(F.col("a.name").alias("x"), F.col("b.name").alias("y")).count())
    want = {(r.x, r.y): r["count"] for r in want.collect()}
    # one block to a group; large groups cut into blocks, with a buffer that is flushed often
    for block, buffer in ((10_000, 200_000), (7, 3), (1, 1)):
        got = {(r.label_a, r.label_b): r.pairs for r in pair_counts(df, "o", "p", "name", block, buffer).collect()}
        assert got == want


def test_pair_counts_of_a_hot_order_with_many_labels(spark):
    n = 5_000
    rows = spark.range(n).selectExpr("1L as o", "id as p", "concat('name', id) as name")
    few = spark.createDataFrame([(2, 1, "name1"), (2, 2, "name2"), (None, 1, "x"), (None, 2, "y"), (3, None, "x"), (3, 5, None),
                                 (3, 6, "z"), (3, 6, "other")], "o long, p long, name string")
    got = pair_counts(rows.filter("p < 300").unionByName(few), "o", "p", "name", block=100)
    assert got.agg(F.sum("pairs"), F.count("*")).first()[:] == (300 * 299 // 2 + 1 + 2, 300 * 299 // 2 + 2)
    assert got.filter("label_a = 'name1' and label_b = 'name2'").first().pairs == 2
    by_tens = rows.select("o", "p", F.concat(F.lit("n"), F.col("p") % 10).alias("name"))
    assert pair_counts(by_tens, "o", "p", "name", block=700).agg(F.sum("pairs")).first()[0] == n * (n - 1) // 2
    assert pair_counts(rows, "o", "p", "name", block=1000, buffer=1000).filter("label_a = 'name0'").count() == n - 1


def test_dedup_by_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (2, "z", 1), (1, "a", 3)], "k int, s string, n int")
    assert sorted(dedup_by_key(df, "k").collect()) == [(1, "a", 3), (2, "z", 1)]
    assert sorted(dedup_by_key(df, "k", order=["n"]).collect()) == [(1, "b", 2), (2, "z", 1)]


T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)


def _dim(spark):
    base = spark.createDataFrame([(1, "A", "x"), (2, "B", None), (3, "C", "z"), (4, "D", "w")],
                                 "id int, city string, zip string")
    return scd2_init(base, T1)


def test_scd2_merge_cases(spark):
    batch = spark.createDataFrame([(1, "A", "x"), (2, "B", "y"), (3, "C2", "z"), (5, "E", "v")],
                                  "id int, city string, zip string")
    out = scd2_merge(_dim(spark), batch, "id", ["city", "zip"], T2)
    rows = {(r.id, r.is_current): r for r in out.collect()}
    assert len(out.collect()) == 7
    assert rows[(1, True)].effective_date == T1                       # unchanged: kept as is
    assert rows[(2, False)].end_date == T2 and rows[(2, True)].zip == "y"   # NULL -> value is a change
    assert rows[(3, False)].end_date == T2 and rows[(3, True)].city == "C2"
    assert rows[(4, True)].end_date is None                           # absent from batch: stays current
    assert rows[(5, True)].effective_date == T2                       # new key
    inv = scd2_invariants(out, "id").collect()[0]
    assert inv.keys_with_many_current == 0 and inv.inverted_intervals == 0


def test_scd2_null_unsafe_compat(spark):
    batch = spark.createDataFrame([(2, "B", "y")], "id int, city string, zip string")
    out = scd2_merge(_dim(spark), batch, "id", ["city", "zip"], T2, null_safe=False)
    assert out.count() == 4                                           # '<>' ignores NULL -> value


def test_scd2_merge_is_idempotent(spark):
    batch = spark.createDataFrame([(3, "C2", "z")], "id int, city string, zip string")
    once = scd2_merge(_dim(spark), batch, "id", ["city", "zip"], T2)
    twice = scd2_merge(once, batch, "id", ["city", "zip"], T2)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_rejects_duplicate_source_keys(spark):
    batch = spark.createDataFrame([(1, "A", "x"), (1, "Z", "x")], "id int, city string, zip string")
    with pytest.raises(ValueError):
        scd2_merge(_dim(spark), batch, "id", ["city"], T2)


def test_scd1_merge(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "id int, name string, sales int")
    s = spark.createDataFrame([(2, "B", 25), (3, "c", 30)], "id int, name string, sales int")
    out = sorted(scd1_merge(t, s, "id", ["sales"]).collect())
    assert out == [(1, "a", 10), (2, "b", 25), (3, "c", 30)]          # only listed columns update
    v = merge_validation(scd1_merge(t, s, "id", ["sales"]), "id").collect()[0]
    assert (v.total_rows, v.distinct_keys, v.duplicate_keys) == (3, 3, 0)


def test_constraints_reject_negative_price(spark):
    products = spark.createDataFrame([(999, "Test", Decimal("-50.00"), 10), (998, "Ok", Decimal("50.00"), 10)],
                                     "product_id int, product_name string, unit_price decimal(10,2), stock_qty int")
    orders = spark.createDataFrame([(1, 5), (2, None), (3, 999)], "order_id int, product_id int")
    rules = [TableRules("products", [NotNull("product_name"), Check("chk_price", "unit_price > 0"),
                                     Unique(("product_id",), False)]),
             TableRules("orders", [ForeignKey(("product_id",), "products", ("product_id",))])]
    got = {r.constraint_name: r.violations for r in
           constraint_violations({"products": products, "orders": orders}, rules).collect()}
    assert got == {"not_null_product_name": 0, "chk_price": 1, "unique_product_id": 0, "fk_product_id_products": 1}
    acc, rej = split_valid(products, {"chk_price": F.col("unit_price") > 0})
    assert acc.count() + rej.count() == products.count()
    assert [r.reason for r in rej.collect()] == ["chk_price"]


def test_defaults_only_for_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "id int, status string")
    from tillbook.operators.quality import Default
    out = apply_defaults(df, TableRules("t", [Default("status", "Pending", "string"), Default("qty", 0, "int")]))
    assert out.collect()[0].asDict() == {"id": 1, "status": None, "qty": 0}


def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [1.5, 2.0, 2.0, 7.255, 10.001, 3.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = describe_exact(df, ["x"]).collect()[0]
    want = pd.Series(vals).describe()
    assert got["count"] == want["count"]
    for k, p in (("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                 ("max", "max")):
        assert abs(got[k] - want[p]) < 1e-9


def test_null_counts_long_form(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert sorted(null_counts(df).collect()) == [("a", 1), ("b", 2)]


def test_segmented_matches_partitioned_window(spark):
    from tillbook.operators.global_window import segmented
    rnd = random.Random(11)
    # customer 7 holds about a third of the rows; several ranges must share it
    rows = [(7 if i % 3 == 0 else rnd.randint(0, 40), i, Decimal(rnd.randint(1, 99))) for i in range(600)]
    df = spark.createDataFrame(rows, "c long, k long, v decimal(10,2)")
    got = segmented(df, ["c"], [("k", False)], value="v", lag_cols=("k", "v"), row_col="rn", sum_col="cum",
                    num_partitions=6)
    w = Window.partitionBy("c").orderBy("k")
    want = df.select("c", "k", F.row_number().over(w).alias("rn"),
                     F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"),
                     F.lag("k").over(w).alias("prev_k"), F.lag("v").over(w).alias("prev_v"))
    cols = ["c", "k", "rn", "cum", "prev_k", "prev_v"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    # descending order column with a tie-break
    got = segmented(df, ["c"], [("v", True), ("k", False)], lag_cols=("k",), row_col="rn", num_partitions=5)
    w = Window.partitionBy("c").orderBy(F.col("v").desc(), "k")
    want = df.select("c", "k", F.row_number().over(w).alias("rn"), F.lag("k").over(w).alias("prev_k"))
    cols = ["c", "k", "rn", "prev_k"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_exact_medians(spark):
    import statistics
    from tillbook.operators.stats import exact_medians
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 3, 3, 3, rnd.randint(0, 50)]), float(rnd.randint(0, 9)) if i % 2 else None) for i in range(301)]
    df = spark.createDataFrame(rows, "a int, b double")
    got = {r.column_name: r.median for r in exact_medians(df, ["a", "b"]).collect()}
    assert got["a"] == statistics.median([r[0] for r in rows if r[0] is not None])
    assert got["b"] == statistics.median([r[1] for r in rows if r[1] is not None])


def test_drift_first_run_then_changes(spark, scratch):
    from tillbook.operators.drift import check_and_record
    base = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, amount double")
    first = check_and_record(spark, base, "orders", scratch)
    assert {r.change for r in first.collect()} == {"baseline"}
    assert check_and_record(spark, base, "orders", scratch).count() == 0          # no drift
    changed = base.drop("name").withColumn("channel", F.lit("web")).withColumn("amount", F.col("amount").cast("string"))
    got = {(r.column_name, r.change) for r in check_and_record(spark, changed, "orders", scratch).collect()}
    assert got == {("name", "missing"), ("channel", "new"), ("amount", "type_changed")}
    assert check_and_record(spark, changed, "orders", scratch).count() == 0       # reported once


def test_exact_quantiles_equal_percentile(spark):
    from tillbook.operators.stats import exact_quantiles
    rnd = random.Random(9)
    rows = [(rnd.uniform(0, 1000) if i % 4 else 42.0, float(rnd.randint(0, 5))) for i in range(257)]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.25, 0.5, 0.75, 0.9]
    want = df.agg(*[F.percentile(c, F.array(*[F.lit(p) for p in probs])).alias(c) for c in ("a", "b")]).collect()[0]
    got = {(r.column_name, r.prob): r.value for r in exact_quantiles(df, ["a", "b"], probs).collect()}
    for c in ("a", "b"):
        assert [got[(c, p)] for p in probs] == list(want[c])


def test_scale_operators_accept_empty_input(spark):
    from tillbook.operators.global_window import segmented
    from tillbook.operators.stats import exact_quantiles
    empty = spark.createDataFrame([], "c long, k long, v decimal(10,2), name string")
    assert running(empty, [("k", False)], value="v").count() == 0
    assert global_ntile(empty, 4, [("k", False)]).count() == 0
    assert global_rank(empty, "v").count() == 0
    assert segmented(empty, ["c"], [("k", False)], value="v", lag_cols=("k",)).count() == 0
    assert pair_counts(empty, "c", "k", "name").count() == 0
    assert exact_quantiles(empty, ["v"], [0.5]).count() == 0
