import os

import pytest
from pyspark.sql import functions as F

from tillbook.sources.files import copy_quote_all, list_files, read_csv, rename_strict, sanitize_columns
from tillbook.sources.snapshots import ConcurrentPublish, SchemaMismatch, SnapshotStore
from tillbook.sources.tables import load

SF = "/root/testdata/sf0.001"


def test_snapshot_versions(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "lake"))
    nation = load(spark, SF, "nation")
    assert store.publish("nation", nation) == 0
    # read version 0 while publishing version 1 from it (overwrite-in-place would fail)
    v1 = store.read("nation").withColumn("n_name", F.upper("n_name"))
    assert store.publish("nation", v1) == 1
    assert store.current_version("nation") == 1
    assert store.read("nation", 0).count() == store.read("nation").count() == 25
    with pytest.raises(SchemaMismatch):
        store.publish("nation", nation.drop("n_name"))
    assert store.publish("nation", nation.drop("n_name"), allow_schema_change=True) == 2
    assert os.path.exists(os.path.join(scratch, "lake", "nation", "v=0"))         # no version goes unasked
    store.expire("nation", keep=2)
    assert store.committed_versions("nation") == [1, 2] and store.read("nation").count() == 25
    assert not os.path.exists(os.path.join(scratch, "lake", "nation", "v=0"))
    got = store.publish_many({"a": nation, "b": nation})
    assert got == {"a": 0, "b": 0} and store.exists("a") and store.exists("b")
    # a writer that lost the race for a version fails instead of overwriting it
    open_claim = os.path.join(scratch, "lake", "a", "_claims", "1")
    os.makedirs(os.path.dirname(open_claim), exist_ok=True)
    # a crashed writer claimed version 1 and never committed: invisible, and the next writer skips it
    open(open_claim, "w").close()
    assert store.current_version("a") == 0
    assert store.publish("a", nation) == 2 and store.current_version("a") == 2
    # another writer has just claimed version 3; this writer's listing did not see it yet
    open(os.path.join(scratch, "lake", "a", "_claims", "3"), "w").close()
    orig = store._listed
    store._listed = lambda folder: [] if folder.endswith("_claims") else orig(folder)
    with pytest.raises(ConcurrentPublish):
        store.publish("a", nation)
    store._listed = orig


def test_csv_quotes_and_line_breaks(spark, scratch):
    path = os.path.join(scratch, "q.csv")
    with open(path, "w") as f:
        f.write('id,Product Name,Sub-Category,sales\n1,"5 1/2"" X 4"" card",Paper,3.5\n2,"two\nlines",Art,""\n')
    df = sanitize_columns(read_csv(spark, path, infer=True, multiline=True))
    assert df.columns == ["id", "Product_Name", "Sub_Category", "sales"]
    rows = df.orderBy("id").collect()
    assert rows[0].Product_Name == '5 1/2" X 4" card' and rows[1].Product_Name == "two\nlines"
    assert rows[1].sales is None
    with pytest.raises(KeyError):
        rename_strict(df, {"missing": "x"})


def test_listing_and_copy_job(spark, scratch):
    src = os.path.join(scratch, "in")
    load(spark, SF, "region").coalesce(1).write.option("header", True).csv(src)
    files = list_files(spark, src, "*.csv")
    assert files.count() == 1 and files.collect()[0].size > 0
    out = copy_quote_all(spark, src, os.path.join(scratch, "out"))
    assert out.count() == 1
    text = open(out.collect()[0].path.replace("file:", "")).read()
    assert text.splitlines()[1].startswith('"')                  # every field quoted
    with pytest.raises(FileNotFoundError):
        copy_quote_all(spark, src, os.path.join(scratch, "out2"), pattern="*.none")


def test_failfast_rejects_a_bad_row(spark, scratch):
    path = os.path.join(scratch, "bad.csv")
    with open(path, "w") as f:
        f.write("id,amount\n1,2.5\n2,not-a-number\n")
    ok = read_csv(spark, path, "id int, amount double")                      # permissive: bad value -> NULL
    assert [r.amount for r in ok.orderBy("id").collect()] == [2.5, None]
    with pytest.raises(Exception):
        read_csv(spark, path, "id int, amount double", mode="FAILFAST").collect()


def test_partitioned_publish_prunes_folders(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "lake"))
    orders = load(spark, SF, "orders").withColumn("order_month", F.date_format("o_orderdate", "yyyy-MM"))
    store.publish("orders", orders, partition_by=["order_month"])
    jan = store.read("orders").filter(F.col("order_month") == "1997-01")
    plan = jan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "1997-01" in plan
    assert jan.count() == orders.filter(F.col("order_month") == "1997-01").count()


def test_listing_skips_empty_and_requires_files(spark, scratch):
    folder = os.path.join(scratch, "drop")
    os.makedirs(folder)
    open(os.path.join(folder, "empty.csv"), "w").close()
    with open(os.path.join(folder, "full.csv"), "w") as f:
        f.write("a\n1\n")
    got = [r.file_name for r in list_files(spark, folder, "*.csv", require=True).collect()]
    assert got == ["full.csv"]                                   # the empty file is rejected
    with pytest.raises(FileNotFoundError):
        list_files(spark, folder, "*.json", require=True)


def test_copy_keeps_each_files_own_columns(spark, scratch):
    folder = os.path.join(scratch, "mixed")
    os.makedirs(folder)
    for name, text in {"x.csv": "a,b\n1,2\n", "y.csv": "b,a,c\n10,20,30\n", "z.csv": 'a,b\n3,"4 ""q"""\n'}.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    out = copy_quote_all(spark, folder, os.path.join(scratch, "copied"))
    got = {r.path.split("_out=output_")[1].split("/")[0]: open(r.path.replace("file:", "")).read() for r in out.collect()}
    assert got == {"x.csv": '"a","b"\n"1","2"\n', "y.csv": '"b","a","c"\n"10","20","30"\n', "z.csv": '"a","b"\n"3","4 ""q"""\n'}


def test_empty_and_quoted_empty_fields_are_null(spark, scratch):
    folder = os.path.join(scratch, "empties")
    os.makedirs(folder)
    with open(os.path.join(folder, "a.csv"), "w") as f:
        f.write('k,a,b\n1,"",x\n2,,y\n3," ",\n4,"z",""\n')
    from tillbook.sources.files import read_csv
    got = [tuple(r) for r in read_csv(spark, folder, "k int, a string, b string").orderBy("k").collect()]
    assert got == [(1, None, "x"), (2, None, "y"), (3, " ", None), (4, "z", None)]
