import os

from tillbook.sources.tables import load
from tillbook.streaming.bronze_stream import run_bronze_ingest

SF = "/root/testdata/sf0.001"


def test_incremental_ingest_takes_each_file_once(spark, scratch):
    src, dst = os.path.join(scratch, "landing"), os.path.join(scratch, "bronze")
    nation = load(spark, SF, "nation")
    nation.filter("n_nationkey < 10").write.parquet(os.path.join(src, "batch1"))
    run_bronze_ingest(spark, src, dst, nation.schema, recursiveFileLookup="true")
    first = spark.read.parquet(dst)
    assert first.count() == 10
    assert set(first.columns) >= {"_ingestion_timestamp", "_source_file"}
    nation.filter("n_nationkey >= 10").write.parquet(os.path.join(src, "batch2"))
    run_bronze_ingest(spark, src, dst, nation.schema, recursiveFileLookup="true")
    assert spark.read.parquet(dst).count() == 25                 # only the new files were added


def test_incremental_csv_ingest_with_quotes_and_line_breaks(spark, scratch):
    src, dst = os.path.join(scratch, "landing_csv"), os.path.join(scratch, "bronze_csv")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write('id,name\n1,"5 1/2"" card"\n2,"two\nlines"\n')
    schema = "id int, name string"
    from pyspark.sql import types as T
    struct = T._parse_datatype_string(schema)
    run_bronze_ingest(spark, src, dst, struct, fmt="csv", multiline=True)
    rows = sorted((r.id, r.name, r._source_file) for r in spark.read.parquet(dst).collect())
    assert rows == [(1, '5 1/2" card', "a.csv"), (2, "two\nlines", "a.csv")]


def test_a_new_application_goes_on_where_the_last_one_ended(spark, scratch):
    src, one, two = (os.path.join(scratch, *p) for p in (("drop",), ("a", "bronze"), ("b", "bronze")))
    nation = load(spark, SF, "nation")
    for n, part in enumerate(("n_nationkey < 10", "n_nationkey >= 10")):
        # every application has its own checkpoint folder
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, f"application{n}"))
        nation.filter(part).write.parquet(os.path.join(src, f"batch{n}"))
        for target in (one, two):                                # two targets of the same last name
            run_bronze_ingest(spark, src, target, nation.schema, recursiveFileLookup="true")
    for target in (one, two):
        keys = [r.n_nationkey for r in spark.read.parquet(target).collect()]
        assert sorted(keys) == list(range(25))
