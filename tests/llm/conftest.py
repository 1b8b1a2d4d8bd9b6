import os

import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
SPACE = " \t\n\x0b\x0c\r"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def table(spark):
    """A small frame from rows and a schema string, in several partitions."""
    def make(rows, schema, parts=3):
        return spark.createDataFrame(rows, schema).repartition(parts)
    return make


@pytest.fixture(scope="session")
def docs_of(table):
    """Rows of ``documents`` from (doc_id, text) pairs, with columns whose names clash with the operators' own."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("key", T.StringType()), ("id", T.LongType()), ("node", T.LongType()),
        ("fp", T.StringType()), ("n_lines", T.LongType()), ("spans", T.StringType()), ("lang_pred", T.StringType()),
        ("score", T.DoubleType()), ("component_id", T.LongType()), ("shard", T.LongType()), ("piece", T.IntegerType()))])

    def make(pairs):
        return table([(i, t, "k", 7, 7, "f", 7, "s", "l", 0.5, 7, 7, 7) for i, t in pairs], schema)
    return make


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        path = os.path.join(SF, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con
