"""The driver contract, and every registered query against its oracle SQL."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tillbook.plans import catalog
from tillbook.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and df.columns == ["category", "total_revenue"]


def test_every_query_has_oracle_sql_or_is_listed():
    assert set(catalog.queries()) - set(catalog.oracle_sql()) == set()
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(catalog.queries()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    got = df.collect()
    sql = catalog.oracle_sql().get(name)
    if sql is None:
        assert len(got) > 0
        return
    res = duck.execute(sql)
    cols = [c[0] for c in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in got]) == _rows(cols, res.fetchall())
