"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from repsmith.plans.catalog import QUERIES
from repsmith.plans.driver_tables import TABLES

SF = "/root/testdata/sf0.001"


def canon(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "relative_performance" in df.columns


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    si = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    oi = sorted(range(len(ocols)), key=lambda i: ocols[i])
    a = sorted(tuple(canon(r[i]) for i in si) for r in rows)
    b = sorted(tuple(canon(r[i]) for i in oi) for r in cur.fetchall())
    assert a == b
