"""Every registered driver query against its DuckDB oracle at sf0.001."""

import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from daymart.plans.tpch import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert set(E.queries()) >= set(E.oracle_sql())
