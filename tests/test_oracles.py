"""Every isoform query with SQL against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from isoloom.plans import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def text(v):
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query(spark, con, name):
    df = queries.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(text(r[c]) for c in cols) for r in df.collect())
    want = con.sql(queries.SQL[name])
    at = want.columns
    assert sorted(at) == cols
    assert got == sorted(tuple(text(r[at.index(c)]) for c in cols) for r in want.fetchall())
