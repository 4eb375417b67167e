"""Every text query that has SQL gives its rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

from skyloom.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, oracle, name):
    df, want = queries.queries()[name](spark, SF), oracle.sql(queries.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    at = [want.columns.index(c) for c in df.columns]
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(repr(tuple(r[i] for i in at)) for r in want.fetchall())
