"""Every query that has an oracle gives its rows on the smallest tables."""

import glob
import os

import duckdb
import pytest

from skyloom.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def normal(rows):
    return sorted(tuple("nan" if isinstance(v, float) and v != v else repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_oracle(spark, oracle, name):
    df = registry.queries()[name](spark, SF)
    want = oracle.sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    order = sorted(df.columns)
    at, of = [df.columns.index(c) for c in order], [want.columns.index(c) for c in order]
    assert normal([r[i] for i in at] for r in df.collect()) == normal([r[i] for i in of] for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(registry.queries()) - set(registry.oracle_sql())))
def test_rows_only(spark, name):
    assert registry.queries()[name](spark, SF).count() > 0
