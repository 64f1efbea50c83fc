"""Every registered query of the engine against its SQL form, on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from footlights.plans.registry import ORACLE, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    return con


def rows(df: pd.DataFrame) -> list[tuple]:
    one = lambda x: "~" if pd.isna(x) else f"{float(x):.6f}" if isinstance(x, (int, float)) or hasattr(x, "dtype") and x.dtype.kind in "fiu" else str(x)
    return sorted(tuple(one(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
