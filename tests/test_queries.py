import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from weftline.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("" if v is None or v is pd.NA or v != v else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got)
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_other_queries_have_rows(spark, name):
    assert len(QUERIES[name](spark, SF).toPandas())


def test_entry(spark):
    assert entry.entry(spark).count() == 25
