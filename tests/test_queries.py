"""Every query against the same query in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from stratagrid.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(DATA):
        c.execute(f"create view {f[:-8]} as select * from read_parquet('{DATA}/{f}')")
    return c


def rows(df: pd.DataFrame) -> list:
    def cell(v):
        if v is None or v is pd.NA or v is pd.NaT or isinstance(v, float) and math.isnan(v):
            return "~"
        return str(v) if isinstance(v, (bool, str)) or not hasattr(v, "__float__") else repr(float(v))

    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, duck, name):
    assert rows(QUERIES[name](spark, DATA).toPandas()) == rows(duck.execute(SQL[name]).df())


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_layout(spark):
    best = QUERIES["layout_score"](spark, DATA).collect()
    assert 0 < len(best) <= 20 and all(2.5 <= r.mb <= 6 for r in best)
    assert [r.score for r in best] == sorted((r.score for r in best), reverse=True)
