"""Every query of the core against its SQL on the smallest test tables."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from foliant import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and np.isnan(x)):
        return "NULL"
    if isinstance(x, (bool, int, float, np.integer, np.floating, np.bool_)):
        return f"{float(x):.6g}"
    return str(x)


def _rows(df):
    df = df[sorted(df.columns)]
    return list(df.columns), sorted(tuple(_cell(x) for x in r) for r in df.itertuples(index=False))


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for f in os.listdir(data):
        c.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, data, duck, name):
    got = QUERIES[name](spark, data).toPandas()
    if name in SQL:
        assert _rows(got) == _rows(duck.sql(SQL[name]).df())
