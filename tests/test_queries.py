"""Every query with SQL gives DuckDB's rows on the smallest tables; all run."""

import os

import duckdb
import pandas as pd
import pytest

from quire import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


def rows(df):
    cols = sorted(df.columns)
    plain = lambda v: "" if v is None or v is pd.NA or v is pd.NaT or v != v else repr(float(v)) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)
    return cols, sorted(tuple(plain(v.item() if hasattr(v, "item") else v) for v in r) for r in df[cols].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_against_sql(spark, duck, name):
    assert rows(catalog.queries()[name](spark, SF).toPandas()) == rows(duck.sql(catalog.oracle_sql()[name]).df())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() >= 0
