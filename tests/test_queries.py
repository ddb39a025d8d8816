"""Every query with SQL against DuckDB, on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

from tessella import queries as base

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def rows(frame):
    def plain(v):
        if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
            return "null"
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(plain(v) for v in r) for r in frame[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(base.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    assert rows(base.queries()[name](spark, SF).toPandas()) == rows(db.sql(base.oracle_sql()[name]).df())


def test_every_query_has_sql():
    assert set(base.queries()) == set(base.oracle_sql())


def test_entry_module(spark):
    import __spark_entry__ as entry

    assert set(base.queries()) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["pixel_acc", "mean_class_acc", "mean_class_iou"]
