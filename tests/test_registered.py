"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, plain

FOLDER = "/root/testdata/sf0.001"
SLOW = {"dbscan_clusters", "outlier_predictions"}  # checked against brute force in test_models


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", [n for n in entry.queries() if n not in SLOW])
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = plain(tuple(r[c] for c in columns) for r in df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert got
        return
    result = duck.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == plain(tuple(r[i] for i in at) for r in result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
