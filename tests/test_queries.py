"""Every registered query against its SQL oracle, row for row, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as driver
from tillroll.plans.catalog import all_queries
from tillroll.plans.oracle import all_oracles

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(all_oracles()) <= set(driver.queries())


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["year", "total_sales", "lagged_sales", "yoy_pct"] and df.count() > 0


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def plain(v):
        return None if isinstance(v, float) and math.isnan(v) else v

    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, oracle, name):
    df = driver.queries()[name](spark, SF_DIR)
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    result = oracle.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    want = sorted_rows(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert got == want
