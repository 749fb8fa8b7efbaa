"""Every named query against its SQL, on the given tables."""

import os

import duckdb
import pytest

import __spark_entry__ as driver
from oracles import ORACLES
from tickloom.plans.reports import REPORTS

FOLDER = os.environ.get("ORACLE_FOLDER", "/root/testdata/sf0.01")
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    return con


def by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    # Queries of other packages may have none; their own tests compare them with brute force.
    assert set(REPORTS) == set(ORACLES)
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query(spark, duck, name):
    df = driver.queries()[name](spark, FOLDER)
    expected = duck.execute(driver.oracle_sql()[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    rows = df.collect()
    assert rows and by_name(df.columns, rows) == by_name(columns, expected.fetchall())


def test_mixed_batch_leaves_no_bar_out(spark):
    bars = {(r["symbol"], r["time"]) for r in REPORTS["candles_1h"](spark, "/root/testdata/sf0.001").collect()}
    found = {(r["symbol"], r["time"]) for r in REPORTS["late_mixed_whole"](spark, "/root/testdata/sf0.001").collect()}
    assert bars and found == bars | {(f"{s}-sparse", t) for s, t in bars if t // 3600 % 3 == 0}


def test_entry(spark):
    assert driver.entry(spark).count() > 0
