"""Registered queries against DuckDB on the smallest test tables."""

import math
from datetime import date
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from ledgerlift.catalog.checks import ORACLES
from ledgerlift.catalog.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables not mounted")
def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return value.isoformat() if isinstance(value, date) else repr(value)


def table(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(row[i]) for i in order) for row in data)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, duck, name):
    df = queries()[name](spark, str(FOLDER))
    result = duck.execute(oracle_sql()[name])
    expected = table([c[0] for c in result.description], result.fetchall())
    assert table(df.columns, df.collect()) == expected


def test_registry():
    assert set(oracle_sql()) <= set(queries())
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1
