"""Every registered query against its SQL on the smallest tables."""

import datetime as dt
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from rivermark.plans import ORACLES, QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="base tables are not there")


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return round(value, 6) if isinstance(value, float) else value


def rows_of(columns, rows):
    order = sorted(columns)
    at = [list(columns).index(c) for c in order]
    return order, sorted((tuple(plain(r[i]) for i in at) for r in rows), key=str)


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone='UTC'")
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert name in ORACLES
    result = duck.execute(ORACLES[name])
    assert got == rows_of([c[0] for c in result.description], result.fetchall())


def test_entry(spark):
    assert set(entry.queries()) >= set(entry.oracle_sql())
    assert entry.entry(spark).columns
