"""Every registered query against its SQL, on the smallest given data."""

import datetime as dt
import decimal

import pytest

import __spark_entry__ as driver
from cdcmart.plans.oracle import SQL
from cdcmart.plans.registry import QUERIES

duckdb = pytest.importorskip("duckdb")

SF_DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    yield con
    con.close()


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(_plain(r[i])) for i in order) for r in rows)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(driver.queries())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = QUERIES[name](spark, SF_DIR)
    want = db.execute(SQL[name])
    columns = [d[0] for d in want.description]
    expected = want.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert expected
    assert _bag(got.columns, got.collect()) == _bag(columns, expected)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
