"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as driver
from grantlake.plans import catalog
from tests.conftest import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{TESTDATA}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.SQL)
    assert set(catalog.QUERIES) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    frame = driver.queries()[name](spark, TESTDATA)
    columns = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    order = [relation.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert got == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0
