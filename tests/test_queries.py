"""Every registered query against its SQL, over both kinds of external database."""

import decimal

import duckdb
import pytest

import __spark_entry__ as registered
from crossfeed.fixtures import KIND_SETTING
from crossfeed.plans.registry import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def expected():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (int, float, decimal.Decimal)):
        return f"{float(value):.9g}"
    return str(value)


def rows_of(names, rows, order):
    places = [names.index(name) for name in order]
    return sorted(tuple(plain(row[place]) for place in places) for row in rows)


@pytest.mark.parametrize("kind", ["derby", "sqlite"])
@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, expected, key, kind):
    spark.conf.set(KIND_SETTING, kind)
    try:
        frame = registered.queries()[key](spark, SF_DIR)
        found = frame.collect()
    finally:
        spark.conf.unset(KIND_SETTING)
    result = expected.execute(registered.oracle_sql()[key])
    names = [column[0] for column in result.description]
    assert sorted(names) == sorted(frame.columns)
    order = sorted(names)
    assert rows_of(frame.columns, found, order) == rows_of(names, result.fetchall(), order)
    assert found


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(registered.queries()) and set(SQL) <= set(registered.oracle_sql())


def test_entry(spark):
    frame = registered.entry(spark)
    assert frame.columns == ["n_name", "average"]
    assert frame.count() == 5
