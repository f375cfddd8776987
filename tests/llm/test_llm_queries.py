"""Every registered query with SQL against DuckDB, on the given tables."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
KEYS = sorted(k for k in entry.oracle_sql() if re.match(r"op\d+_", k))


def rows_of(records, columns):
    plain = lambda x: None if x is None or (isinstance(x, float) and math.isnan(x)) else x
    return sorted(repr(tuple(plain(r[c]) for c in columns)) for r in records)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_its_sql(spark, key):
    frame = entry.queries()[key](spark, SF_DIR)
    columns = sorted(frame.columns)
    with duckdb.connect() as con:
        for table in TABLES:
            con.sql(f"CREATE VIEW {table} AS FROM '{SF_DIR}/{table}.parquet'")
        answer = con.sql(entry.oracle_sql()[key])
        names = answer.columns
        expected = [dict(zip(names, row)) for row in answer.fetchall()]
    assert sorted(names) == columns
    assert rows_of([r.asDict() for r in frame.collect()], columns) == rows_of(expected, columns)


def test_all_operators_are_registered():
    numbers = sorted(int(m[1]) for k in entry.queries() if (m := re.match(r"op(\d+)_", k)))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()
