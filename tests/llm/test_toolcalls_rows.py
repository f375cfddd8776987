"""Every turn is in a row, whatever is NULL or repeated; the query gives the rows of its SQL there too."""

import json
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from crossfeed.llm import toolcalls

SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [
    (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"), (1, 3, "user", ""), (1, 3, "user", "again"),
    (1, 3, "user", "again"), (1, 4, "assistant", "b"), (1, 4, "assistant", "a"), (1, 4, None, "who"), (1, 5, "user", "x" * 500),
    (None, 0, "user", "q0"), (None, 0, "user", "q0b"), (None, 1, "assistant", "x"), (None, 7, "user", "n7"),
    (7, None, "user", "no turn"), (7, None, "assistant", None), (7, 0, "user", None), (None, None, None, None), (8, 1, "assistant", "lonely"),
    (9, 2, "user", "parent unknown"), (9, -3, "user", "below"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("turns"))
    spark.createDataFrame(TURNS, SCHEMA).coalesce(3).write.parquet(f"{place}/conversations.parquet")
    return place


def test_no_turn_is_lost(spark, folder):
    rows = entry.queries()["op8_tool_calls"](spark, folder).collect()
    texts = Counter()
    for row in rows:
        record = json.loads(row["json"])
        if row["n_calls"]:
            texts[(record["arguments"] or {}).get("text")] += 1
        if row["n_results"]:
            texts[record["result"]] += 1
    assert texts == Counter(text for *_, text in TURNS)
    by = Counter((row["call_id"], row["status"]) for row in rows)
    assert by["1:3", "repeated"] == 4 and by["1:3", "answered"] == 1
    assert by[None, "open"] == 4 and by[None, "orphan"] == 3


def test_query_equals_its_sql_there(spark, folder):
    frame = entry.queries()["op8_tool_calls"](spark, folder)
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW conversations AS FROM '{folder}/conversations.parquet/*.parquet'")
        answer = con.sql(entry.oracle_sql()["op8_tool_calls"])
        expected = Counter(zip_sorted(answer.columns, row) for row in answer.fetchall())
    assert Counter(zip_sorted(frame.columns, row) for row in frame.collect()) == expected


def zip_sorted(columns, row):
    return tuple(sorted(zip(columns, row)))


def test_one_hot_identifier(spark):
    calls = spark.range(500).selectExpr("'c' AS call_id", "id % 3 AS seq", "'free' AS name", "'{}' AS arguments", "NULL AS parent_id")
    results = spark.range(300).selectExpr("IF(id % 2 = 0, 'c', NULL) AS call_id", "id AS seq", "CAST(id AS STRING) AS content")
    rows = toolcalls.link(calls, results, {"free": {}}).collect()
    assert Counter(row["status"] for row in rows) == {"answered": 1, "repeated": 499 + 149, "orphan": 150}
    head = next(row for row in rows if row["status"] == "answered")
    assert (head["n_calls"], head["n_results"], json.loads(head["json"])["result"]) == (500, 150, "0")
