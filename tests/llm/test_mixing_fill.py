"""A source comes near its target whatever sizes its documents have, and by the rows of the SQL."""

import duckdb
import pytest

import __spark_entry__ as entry
from crossfeed.llm import mixing


@pytest.mark.parametrize("seed", [f"mix{n}" for n in range(4)])
def test_one_huge_document_stops_nothing(spark, seed):
    docs = [(i, "w " * 400, "a") for i in range(500)] + [(1000, "w " * 400_000, "a")]
    # the other source takes three quarters of all words, so 200,000 are left to the first
    docs += [(2000 + i, "w " * 10_000, "b") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(frame, weights=(1, 3), seed=seed).collect()
    for source in "ab":
        own = [row for row in rows if row["source"] == source]
        assert abs(own[0]["target"] - sum(row["taken"] for row in own)) <= (400 if source == "a" else 10_000)


def test_mixed_sizes_end_within_the_smallest_open_document(spark):
    docs = [(i, "w " * (1 + (i * i * 7919) % 3000), "abc"[i % 3]) for i in range(600)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mixing.mix(frame).collect()
    for source in "abc":
        own = [row for row in rows if row["source"] == source]
        open_sizes = [row["size"] for row in own if row["copies"] < row["target"] / row["source_size"]]
        assert abs(own[0]["target"] - sum(row["taken"] for row in own)) <= min(open_sizes, default=1)


def test_rows_of_one_id_and_equal_rows(spark, tmp_path):
    docs = [(None if i % 2 else 5, "w " * (1 + i % 17), "ab"[i % 4 == 0]) for i in range(400)]
    docs += [(7, "same words here", "a")] * 300 + [(None, None, None), (None, "", "a"), (8, "x", None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(5)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [tuple(row) for row in entry.queries()["op2_pareto_mix"](spark, str(tmp_path)).collect()]
    with duckdb.connect() as con:
        con.sql(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet/*.parquet'")
        answer = con.sql(entry.oracle_sql()["op2_pareto_mix"])
        expected = answer.select("doc_id, size, source_size, target, taken, copies, source").fetchall()
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
    assert len({row[5] for row in rows if row[0] is None and row[6] == "a"}) == 2, "rows without an id are drawn one by one"
