"""Every pattern of substitutions that leaves four fifths of a short item is found."""

from itertools import combinations

import duckdb

import __spark_entry__ as entry
from crossfeed.llm import decontam

WORDS = [f"word{chr(97 + i)}" for i in range(15)]


def texts(words, *counts):
    for count in counts:
        for places in combinations(range(len(words)), count):
            yield " ".join("other" + w if i in places else w for i, w in enumerate(words))


def test_all_patterns_of_short_items(spark):
    cases = [(1, t) for t in texts(WORDS, 2, 3)] + [(2, t.replace("word", "short")) for t in texts(WORDS[:10], 1, 2)]
    cases = [(i, f"before{i} {t} after{i}", item) for i, (item, t) in enumerate(cases)]
    docs = spark.createDataFrame(cases, "doc_id long, text string, item long")
    items = spark.createDataFrame([(1, " ".join(WORDS)), (2, " ".join(WORDS[:10]).replace("word", "short"))], "item_id long, text string")
    rows = decontam.overlaps(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == {(i, item) for i, _, item in cases}
    assert all(r["matched"] >= 0.8 * r["length"] and r["length"] >= (13 if r["item_id"] == 1 else 10) for r in rows)
    assert decontam.clean(docs, items).count() == 0


def test_fewer_than_four_fifths_are_not_found(spark):
    words = ["other" + w if i in (2, 6, 8, 12) else w for i, w in enumerate(WORDS)]
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(WORDS))], "item_id long, text string")
    assert decontam.overlaps(docs, items).count() == 0


def test_sql_finds_the_same_patterns(spark, tmp_path):
    cases = [(1, t) for t in texts(WORDS, 0, 2, 3)] + [(2, t.replace("word", "short")) for t in texts(WORDS[:10], 0, 1, 2, 3)]
    cases += [(3, "tiny a b c d e f"), (3, "tiny a b c x e f")]
    docs = [(i, f"before{i} {t} after{i}") for i, (_, t) in enumerate(cases)] + [(None, "x"), (9000, None), (9001, "")]
    items = [(1, " ".join(WORDS)), (2, " ".join(WORDS[:10]).replace("word", "short")), (3, "tiny a b c d e f"), (4, "a b c"), (5, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = entry.queries()["op7_benchmark_overlaps"](spark, str(tmp_path))
    with duckdb.connect() as con:
        for table in ("documents", "benchmark"):
            con.sql(f"CREATE VIEW {table} AS FROM '{tmp_path}/{table}.parquet/*.parquet'")
        expected = con.sql(entry.oracle_sql()["op7_benchmark_overlaps"]).fetchall()
    found = [tuple(row) for row in frame.collect()]
    assert sorted(found) == sorted(expected)
    assert [row[1] for row in sorted(found) if row[1] == 3] == [3], "a short item is found as it is and not otherwise"
    assert sum(row[1] == 1 for row in found) == 1 + 105 + 455
