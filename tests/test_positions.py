"""Rows by position, found by counting: any place, ties, NULLs, and what the plans do."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from crossfeed.operators import rows


@pytest.fixture
def counting(monkeypatch):
    """Nothing is small: every position is found by counting, with few keys a pass."""
    monkeypatch.setattr(rows, "KEPT_ROWS", 0)
    monkeypatch.setattr(rows, "PIVOTS", 5)
    monkeypatch.setattr(rows, "SAMPLED_KEYS", 20)
    monkeypatch.setattr(rows, "SORTED_ROWS", 30)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_kind_of_key(spark, counting):
    rng = random.Random(4)
    made = [(rng.choice([None, 1.5, -2.0, float("nan"), float("inf")]), rng.choice([None, "a", "ß", "B", ""]),
             rng.choice([None, Decimal("1.10"), Decimal("-3.00")]), rng.choice([None, dt.date(2024, 1, 1), dt.date(1, 1, 1)]),
             rng.choice([None, dt.datetime(2024, 3, 31, 2, 30), dt.datetime(1969, 1, 1, 1, 1, 1, 5)]),
             rng.choice([None, b"", b"\x00\xff"]), n) for n in range(700)]
    frame = spark.createDataFrame(made, "d double, s string, m decimal(9,2), day date, ts timestamp, raw binary, n int").repartition(5).cache()
    for order in (["d", "n"], ["s", "m", "n"], ["day", "ts", "raw", "n"], ["ts", "d", "s", "n"]):
        sorted_rows = frame.orderBy(*order).collect()
        for position in (1, 2, 350, 699, 700):
            found = rows.row_at(frame, order, position).collect()
            assert [repr(tuple(row)) for row in found] == [repr((*sorted_rows[position - 1], position))], (order, position)
    assert rows.row_at(frame, ["n"], 0).collect() == [] == rows.row_at(frame, ["n"], 701).collect()
    assert rows.row_at(frame.limit(0), ["n"], 1).collect() == []


@pytest.mark.parametrize("skip, take", [(0, 10), (5, 1), (100, None), (399, 300), (0, None), (1200, 5), (640, 200), (3, 0), (1000, 1000)])
def test_skipping_over_equal_rows(spark, counting, skip, take):
    """Half of all rows agree in the order, a third in everything."""
    frame = spark.range(1200).selectExpr("IF(id % 2 = 0, 7, id) AS k", "IF(id % 6 < 3, 0, id) AS n", "NULL AS e").repartition(4)
    everything = sorted(map(tuple, frame.select("k", F.xxhash64("k", "n", "e").alias("h"), "n").collect()))
    expected = [(k, n) for k, _, n in everything][skip:None if take is None else skip + take]
    found = [(row["k"], row["n"]) for row in rows.skip_rows(frame, ["k"], skip, take).collect()]
    assert sorted(found) == sorted(expected)


def test_a_position_in_the_middle_shuffles_no_row(spark, monkeypatch):
    frame = spark.range(400_000).selectExpr("(id * 7919) % 400000 AS k", "id AS n", "repeat('x', 20) AS wide")
    middle = rows.row_at(frame, ["k"], 200_001)
    assert middle.first()["k"] == 200_000
    page = rows.skip_rows(frame, ["k"], 150_000, 120_000)
    assert page.agg(F.count("*"), F.min("k"), F.max("k")).first()[:] == (120_000, 150_000, 269_999)
    for frame in (middle, page):
        plan = plan_of(frame)
        assert "Exchange rangepartitioning" not in plan and "TakeOrdered" not in plan and "Sort" not in plan
    assert "Exchange" not in plan_of(page)


def test_the_top_is_kept_only_where_all_tasks_keep_little(spark):
    frame = spark.range(0, 100_000, 1, 50).selectExpr("id AS k")
    assert "TakeOrdered" in plan_of(rows.skip_rows(frame, ["k"], 900, 100))
    assert "TakeOrdered" not in plan_of(rows.skip_rows(frame, ["k"], 60_000, 10_000))
