import random

import pytest
from pyspark.sql import functions as F

import crossfeed as cf
from crossfeed.errors import ExternalError
from crossfeed.operators import profile, rows
from crossfeed.operators.relations import join_relation_parameter, measured_size, one_sided_join_count, small_side


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows has the same first order value; a few are NULL."""
    dice = random.Random(7)
    data = [(n, 50 if n % 3 == 0 else None if n % 50 == 1 else dice.randrange(1000), f"w{n % 11}") for n in range(3000)]
    return data, spark.createDataFrame(data, "id int, k int, word string").repartition(6).cache()


def in_order(data):
    return sorted(data, key=lambda row: (row[1] is not None, row[1] if row[1] is not None else 0, row[0]))


def test_positions(skewed):
    data, frame = skewed
    placed = rows.with_position(frame, ["k", "id"])
    assert [row["id"] for row in placed.orderBy("position").collect()] == [row[0] for row in in_order(data)]
    assert [row["position"] for row in placed.orderBy("position").select("position").collect()] == list(range(1, 3001))


def test_a_hot_value_is_spread_over_partitions(skewed):
    _, frame = skewed
    numbered = rows._numbered(frame, ["k", "id"], 8)
    sizes = [row["count"] for row in numbered.groupBy("cf_part").count().collect()]
    assert len(sizes) >= 7 and max(sizes) < 900
    assert numbered.filter("k = 50").select("cf_part").distinct().count() >= 2


def test_rows_the_order_does_not_tell_apart_are_spread_too(skewed):
    _, frame = skewed
    numbered = rows._numbered(frame, ["k"], 8)
    sizes = [row["count"] for row in numbered.groupBy("cf_part").count().collect()]
    assert max(sizes) < 900
    first, second = ([(row["id"], row["position"]) for row in rows.with_position(frame, ["k"]).orderBy("position").collect()]
                     for _ in range(2))
    assert first == second and [place for _, place in first] == list(range(1, 3001))


def test_row_at_skip_and_prior(skewed):
    data, frame = skewed
    ordered = in_order(data)
    assert rows.row_at(frame, ["k", "id"], 1234).first()["id"] == ordered[1233][0]
    assert rows.row_at(frame, ["k", "id"], 3001).count() == 0
    assert rows.row_at(frame, ["k"], 1500).count() == 1 and rows.skip_rows(frame, ["k"], 1500, 10).count() == 10
    assert rows.row_at(frame.select("k", "id"), ["k", "id"], 5).first()["id"] == ordered[4][0]
    kept = rows.skip_rows(frame, ["k", "id"], 995, 20).collect()
    assert sorted(row["id"] for row in kept) == sorted(row[0] for row in ordered[995:1015])
    assert rows.skip_rows(frame, ["k", "id"], 2990).count() == 10
    prior = {row["id"]: (row["prior_id"], row["prior_k"]) for row in
             rows.prior_row(frame, ["k", "id"], ["id", "k"]).collect()}
    wanted = {now[0]: (before[0], before[1]) for before, now in zip(ordered, ordered[1:])}
    wanted[ordered[0][0]] = (None, None)
    assert prior == wanted


def test_first_and_last(skewed):
    data, frame = skewed
    ordered = in_order(data)
    assert rows.first_row(frame, ["k", "id"]).first()["id"] == ordered[0][0]
    assert rows.last_row(frame, ["k", "id"]).first()["id"] == ordered[-1][0]
    ends = rows.first_last_per_group(frame, ["word"], ["id"], ["id", "k"]).collect()
    for row in ends:
        mine = [one for one in data if one[2] == row["word"]]
        assert (row["first_id"], row["first_k"], row["last_id"], row["last_k"]) == (*mine[0][:2], *mine[-1][:2])


def test_nulls(skewed):
    data, frame = skewed
    assert frame.select(rows.with_fallback(F.col("k"), -1).alias("k")).filter("k = -1").count() == sum(
        row[1] is None for row in data)
    assert rows.null_test(frame, ["k"]).filter("k_is_null").count() == sum(row[1] is None for row in data)


def test_small_sides_are_measured(spark):
    small, large = spark.range(10).toDF("k"), spark.range(1000).toDF("k")
    assert measured_size(small)[0] == 10 and measured_size(large, row_limit=99)[0] == 100
    big_text = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("k"))
    assert measured_size(big_text)[1] > 3000
    hint = "ResolvedHint"
    marked = [small_side(frame, row_limit=99)._jdf.queryExecution().analyzed().toString() for frame in (small, large)]
    assert hint in marked[0] and hint not in marked[1]
    assert hint not in small_side(big_text, byte_limit=100)._jdf.queryExecution().analyzed().toString()
    assert join_relation_parameter(large, small, ["k"]).count() == 10


def test_one_sided_join_count(spark):
    left, right = spark.range(20).toDF("a"), spark.range(30).toDF("b")
    test = (F.col("a") < 5, F.col("b") >= 27)
    assert one_sided_join_count(left, test[0], right, test[1]).first()["n"] == 15
    assert one_sided_join_count(left, F.col("a") < 0, right, test[1]).first()["n"] == 0


def test_profile(spark):
    frame = spark.createDataFrame([(1, "a", 1.5, None, b"\x01"), (2, None, 1.5, None, b"\x01"), (10, "ccc", -0.0, None, None),
                                   (None, "a", 0.0, None, b"\x02")], "n int, word string, x double, gone date, raw binary")
    for exact in (True, False):
        found = {row["column_name"]: row for row in profile.profile_columns(frame, exact=exact).collect()}
        assert [found[name]["n_null"] for name in frame.columns] == [1, 1, 0, 4, 1]
        assert [found[name]["n_distinct"] for name in frame.columns] == [3, 2, 2, 0, 2]
        assert (found["n"]["min_value"], found["n"]["max_value"], found["n"]["max_length"]) == ("1", "10", 2)
        assert (found["word"]["min_value"], found["word"]["max_value"], found["word"]["max_length"]) == ("a", "ccc", 3)
        assert found["x"]["max_value"] == "1.500000" and found["gone"]["min_value"] is None


def test_checks(spark):
    frame = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 3)], "a int, b int")
    assert sorted(tuple(r) for r in profile.check_key(frame, ["a", "b"]).collect() if r["a"]) == [(1, 2, 2)]
    assert profile.check_key(frame, ["a", "b"]).filter("a IS NULL").first()["n"] == 1
    assert [tuple(r) for r in profile.check_not_null(frame, ["a", "b"]).collect()] == [("a", 1), ("b", 0)]
    with pytest.raises(ExternalError, match="Column 'c'"):
        profile.check_key(frame, ["c"])


def test_declared_constraints(spark, external):
    cf.ext_exec(spark, connection=external, sql='CREATE TABLE "declared" ("a" BIGINT NOT NULL, "b" BIGINT NOT NULL, '
                '"c" VARCHAR(9), "d" INTEGER NOT NULL, PRIMARY KEY ("a", "b"))')
    cf.ext_load(spark.range(30).selectExpr("id % 3 AS a", "id AS b", "'x' AS c", "1 AS d"), table_name="declared",
                connection=external)
    found = profile.check_constraints(spark, connection=external, table_name="declared").collect()
    assert sorted(tuple(row) for row in found) == [("not null", "a", 0), ("not null", "b", 0), ("not null", "d", 0),
                                                   ("primary key", "a, b", 0)]
    cf.ext_load(spark.range(3).selectExpr("nullif(id, 1) AS id"), table_name="undeclared", connection=external,
                mode="overwrite")
    assert profile.check_constraints(spark, connection=external, table_name="undeclared").count() == 0


def test_profile_of_external_tables(spark, external):
    cf.ext_load(spark.range(5).toDF("id"), table_name="profiled", connection=external, mode="overwrite")
    found = profile.profile_tables(spark, connection=external, tables_like="profiled")
    assert [tuple(row) for row in found.collect()] == [("profiled", "TABLE", 5)]
    assert profile.profile_tables(spark, connection=external, tables_like="nothing%").count() == 0


def test_positions_beyond_what_tasks_keep(spark, monkeypatch):
    """Deep positions take the range-partitioned way and give the same rows."""
    frame = spark.range(0, 3000, 1, 6).select((F.col("id") * 7919 % 3001).alias("k"), F.col("id").cast("string").alias("s"))
    near = (rows.row_at(frame, ["k"], 700).first(), rows.skip_rows(frame, ["k"], 700, 3).collect())
    monkeypatch.setattr(rows, "KEPT_ROWS", 0)
    assert (rows.row_at(frame, ["k"], 700).first(), rows.skip_rows(frame, ["k"], 700, 3).collect()) == near


def test_prior_rows_move_on_without_a_second_shuffle(spark):
    frame = spark.range(0, 500, 1, 5).select((F.col("id") * 31 % 501).alias("k"), F.array("id").alias("a"),
                                             F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).alias("s"))
    made = rows.prior_row(frame, ["k"], ["a", "s"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(cf_part" not in plan.split("BroadcastExchange")[0]
    ordered = sorted(frame.collect(), key=lambda r: r["k"])
    expected = {b["k"]: (a["a"], a["s"]) if a else (None, None) for a, b in zip([None, *ordered], ordered)}
    assert {r["k"]: (r["prior_a"], r["prior_s"]) for r in made.collect()} == expected
