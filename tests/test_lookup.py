"""Rows read by the keys of a relation: only those that match, the same join as over the whole table."""

import datetime as dt
from decimal import Decimal

import pytest

import crossfeed as cf
from crossfeed.admin import scratch_name
from crossfeed.sources import lookup


@pytest.fixture
def table(spark, external):
    rows = [(n, Decimal(n) / 4, f"k{n % 50}", dt.date(2024, 1, 1) + dt.timedelta(n % 90), float(n % 7)) for n in range(3000)]
    frame = spark.createDataFrame(rows, "n long, m decimal(9,2), s string, d date, f double")
    name = scratch_name("lookup")
    cf.ext_load(frame, table_name=name, connection=external)
    return name, external, frame


def joined(frame, relation, on, how="inner"):
    return sorted(map(repr, relation.join(frame, on, how).select("tag", *frame.columns).collect()))


@pytest.mark.parametrize("on, values", [
    ("n", [5, 5, 17, 2999, 40_000, None]), ("m", [Decimal("1.25"), Decimal("700.00"), Decimal("0.10")]),
    ("s", ["k3", "K3", "k3 ", "it's", None]), ("d", [dt.date(2024, 1, 5), dt.date(1999, 1, 1)]), ("f", [3.0, 0.1])])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_as_a_join_with_all_rows(spark, table, on, values, how):
    name, connection, frame = table
    relation = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"{on} {frame.schema[on].dataType.simpleString()}, tag int")
    found = cf.ext_lookup(relation, on=on, table_name=name, connection=connection, how=how)
    assert sorted(map(repr, found.select("tag", *frame.columns).collect())) == joined(frame, relation, on, how)


def test_rows_read_follow_the_relation(spark, table):
    name, connection, _ = table
    for wanted in (0, 1, 1200):
        relation = spark.range(wanted).withColumnRenamed("id", "n")
        read = lookup.matching_rows(relation, on="n", table_name=name, connection=connection)
        assert read.count() == wanted
        assert read.rdd.getNumPartitions() == max(1, -(-wanted // lookup.KEYS_PER_STATEMENT))
    relation = spark.createDataFrame([("k3",)], "s string")
    cut = lookup.matching_rows(relation, on="s", table_name=name, connection=connection, splits=['"n" < 1000', '"n" >= 1000'])
    assert (cut.count(), cut.rdd.getNumPartitions()) == (60, 2)


def test_too_many_keys_scan_the_table(spark, table):
    name, connection, frame = table
    relation = spark.range(30).withColumnRenamed("id", "n").selectExpr("n", "n AS tag")
    read = lookup.matching_rows(relation, on="n", table_name=name, connection=connection, max_keys=29)
    assert read.count() == 3000
    found = cf.ext_lookup(relation, on="n", table_name=name, connection=connection, max_keys=29)
    assert sorted(map(repr, found.select("tag", *frame.columns).collect())) == joined(frame, relation, "n")


def test_another_name_and_texts_that_the_database_takes_for_one(spark, lite):
    name = scratch_name("nocase")
    cf.ext_exec(spark, connection=lite, sql=f'CREATE TABLE "{name}" (word TEXT COLLATE NOCASE, n INTEGER)')
    cf.ext_exec(spark, connection=lite, sql=f"INSERT INTO \"{name}\" VALUES ('a', 1), ('A', 2), ('b', 3)")
    relation = spark.createDataFrame([("a",), ("A",)], "w string")
    found = cf.ext_lookup(relation, on="w", key="word", table_name=name, connection=lite)
    assert sorted(map(tuple, found.collect())) == [("A", "A", 2), ("a", "a", 1)]


def test_keys_of_another_kind(spark, lite):
    name = scratch_name("kinds")
    cf.ext_exec(spark, connection=lite, sql=f'CREATE TABLE "{name}" (n TEXT)')
    cf.ext_exec(spark, connection=lite, sql=f"INSERT INTO \"{name}\" VALUES ('5'), ('05'), ('6')")
    found = cf.ext_lookup(spark.createDataFrame([(5, 1)], "n long, tag int"), on="n", table_name=name, connection=lite)
    assert found.count() == 2


def test_errors(spark, lite):
    for options in ({"on": "x"}, {"on": "id", "how": "cross"}, {}):
        with pytest.raises(cf.ExternalError):
            cf.ext_lookup(spark.range(1), table_name="t", connection=lite, **options)


def test_a_whole_table_is_read_by_the_splits(spark, table):
    """More keys than are sent, and a table without a key of its own: not through one connection."""
    name, connection, frame = table
    relation = spark.range(100).withColumnRenamed("id", "n")
    splits = ['"n" < 1000', '"n" >= 1000 AND "n" < 2000', '"n" >= 2000']
    for options in ({"max_keys": 10}, {"max_keys": 200}):
        found = lookup.matching_rows(relation, on="n", table_name=name, connection=connection, splits=splits, **options)
        assert found.rdd.getNumPartitions() == 3
        assert joined(found, relation.withColumn("tag", relation["n"]), "n") == joined(
            frame, relation.withColumn("tag", relation["n"]), "n")
