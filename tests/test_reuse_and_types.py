"""Frames and views used more than once, types that hold every value, and rules that hold over every driver."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import crossfeed as cf
from crossfeed.functions import text
from crossfeed.functions.types import as_text
from crossfeed.operators import rows


@pytest.fixture(scope="module")
def other(tmp_path_factory):
    """A second DB-API driver, with a catalogue of its own."""
    duckdb = pytest.importorskip("duckdb")
    path = str(tmp_path_factory.mktemp("other") / "other.db")
    with duckdb.connect(path) as database:
        database.execute("CREATE TABLE held (id BIGINT, price DECIMAL(20, 2), day DATE, moment TIMESTAMP, word VARCHAR, real_ DOUBLE)")
        database.execute("INSERT INTO held VALUES (9007199254740993, 123456789012345678.25, '2024-02-29', "
                         "'2024-01-01 00:00:00', 'a', 1.5), (1, NULL, NULL, NULL, NULL, NULL)")
    cf.register_connection("second", f"dbapi:duckdb:{path}")
    return path


def test_one_frame_and_one_view_used_twice(spark, external):
    cf.ext_load(spark.range(10).selectExpr("id", "id * id AS v"), table_name="reused", connection=external, mode="overwrite")
    frame = cf.ext_scan(spark, table_name="reused", connection=external)
    assert (frame.filter("id = 3").count(), frame.count()) == (1, 10)
    assert frame.filter("id > 5").agg(F.sum("v")).first()[0] == 230 and frame.agg(F.sum("v")).first()[0] == 285
    assert sorted(r["id"] for r in frame.filter("id = 1").union(frame.filter("id = 2")).collect()) == [1, 2]
    assert frame.alias("a").join(frame.alias("b"), F.col("a.id") == F.col("b.v")).count() == 4
    cf.ext_attach(spark, connection=external, tables_like="reused", prefix="twice_", overwrite=True)
    assert spark.sql("SELECT id FROM twice_reused WHERE id = 1").count() == 1
    assert spark.sql("SELECT id FROM twice_reused").count() == 10


def test_a_sql_view_used_twice(spark, lite):
    from crossfeed import connections
    cf.ext_load(spark.range(10).selectExpr("id"), table_name="viewed_twice", connection="lite", mode="overwrite")
    database = connections.resolve("lite").target
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW vt USING crossfeed_dbapi OPTIONS (module 'sqlite3', "
              f"database '{database}', table 'viewed_twice')")
    assert spark.sql("SELECT id FROM vt WHERE id = 1").count() == 1 and spark.sql("SELECT id FROM vt").count() == 10
    spark.sql("CREATE OR REPLACE TEMPORARY VIEW vc USING crossfeed_dbapi OPTIONS (module 'sqlite3', "
              f"database '{database}', table 'viewed_twice', condition 'id > 6')")
    assert spark.sql("SELECT id FROM vc").count() == 3


def test_times_and_flags_are_compared_as_spark_reads_them(spark, lite):
    cf.ext_exec(spark, connection="lite", sql="CREATE TABLE plain (at TIMESTAMP, flag BOOLEAN)")
    cf.ext_exec(spark, connection="lite", sql="INSERT INTO plain VALUES ('2024-01-01 00:00:00', 2)")
    frame = cf.ext_scan(spark, table_name="plain", connection="lite")
    assert frame.filter("at = timestamp_ntz'2024-01-01 00:00:00'").count() == 1 and frame.filter("flag").count() == 1


def test_computed_columns_hold_every_value(spark, lite):
    cf.ext_exec(spark, connection="lite", sql="CREATE TABLE pair (id INTEGER, a INTEGER, whole INTEGER)")
    cf.ext_exec(spark, connection="lite", sql="INSERT INTO pair VALUES (1, 3, 1), (2, 3, 1.5)")
    mixed = cf.ext_query(spark, connection="lite", query="SELECT CASE WHEN id = 1 THEN 1 ELSE a / 2.0 END AS x FROM pair")
    assert sorted(r["x"] for r in mixed.collect()) == [1.0, 1.5]
    words = cf.ext_query(spark, connection="lite", query="SELECT CASE WHEN id = 1 THEN 1 ELSE 'b' END AS x FROM pair")
    assert sorted(r["x"] for r in words.collect()) == ["1", "b"]
    big = cf.ext_query(spark, connection="lite", query="SELECT CASE WHEN id = 1 THEN 9007199254740993 ELSE 0.5 END AS x FROM pair")
    assert sorted(r["x"] for r in big.collect()) == ["0.5", "9007199254740993"]
    with pytest.raises(Exception, match="no whole number"):
        cf.ext_scan(spark, table_name="pair", connection="lite").collect()


def test_types_of_another_driver(spark, other):
    frame = cf.ext_scan(spark, table_name="held", connection="second").orderBy(F.desc("id"))
    assert [kind for _, kind in frame.dtypes] == ["bigint", "decimal(20,2)", "date", "timestamp_ntz", "string", "double"]
    assert tuple(frame.first()) == (9007199254740993, Decimal("123456789012345678.25"), dt.date(2024, 2, 29),
                                    dt.datetime(2024, 1, 1), "a", 1.5)


def test_read_only_and_timeouts_of_another_driver(spark, other):
    with pytest.raises(cf.ExternalError, match="read-only"):
        cf.ext_exec(spark, connection="second", sql="CREATE TABLE made (id INTEGER)", read_only=True)
    with pytest.raises(cf.ExternalError, match="login timeout"):
        cf.ext_scan(spark, table_name="held", connection="second", timeout=5)
    cf.register_connection("prepared", f"dbapi:duckdb:{other}", session_init="SET null_order = 'nulls_first'")
    query = "SELECT current_setting('null_order') AS x"
    assert "first" in cf.ext_query(spark, connection="prepared", query=query).first()["x"].lower()


def test_a_query_may_end_in_a_comment(spark, external):
    cf.ext_load(spark.range(3), table_name="commented", connection=external, mode="overwrite")
    assert cf.ext_query(spark, connection=external, query='SELECT "id" FROM "commented" -- all').count() == 3


def test_partitions_of_skewed_and_fractional_keys(spark, derby):
    cf.ext_load(spark.range(60_000).selectExpr("id % 5 AS tenant", "id AS n", "id / 60000D AS share"),
                table_name="few_tenants", connection="derby", mode="overwrite", primary_key=("tenant", "n"))
    sizes = [r["count"] for r in cf.ext_scan(spark, table_name="few_tenants", connection="derby")
             .groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) >= 3 and max(sizes) <= 30_000, sizes
    shares = cf.ext_scan(spark, table_name="few_tenants", connection="derby", partition_column="share", num_partitions=8)
    sizes = [r["count"] for r in shares.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 60_000 and len(sizes) == 8 and max(sizes) <= 8_000, sizes


def test_synonyms_and_system_tables(spark, derby):
    cf.ext_load(spark.range(4), table_name="real_one", connection="derby", mode="overwrite")
    cf.ext_exec(spark, connection="derby", sql='CREATE SYNONYM "other_name" FOR "real_one"')
    assert cf.ext_scan(spark, table_name="other_name", connection="derby").count() == 4
    assert cf.ext_scan(spark, table_name="SYSSCHEMAS", connection="derby", schema_name="SYS").count() > 3


def test_attach_beside_an_odd_name(spark, external):
    for name in ("two words", "one_word"):
        cf.ext_load(spark.range(2), table_name=name, connection=external, mode="overwrite")
    report = cf.ext_attach(spark, connection=external, tables_like=["two words", "one\\_word"], prefix=f"odd {external} ")
    assert {r["status"] for r in report.collect()} == {"attached"} and spark.table(f"`odd {external} two words`").count() == 2
    with pytest.raises(cf.ExternalError, match="already exists"):
        cf.ext_attach(spark, connection=external, tables_like="two words", prefix=f"odd {external} ")


def test_widths_and_schemas_of_loads(spark, derby):
    five = "😀" * 5
    cf.ext_load(spark.createDataFrame([(five,)], "word string"), table_name="smiles", connection="derby", mode="overwrite")
    assert cf.ext_scan(spark, table_name="smiles", connection="derby").first()["word"] == five
    cf.ext_exec(spark, connection="derby", sql='CREATE SCHEMA "ELSEWHERE"')
    cf.ext_exec(spark, connection="derby", sql='CREATE TABLE "ELSEWHERE"."only_there" ("id" BIGINT)')
    assert cf.ext_load(spark.range(3), table_name="only_there", connection="derby").rows == 3
    assert cf.ext_load(spark.range(5), table_name="only_there", connection="derby", schema_name="ELSEWHERE").rows == 5
    assert cf.ext_load(spark.range(2), table_name="only_there", connection="derby", schema_name="ELSEWHERE", mode="overwrite").rows == 2
    count = lambda space: cf.ext_scan(spark, table_name="only_there", connection="derby", schema_name=space).count()
    assert count("ELSEWHERE") == 2 and count("APP") == 3


def test_text_format_is_that_of_c(spark):
    values = [0.0078125, 0.0000005, 0.1234565, 1e23, 0.5, -0.0000005, 1.0000015, 2.5e-7, 123456789.0625, 1e9 + 0.0000005, 0.0, -0.0,
              9007199254740993.0, 1.7976931348623157e308, 4.35, 1e-320]
    frame = spark.createDataFrame([(v,) for v in values], "v double").select("v", as_text(F.col("v"), T.DoubleType()).alias("t"))
    for row in frame.collect():
        assert row["t"] == "%f" % row["v"]


@pytest.mark.parametrize("name, sample", [("KOI8-R", "Лодка"), ("866", "Лодка"), ("EUC-JP", "雨が"), ("GB18030", "今天"),
                                          ("UTF-16LE", "plain"), ("cp037", "plain"), ("cp1251", "Берег")])
def test_more_encodings(spark, name, sample):
    frame = spark.createDataFrame([(sample,), ("ascii only",), (None,)], "t string")
    raw = frame.select("t", text.encode_text(F.col("t"), name).alias("b"))
    for row in raw.select("t", "b", text.decode_text(F.col("b"), name).alias("back")).collect():
        assert row["back"] == row["t"] and (row["t"] is None or bytes(row["b"]) == row["t"].encode(text.charset(name)))


def test_skip_without_a_full_sort(spark):
    frame = spark.range(0, 10_000, 1, 8).select((F.col("id") * 7919 % 10_007).alias("k"))
    part = rows.skip_rows(frame, ["k"], 100, 5)
    assert "TakeOrderedAndProject" in part._jdf.queryExecution().executedPlan().toString()
    expected = sorted(r["k"] for r in frame.collect())[100:105]
    assert [r["k"] for r in part.collect()] == expected
