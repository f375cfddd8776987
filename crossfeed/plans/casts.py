"""Queries over the value conversions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.fixtures import read_parquet
from crossfeed.functions import types
from crossfeed.plans.loads import loaded
from crossfeed.plans.registry import query
from crossfeed.plans.scans import scan


@query("cast_boolean", "select l_orderkey, l_linenumber, (l_linenumber - 1) <> 0 as later from lineitem")
def cast_boolean(spark, sf_dir):
    return scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", types.as_boolean(F.col("l_linenumber") - 1).alias("later"))


@query("cast_integers", "select cast(p_partkey as integer) as part, cast(p_size as smallint) as small, "
                        "cast(p_size as tinyint) as tiny, try_cast(p_size * 10 as tinyint) as tiny_or_null from part")
def cast_integers(spark, sf_dir):
    size = F.col("p_size")
    return scan(spark, sf_dir, "part", ["p_partkey", "p_size"]).select(
        types.as_integer(F.col("p_partkey"), "int").alias("part"), types.as_integer(size, "smallint").alias("small"),
        types.as_integer(size, "tinyint").alias("tiny"),
        types.as_integer(size * 10, "tinyint", strict=False).alias("tiny_or_null"))


@query("cast_text_to_number", "select p_partkey, cast(substr(p_brand, 7) as integer) as brand, "
                              "cast(null as integer) as not_a_number from part")
def cast_text_to_number(spark, sf_dir):
    return scan(spark, sf_dir, "part", ["p_partkey", "p_brand"]).select(
        "p_partkey", types.as_integer(F.substring("p_brand", 7, 10), "int").alias("brand"),
        types.as_integer(F.col("p_brand"), "int", strict=False).alias("not_a_number"))


@query("cast_floats", "select l_orderkey, cast(cast(l_extendedprice as float) as double) as single, "
                      "cast(l_linenumber as double) as line from lineitem")
def cast_floats(spark, sf_dir):
    return scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_linenumber"]).select(
        "l_orderkey", types.as_real(F.col("l_extendedprice"), "float").cast("double").alias("single"),
        types.as_real(F.col("l_linenumber")).alias("line"))


@query("cast_decimal", "select l_orderkey, cast(l_extendedprice as decimal(12, 2)) as price, "
                       "cast(l_quantity as decimal(38, 10)) as quantity from lineitem")
def cast_decimal(spark, sf_dir):
    return scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice", "l_quantity"]).select(
        "l_orderkey", types.as_decimal(F.col("l_extendedprice"), 12, 2).alias("price"),
        types.as_decimal(F.col("l_quantity"), 38, 10).alias("quantity"))


@query("cast_date", "select event_id, cast(ts as date) as day from events")
def cast_date(spark, sf_dir):
    return scan(spark, sf_dir, "events", ["event_id", "ts"]).select("event_id", types.as_date(F.col("ts")).alias("day"))


@query("cast_time", "select event_id, strftime(ts, '%H:%M:%S') as time_of_day from events")
def cast_time(spark, sf_dir):
    return scan(spark, sf_dir, "events", ["event_id", "ts"]).select(
        "event_id", types.as_time(F.col("ts")).alias("time_of_day"))


@query("cast_timestamp", "select event_id, ts, cast(cast(ts as date) as timestamp) as midnight from events")
def cast_timestamp(spark, sf_dir):
    return scan(spark, sf_dir, "events", ["event_id", "ts"]).select(
        "event_id", types.as_timestamp(F.col("ts")).alias("ts"),
        types.as_timestamp(types.as_date(F.col("ts"))).alias("midnight"))


@query("cast_uuid", """
    with made as (select event_id, upper(md5(cast(event_id as varchar))) as h from events)
    select event_id, case when event_id % 10 <> 3 then lower(substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' ||
    substr(h, 13, 4) || '-' || substr(h, 17, 4) || '-' || substr(h, 21)) end as id from made""")
def cast_uuid(spark, sf_dir):
    """Upper-case UUID text with some broken values, through the database."""
    digits = F.upper(F.md5(F.col("event_id").cast("string")))
    whole = F.concat_ws("-", F.substring(digits, 1, 8), F.substring(digits, 9, 4), F.substring(digits, 13, 4),
                        F.substring(digits, 17, 4), F.substring(digits, 21, 12))
    made = F.when(F.col("event_id") % 10 == 3, F.concat(whole, F.lit("x"))).otherwise(whole)
    stored = loaded(spark, sf_dir, read_parquet(spark, sf_dir, "events").select("event_id", made.alias("id")), "uuids",
                    column_types={"id": "VARCHAR(40)"}, stable_input=True)
    return stored.select("event_id", types.as_uuid(F.col("id")).alias("id"))


@query("cast_binary", "select s_suppkey, hex(encode(s_name)) as name_hex, octet_length(encode(s_name)) as size "
                      "from supplier")
def cast_binary(spark, sf_dir):
    raw = types.as_binary(F.col("s_name"))
    return scan(spark, sf_dir, "supplier", ["s_suppkey", "s_name"]).select(
        "s_suppkey", F.hex(raw).alias("name_hex"), F.octet_length(raw).cast("bigint").alias("size"))


@query("text_format_all", """
    select o_orderkey, cast(o_orderkey as varchar) as whole, printf('%.6f', o_totalprice) as real_number,
    cast(cast(o_totalprice as decimal(12, 2)) as varchar) as exact_number,
    case when o_totalprice > 250000 then '1' else '0' end as flag, strftime(o_orderdate, '%Y-%m-%d') as day,
    strftime(o_orderdate, '%H:%M:%S') as time_of_day,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' +0000' as moment, o_orderpriority as words,
    o_orderstatus as raw from orders""")
def text_format_all(spark, sf_dir):
    price, moment = F.col("o_totalprice"), F.col("o_orderdate")
    return scan(spark, sf_dir, "orders").select(
        "o_orderkey", types.as_text(F.col("o_orderkey"), T.LongType()).alias("whole"),
        types.as_text(price, T.DoubleType()).alias("real_number"),
        types.as_text(types.as_decimal(price, 12, 2), T.DecimalType(12, 2)).alias("exact_number"),
        types.as_text(price > 250000, T.BooleanType()).alias("flag"),
        types.as_text(types.as_date(moment), T.DateType()).alias("day"), types.as_time(moment).alias("time_of_day"),
        types.as_text(moment, T.TimestampNTZType()).alias("moment"),
        types.as_text(F.col("o_orderpriority"), T.StringType()).alias("words"),
        types.as_text(types.as_binary(F.col("o_orderstatus")), T.BinaryType()).alias("raw"))
