"""Queries that load data into the external database and read it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from crossfeed.admin import scratch_name
from crossfeed.errors import ExternalError
from crossfeed.fixtures import balanced_cuts, read_parquet, source, target
from crossfeed.operators.relations import join_relation_parameter
from crossfeed.plans.registry import query
from crossfeed.plans.scans import scan
from crossfeed.sinks.load import ext_exec, ext_load, text_widths
from crossfeed.sources.lookup import ext_lookup
from crossfeed.sources.scan import ext_query, ext_scan


def loaded(spark, sf_dir, frame, base: str, **options):
    """``frame`` through a new external table and back."""
    connection, table = target(spark, sf_dir), scratch_name(base)
    ext_load(frame, table_name=table, connection=connection, **options)
    return ext_scan(spark, table_name=table, connection=connection, partition_column=frame.columns[0])


@query("load_roundtrip", "select p_partkey, p_name, p_size, p_retailprice from part where p_size <> 7 "
                         "union all select -1, 'added by statement', 0, 0.5")
def load_roundtrip(spark, sf_dir):
    """A table made by a statement, filled by a distributed load between two more statements."""
    connection, table = target(spark, sf_dir), scratch_name("parts")
    ext_exec(spark, connection=connection,
             sql=f'CREATE TABLE "{table}" ("p_partkey" BIGINT, "p_name" VARCHAR(64), "p_size" INTEGER, '
                 '"p_retailprice" DOUBLE PRECISION)')
    ext_load(read_parquet(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice"),
             table_name=table, connection=connection, stable_input=True,
             pre_sql=(f'INSERT INTO "{table}" VALUES (-1, \'added by statement\', 0, 0.5)',),
             post_sql=(f'DELETE FROM "{table}" WHERE "p_size" = 7',))
    return ext_scan(spark, table_name=table, connection=connection, partition_column="p_partkey")


@query("load_overwrite", "select * from part")
def load_overwrite(spark, sf_dir):
    """The first load has other columns; the second one replaces the table."""
    connection, table = target(spark, sf_dir), scratch_name("replaced")
    ext_load(read_parquet(spark, sf_dir, "supplier"), table_name=table, connection=connection, stable_input=True)
    ext_load(read_parquet(spark, sf_dir, "part"), table_name=table, connection=connection, mode="overwrite",
             stable_input=True)
    return ext_scan(spark, table_name=table, connection=connection, partition_column="p_partkey")


@query("load_append", "select * from part")
def load_append(spark, sf_dir):
    connection, table = target(spark, sf_dir), scratch_name("appended")
    parts = read_parquet(spark, sf_dir, "part")
    types = {"p_name": "VARCHAR(64)", "p_brand": "VARCHAR(64)", "p_type": "VARCHAR(64)"}
    for half in (parts.filter("p_size < 25"), parts.filter("p_size >= 25")):
        ext_load(half, table_name=table, connection=connection, mode="append", batch_size=1000, stable_input=True,
                 column_types=types)
    return ext_scan(spark, table_name=table, connection=connection, partition_column="p_partkey")


@query("load_atomic", "select p_partkey, p_name from part")
def load_atomic(spark, sf_dir):
    """A load that fails in its last step leaves the table as it was."""
    connection, table = target(spark, sf_dir), scratch_name("swapped")
    parts = read_parquet(spark, sf_dir, "part").select("p_partkey", "p_name")
    ext_load(parts, table_name=table, connection=connection, stable_input=True)
    try:
        ext_load(parts.withColumn("p_name", F.upper("p_name")), table_name=table, connection=connection,
                 mode="overwrite", post_sql=('DELETE FROM "cf_no_such_table"',), stable_input=True)
    except ExternalError:
        pass
    else:
        raise AssertionError("a load with a failing last statement went through")
    return ext_scan(spark, table_name=table, connection=connection, partition_column="p_partkey")


@query("load_typed", """
    select p_partkey, cast(p_size > 25 as integer) as flag, cast(p_size as integer) as tiny,
    cast(p_size * 100 as integer) as small, cast(cast(p_retailprice as float) as double) as single,
    cast(p_retailprice as decimal(18, 2)) as price, cast('2024-02-29' as date) as day from part""")
def load_typed(spark, sf_dir):
    frame = read_parquet(spark, sf_dir, "part").select(
        "p_partkey", (F.col("p_size") > 25).alias("flag"), F.col("p_size").cast("tinyint").alias("tiny"),
        (F.col("p_size") * 100).cast("smallint").alias("small"), F.col("p_retailprice").cast("float").alias("single"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("price"), F.lit("2024-02-29").cast("date").alias("day"))
    return loaded(spark, sf_dir, frame, "typed", stable_input=True)


@query("load_null_sentry", "select o_orderkey, nullif(o_orderstatus, 'P') as o_orderstatus, "
                           "nullif(o_custkey, 5) as o_custkey from orders")
def load_null_sentry(spark, sf_dir):
    frame = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    return loaded(spark, sf_dir, frame, "sentry", null_sentries={"o_orderstatus": "P", "o_custkey": 5},
                  stable_input=True)


@query("load_null_flags", "select o_orderkey, case when not o_totalprice > 250000 then o_orderpriority end as "
                          "o_orderpriority from orders")
def load_null_flags(spark, sf_dir):
    frame = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority",
                                                         (F.col("o_totalprice") > 250000).alias("hidden"))
    return loaded(spark, sf_dir, frame, "flags", null_flags={"o_orderpriority": "hidden"}, stable_input=True)


@query("load_all_null", "select s_suppkey, s_name, cast(null as varchar) as note, cast(null as bigint) as amount "
                        "from supplier")
def load_all_null(spark, sf_dir):
    frame = read_parquet(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.lit(None).cast("string").alias("note"), F.lit(None).cast("bigint").alias("amount"))
    return loaded(spark, sf_dir, frame, "empty", stable_input=True)


@query("load_string_width", "select 'p_name' as column_name, max(length(p_name)) as width from part "
                            "union all select 'p_brand', max(length(p_brand)) from part "
                            "union all select 'p_type', max(length(p_type)) from part")
def load_string_width(spark, sf_dir):
    """Text columns as wide as their longest value, found in one pass; a wider value would not fit the new table."""
    parts = read_parquet(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    widths = text_widths(parts)
    stored = loaded(spark, sf_dir, parts, "widths", stable_input=True,
                    column_types={name: f"VARCHAR({width})" for name, width in widths.items()})
    longest = stored.agg(*[F.max(F.length(name)).alias(name) for name in widths])
    return longest.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("bigint").alias("width")) for name in widths])))


@query("load_binary", "select s_suppkey, hex(encode(s_name)) as name_hex from supplier")
def load_binary(spark, sf_dir):
    frame = read_parquet(spark, sf_dir, "supplier").select("s_suppkey", F.encode("s_name", "UTF-8").alias("raw"))
    stored = loaded(spark, sf_dir, frame, "bytes", stable_input=True)
    return stored.select("s_suppkey", F.hex("raw").alias("name_hex"))


@query("load_row_count", "select count(*) as written, count(*) as held from orders")
def load_row_count(spark, sf_dir):
    """The number of rows a load reports, beside the number the database then holds."""
    connection, table = target(spark, sf_dir), scratch_name("counted")
    frame = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    result = ext_load(frame, table_name=table, connection=connection, stable_input=True)
    held = ext_query(spark, connection=connection, query=f'SELECT COUNT(*) AS n FROM "{table}"', column_names=["held"])
    return held.select(F.lit(result.rows).cast("bigint").alias("written"), F.col("held").cast("bigint").alias("held"))


@query("relation_param_join", "select l_partkey, l_orderkey, l_quantity, p_retailprice from lineitem "
                              "join part on l_partkey = p_partkey")
def relation_param_join(spark, sf_dir):
    """A relation given as a parameter: a price list, joined to the external rows it prices."""
    prices = read_parquet(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice")
    lines = scan(spark, sf_dir, "lineitem", ["l_partkey", "l_orderkey", "l_quantity"])
    return join_relation_parameter(lines, prices, ["l_partkey"])


@query("relation_lookup", "select p_partkey, p_retailprice, l_orderkey, l_quantity from part join lineitem "
                          "on l_partkey = p_partkey where p_size <= 2")
def relation_lookup(spark, sf_dir):
    """The small parts' prices, joined to external rows that are read by their keys."""
    prices = read_parquet(spark, sf_dir, "part").filter("p_size <= 2").select("p_partkey", "p_retailprice")
    found = ext_lookup(prices, on="p_partkey", key="l_partkey", table_name="lineitem", stable_input=True,
                       connection=source(spark, sf_dir, "lineitem"), columns=["l_partkey", "l_orderkey", "l_quantity"],
                       splits=balanced_cuts(spark, sf_dir, "lineitem"))
    return found.select("p_partkey", "p_retailprice", "l_orderkey", "l_quantity")
