"""Queries over row access, profiles and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from crossfeed.fixtures import read_parquet, source
from crossfeed.operators import profile, rows
from crossfeed.plans.loads import loaded
from crossfeed.plans.registry import query
from crossfeed.plans.scans import scan


@query("first_last_row", """
    select user_id, first(event_type order by ts, event_id) as first_event_type, first(ts order by ts, event_id)
    as first_ts, last(event_type order by ts, event_id) as last_event_type, last(ts order by ts, event_id) as last_ts
    from events group by user_id""")
def first_last_row(spark, sf_dir):
    return rows.first_last_per_group(scan(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"]),
                                     ["user_id"], ["ts", "event_id"], ["event_type", "ts"])


@query("first_and_last", "(select 'first' as place, event_id, ts from events order by ts, event_id limit 1) union all "
                         "(select 'last' as place, event_id, ts from events order by ts desc, event_id desc limit 1)")
def first_and_last(spark, sf_dir):
    events = scan(spark, sf_dir, "events", ["event_id", "ts"])
    first, last = (rows.first_row(events, ["ts", "event_id"]), rows.last_row(events, ["ts", "event_id"]))
    return (first.select(F.lit("first").alias("place"), "event_id", "ts")
            .unionByName(last.select(F.lit("last").alias("place"), "event_id", "ts")))


@query("row_at_position", "select *, row_number() over (order by o_totalprice, o_orderkey) as position from orders "
                          "qualify position = 777")
def row_at_position(spark, sf_dir):
    return rows.row_at(scan(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 777)


@query("row_positions", "select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice, row_number() over "
                        "(order by l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice) as position "
                        "from lineitem")
def row_positions(spark, sf_dir):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    return rows.with_position(scan(spark, sf_dir, "lineitem", columns), columns)


@query("skip_rows", "select * from orders order by o_totalprice, o_orderkey limit 500 offset 1000")
def skip_rows(spark, sf_dir):
    return rows.skip_rows(scan(spark, sf_dir, "orders"), ["o_totalprice", "o_orderkey"], 1000, 500)


@query("prior_row", "select o_orderkey, o_totalprice, lag(o_orderkey) over w as prior_o_orderkey, "
                    "lag(o_totalprice) over w as prior_o_totalprice from orders "
                    "window w as (order by o_totalprice, o_orderkey)")
def prior_row(spark, sf_dir):
    return rows.prior_row(scan(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]),
                          ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"])


def _with_nulls(spark, sf_dir):
    """Orders in the database, with NULLs in place of two sentry values."""
    frame = read_parquet(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return loaded(spark, sf_dir, frame, "nulls", null_sentries={"o_orderstatus": "P", "o_orderpriority": "5-LOW"},
                  stable_input=True)


@query("get_with_fallback", "select o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') as status from orders")
def get_with_fallback(spark, sf_dir):
    return _with_nulls(spark, sf_dir).select(
        "o_orderkey", rows.with_fallback(F.col("o_orderstatus"), "none").alias("status"))


@query("null_test", "select o_orderkey, o_orderstatus = 'P' as o_orderstatus_is_null, "
                    "o_orderpriority = '5-LOW' as o_orderpriority_is_null from orders")
def null_test(spark, sf_dir):
    tested = rows.null_test(_with_nulls(spark, sf_dir), ["o_orderstatus", "o_orderpriority"])
    return tested.select("o_orderkey", "o_orderstatus_is_null", "o_orderpriority_is_null")


@query("filter_null", "select o_orderkey from orders where o_orderstatus = 'P' and o_orderpriority <> '5-LOW'")
def filter_null(spark, sf_dir):
    return (_with_nulls(spark, sf_dir)
            .filter(F.col("o_orderstatus").isNull() & F.col("o_orderpriority").isNotNull()).select("o_orderkey"))


_PROFILED = ("nation", "region", "supplier", "customer", "customer_nation")


@query("profile_tables", " union all ".join(
    f"select '{name}' as name, '{'VIEW' if name == 'customer_nation' else 'TABLE'}' as kind, "
    + ("count(*) as n_rows from customer join nation on c_nationkey = n_nationkey" if name == "customer_nation"
       else f"count(*) as n_rows from {name}") for name in _PROFILED))
def profile_tables(spark, sf_dir):
    return profile.profile_tables(spark, connection=source(spark, sf_dir, *_PROFILED),
                                  tables_like=[name.replace("_", "\\_") for name in _PROFILED])


def _profile_sql(place: int, name: str, kind: str, size: str, text: str) -> str:
    return (f"select {place} as ordinal, '{name}' as column_name, '{kind}' as type_name, {size} as column_size, "
            f"cast(null as integer) as decimal_digits, count(*) - count({name}) as n_null, "
            f"count(distinct {name}) as n_distinct, {text.format('min(' + name + ')')} as min_value, "
            f"{text.format('max(' + name + ')')} as max_value, max(length({text.format(name)})) as max_length "
            "from orders")


@query("profile_columns", " union all ".join([
    _profile_sql(1, "o_orderkey", "bigint", "19", "cast({} as varchar)"),
    _profile_sql(2, "o_custkey", "bigint", "19", "cast({} as varchar)"),
    _profile_sql(3, "o_orderstatus", "string", "cast(null as integer)", "{}"),
    _profile_sql(4, "o_totalprice", "double", "15", "printf('%.6f', {})"),
    _profile_sql(5, "o_orderdate", "timestamp_ntz", "26", "(strftime({}, '%Y-%m-%d %H:%M:%S') || ' +0000')"),
    _profile_sql(6, "o_orderpriority", "string", "cast(null as integer)", "{}")]))
def profile_columns(spark, sf_dir):
    return profile.profile_columns(scan(spark, sf_dir, "orders"))


@query("check_key", "select l_orderkey, count(*) as n from lineitem group by l_orderkey having count(*) > 1")
def check_key(spark, sf_dir):
    return profile.check_key(scan(spark, sf_dir, "lineitem", ["l_orderkey"]), ["l_orderkey"])


@query("check_constraints", "select 'not null' as kind, 'o_orderkey' as columns, "
                            "count(*) - count(o_orderkey) as violations from orders "
                            "union all select 'primary key', 'o_orderkey', count(*) - count(distinct o_orderkey) "
                            "from orders")
def check_constraints(spark, sf_dir):
    return profile.check_constraints(spark, connection=source(spark, sf_dir, "orders"), table_name="orders")


@query("check_not_null", "select 'o_orderkey' as column_name, 0 as violations union all "
                         "select 'o_orderstatus', count(*) from orders where o_orderstatus = 'P' union all "
                         "select 'o_orderpriority', count(*) from orders where o_orderpriority = '5-LOW'")
def check_not_null(spark, sf_dir):
    return profile.check_not_null(_with_nulls(spark, sf_dir), ["o_orderkey", "o_orderstatus", "o_orderpriority"])
