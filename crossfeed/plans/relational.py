"""Relational shapes over external tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfeed.fixtures import source
from crossfeed.operators.relations import one_sided_join_count, small_side
from crossfeed.plans.registry import query
from crossfeed.plans.scans import attach, scan
from crossfeed.sources.scan import ext_query


@query("filter_eq", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def filter_eq(spark, sf_dir):
    return (scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_totalprice"])
            .filter("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"))


@query("filter_cast", "select l_orderkey, l_extendedprice from lineitem "
                      "where cast(l_extendedprice as decimal(10, 2)) > 50000.0")
def filter_cast(spark, sf_dir):
    return (scan(spark, sf_dir, "lineitem", ["l_orderkey", "l_extendedprice"])
            .filter(F.col("l_extendedprice").cast("decimal(10,2)") > F.lit("50000.0").cast("decimal(10,2)")))


@query("filter_between", "select cast(o_orderkey as varchar) as o_orderkey, printf('%.6f', o_totalprice) as "
                         "o_totalprice from orders where o_totalprice between 100000 and 300000")
def filter_between(spark, sf_dir):
    """All columns as text, filtered on a number in that text."""
    return (scan(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"], all_varchar=True)
            .filter(F.col("o_totalprice").cast("decimal(18,6)").between(100000, 300000)))


@query("filter_like", "select doc_id from documents where text like '%ü%'")
def filter_like(spark, sf_dir):
    """Non-ASCII LIKE over whole texts, run by the external database."""
    return ext_query(spark, connection=source(spark, sf_dir, "documents"), column_names=["doc_id"],
                     query='SELECT "doc_id" FROM "documents" WHERE "text" LIKE \'%ü%\'',
                     partition_column="doc_id", num_partitions=4)


@query("join_two", "select n_name, count(*) as n from customer join nation on c_nationkey = n_nationkey group by n_name")
def join_two(spark, sf_dir):
    customers = scan(spark, sf_dir, "customer", ["c_nationkey"]).groupBy("c_nationkey").agg(F.count("*").alias("n"))
    nations = small_side(scan(spark, sf_dir, "nation", ["n_nationkey", "n_name"]))
    return (customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg(F.sum("n").alias("n")))


@query("join_three", "select r_name, count(*) as n from customer join nation on c_nationkey = n_nationkey "
                     "join region on n_regionkey = r_regionkey group by r_name")
def join_three(spark, sf_dir):
    customers = scan(spark, sf_dir, "customer", ["c_nationkey"]).groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return (customers.join(_nations_with_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name").agg(F.sum("n").alias("n")))


@query("join_four", "select r_name, count(*) as n, sum(cast(o_totalprice as decimal(18, 2))) as total from orders "
                    "join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey "
                    "join region on n_regionkey = r_regionkey group by r_name")
def join_four(spark, sf_dir):
    return (_bought_by_customer(spark, sf_dir)
            .join(_nations_with_regions(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("r_name").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,2)").alias("total")))


@query("join_rows", "select o_orderkey, c_name, n_name from orders join customer on o_custkey = c_custkey "
                    "join nation on c_nationkey = n_nationkey")
def join_rows(spark, sf_dir):
    """Joined rows, not counts: the small tables are measured before they are broadcast."""
    orders = scan(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    customers = small_side(scan(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey"]))
    nations = small_side(scan(spark, sf_dir, "nation", ["n_nationkey", "n_name"]))
    return (orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_name", "n_name"))


@query("join_theta", "select count(*) as n from orders join customer on o_orderstatus = 'F' "
                     "where c_mktsegment = 'BUILDING'")
def join_theta(spark, sf_dir):
    return one_sided_join_count(scan(spark, sf_dir, "orders", ["o_orderstatus"]), F.col("o_orderstatus") == "F",
                                scan(spark, sf_dir, "customer", ["c_mktsegment"]), F.col("c_mktsegment") == "BUILDING")


@query("agg_count", "select count(*) as n from orders")
def agg_count(spark, sf_dir):
    """The database counts; one number travels."""
    return ext_query(spark, connection=source(spark, sf_dir, "orders"), query='SELECT COUNT(*) AS n FROM "orders"',
                     column_names=["n"]).select(F.col("n").cast("bigint").alias("n"))


@query("agg_group", "select o_orderstatus, year(o_orderdate) as order_year, count(*) as n, "
                    "sum(cast(o_totalprice as decimal(18, 2))) as total from orders group by 1, 2")
def agg_group(spark, sf_dir):
    return (scan(spark, sf_dir, "orders", ["o_orderstatus", "o_orderdate", "o_totalprice"])
            .groupBy("o_orderstatus", F.year("o_orderdate").cast("bigint").alias("order_year"))
            .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")))


@query("agg_sum", "select sum(cast(l_extendedprice as decimal(18, 2))) as total, "
                  "round(sum(cast(l_quantity as double)), 2) as quantity from lineitem")
def agg_sum(spark, sf_dir):
    return scan(spark, sf_dir, "lineitem", ["l_extendedprice", "l_quantity"]).agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("total"),
        F.round(F.sum(F.col("l_quantity").cast("double")), 2).alias("quantity"))


@query("agg_avg_decimal", "select o_orderpriority, cast(avg(cast(o_totalprice as decimal(20, 2))) as decimal(20, 2)) "
                          "as average from orders group by o_orderpriority")
def agg_avg_decimal(spark, sf_dir):
    average = F.avg(F.col("o_totalprice").cast("decimal(20,2)")).cast("decimal(20,2)")
    return (scan(spark, sf_dir, "orders", ["o_orderpriority", "o_totalprice"])
            .groupBy("o_orderpriority").agg(average.alias("average")))


@query("sort_limit", "select o_orderkey, o_totalprice as price from orders order by price desc, o_orderkey limit 10")
def sort_limit(spark, sf_dir):
    return (scan(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
            .select("o_orderkey", F.col("o_totalprice").alias("price")).orderBy(F.desc("price"), "o_orderkey").limit(10))


@query("union_all", "select c_name as name, c_acctbal as balance from customer "
                    "union all select s_name, s_acctbal from supplier")
def union_all(spark, sf_dir):
    customers = scan(spark, sf_dir, "customer", ["c_name", "c_acctbal"]).toDF("name", "balance")
    return customers.unionByName(scan(spark, sf_dir, "supplier", ["s_name", "s_acctbal"]).toDF("name", "balance"))


TOPK_SQL = """
    select n_name, cast(avg(cast(o_totalprice as decimal(20, 2))) as decimal(20, 2)) as average from orders
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    group by n_name order by average desc, n_name limit 5"""


@query("topk_group_avg", TOPK_SQL)
def topk_group_avg(spark, sf_dir):
    """Nations with the highest average order price, over attached tables."""
    attach(spark, sf_dir, "tga_", "orders", "customer", "nation")
    nations = small_side(spark.table("tga_nation").select("n_nationkey", "n_name"))
    bought = (spark.table("tga_orders").groupBy("o_custkey")
              .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(20,2)")).alias("total")))
    per_nation = (bought.join(spark.table("tga_customer").select("c_custkey", "c_nationkey"),
                              F.col("o_custkey") == F.col("c_custkey"))
                  .groupBy("c_nationkey").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
    return (per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .groupBy("n_name").agg((F.sum("total") / F.sum("n")).cast("decimal(20,2)").alias("average"))
            .orderBy(F.desc("average"), "n_name").limit(5))


def _nations_with_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with the name of their region, measured before they are broadcast."""
    nations = scan(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    regions = small_side(scan(spark, sf_dir, "region", ["r_regionkey", "r_name"]))
    joined = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return small_side(joined.select("n_nationkey", "r_name"))


def _bought_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders summed per customer before the join: a customer with very many orders is one row in the shuffle."""
    bought = (scan(spark, sf_dir, "orders", ["o_custkey", "o_totalprice"]).groupBy("o_custkey")
              .agg(F.count("*").alias("n"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("total")))
    customers = scan(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    return (bought.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            .groupBy("c_nationkey").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
