"""Queries over scans, remote queries and attached views."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.admin import scratch_name
from crossfeed.fixtures import RANGE_COLUMNS, balanced_cuts, read_parquet, source, sqlite_source, target
from crossfeed.functions import text
from crossfeed.functions.types import as_text, column_of
from crossfeed.operators.profile import profile_tables
from crossfeed.operators.relations import small_side
from crossfeed.plans.registry import query
from crossfeed.sinks.load import ext_load
from crossfeed.sources.attach import ext_attach
from crossfeed.sources.scan import ext_multi_query, ext_query, ext_scan


def scan(spark: SparkSession, sf_dir: str, table: str, columns: list[str] | None = None, **options) -> DataFrame:
    """A staged table. One without a unique key is cut by row counts, since a third of its rows may share a key."""
    if table in RANGE_COLUMNS and not options:
        options = {"predicates": balanced_cuts(spark, sf_dir, table)}
    return ext_scan(spark, table_name=table, connection=source(spark, sf_dir, table), columns=columns, **options)


def attach(spark: SparkSession, sf_dir: str, prefix: str, *relations: str, **options) -> DataFrame:
    return ext_attach(spark, connection=source(spark, sf_dir, *relations), prefix=prefix, overwrite=True,
                      tables_like=[name.replace("_", "\\_") for name in relations], **options)


@query("ext_scan", "select * from orders")
def ext_scan_orders(spark, sf_dir):
    return scan(spark, sf_dir, "orders")


@query("scan_partitioned_range", "select * from lineitem")
def scan_partitioned_range(spark, sf_dir):
    return scan(spark, sf_dir, "lineitem", partition_column="l_orderkey", num_partitions=8)


@query("scan_partitioned_predicates", "select * from lineitem")
def scan_partitioned_predicates(spark, sf_dir):
    """Partitions with about the same number of rows, cut by counts the database makes."""
    return scan(spark, sf_dir, "lineitem", partition_column="l_orderkey", tie_column="l_partkey", num_partitions=8,
                balanced=True)


@query("scan_fetchsize", "select * from orders")
def scan_fetchsize(spark, sf_dir):
    return scan(spark, sf_dir, "orders", fetch_size=100)


@query("scan_projection", "select o_orderkey, o_totalprice as price from orders")
def scan_projection(spark, sf_dir):
    return (scan(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
            .select("o_orderkey", F.col("o_totalprice").alias("price")))


@query("select_by_position", "select c_custkey, c_nationkey from customer")
def select_by_position(spark, sf_dir):
    frame = scan(spark, sf_dir, "customer")
    return frame.select(frame.columns[0], frame.columns[2])


@query("scan_count_star", "select count(*) as n from lineitem")
def scan_count_star(spark, sf_dir):
    """Counts rows in Spark: no column is read, each task sends one number."""
    return scan(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n"))


@query("ext_query", "select p_partkey, p_type from part where p_type like 'ECON%'")
def ext_query_part(spark, sf_dir):
    return ext_query(spark, connection=source(spark, sf_dir, "part"), column_names=["p_partkey", "p_type"],
                     query='SELECT "p_partkey", "p_type" FROM "part" WHERE "p_type" LIKE \'ECON%\';')


@query("ext_query_partitioned", "select l_orderkey, l_extendedprice * (1 - l_discount) as revenue from lineitem")
def ext_query_partitioned(spark, sf_dir):
    """A remote query whose result is read through several connections."""
    return ext_query(spark, connection=source(spark, sf_dir, "lineitem"), column_names=["l_orderkey", "revenue"],
                     partition_column="l_orderkey", num_partitions=8,
                     query='SELECT "l_orderkey", "l_extendedprice" * (1 - "l_discount") AS revenue FROM "lineitem"')


@query("scan_partitioned_time", "select * from events")
def scan_partitioned_time(spark, sf_dir):
    """Ranges of a timestamp column."""
    return scan(spark, sf_dir, "events", partition_column="ts", num_partitions=6)


@query("multi_query_union", "select 'customer' as source, c_name as name from customer "
                            "union all select 'supplier' as source, s_name as name from supplier")
def multi_query_union(spark, sf_dir):
    return ext_multi_query(spark, connection=source(spark, sf_dir, "customer", "supplier"),
                           partition_column="id", num_partitions=4,
                           queries={"customer": 'SELECT "c_custkey" AS "id", "c_name" AS "name" FROM "customer"',
                                    "supplier": 'SELECT "s_suppkey" AS "id", "s_name" AS "name" FROM "supplier"'}
                           ).select("source", "name")


@query("dbapi_scan", "select * from part")
def dbapi_scan(spark, sf_dir):
    """SQLite through the Python data source, one connection per partition."""
    return ext_scan(spark, table_name="part", connection=sqlite_source(spark, sf_dir, "part"), num_partitions=4)


@query("dbapi_reuse", """
    select p_partkey, p_name, 'small' as half from part where p_size <= 10
    union all select p_partkey, p_name, 'all' as half from part""")
def dbapi_reuse(spark, sf_dir):
    """One frame of the Python data source, used filtered and whole."""
    part = ext_scan(spark, table_name="part", connection=sqlite_source(spark, sf_dir, "part"), num_partitions=4)
    names = ["p_partkey", "p_name"]
    small = part.filter(F.col("p_size") <= 10).select(*names, F.lit("small").alias("half"))
    return small.union(part.select(*names, F.lit("all").alias("half")))


@query("text_format_exact", """
    select o_orderkey, printf('%f', o_totalprice / 128) as eighth, printf('%f', o_totalprice * 1e17) as large,
    printf('%f', (o_orderkey % 2000 + 0.5) / 1000000) as tie from orders""")
def text_format_exact(spark, sf_dir):
    """Values at and around the seventh decimal, and beyond 53 bits, in the text format."""
    price, double = F.col("o_totalprice"), T.DoubleType()
    values = {"eighth": price / 128, "large": price * F.lit(1e17), "tie": (F.col("o_orderkey") % 2000 + F.lit(0.5)) / F.lit(1e6)}
    return scan(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"]).select(
        "o_orderkey", *[as_text(value, double).alias(name) for name, value in values.items()])


@query("param_query", "select o_orderkey, o_totalprice from orders where o_orderstatus = 'F' and o_totalprice > 250000")
def param_query(spark, sf_dir):
    attach(spark, sf_dir, "pq_", "orders")
    return spark.sql("SELECT o_orderkey, o_totalprice FROM pq_orders WHERE o_orderstatus = ? AND o_totalprice > ?",
                     args=["F", 250000])


@query("session_variable", "select o_orderkey, o_orderstatus from orders "
                           "where o_orderstatus = (select max(o_orderstatus) from orders)")
def session_variable(spark, sf_dir):
    attach(spark, sf_dir, "sv_", "orders")
    spark.sql("DECLARE OR REPLACE VARIABLE cf_status STRING")
    spark.sql("SET VAR cf_status = (SELECT max(o_orderstatus) FROM sv_orders)")
    return spark.sql("SELECT o_orderkey, o_orderstatus FROM sv_orders WHERE o_orderstatus = cf_status")


@query("literal_rows", "select c_custkey, 42 as answer, 1 as a, 2 as b, 'hello world' as greeting, "
                       "cast(null as varchar) as null_value from customer")
def literal_rows(spark, sf_dir):
    return ext_query(spark, connection=source(spark, sf_dir, "customer"),
                     column_names=["c_custkey", "answer", "a", "b", "greeting", "null_value"],
                     query='SELECT "c_custkey", 42 AS answer, 1 AS a, 2 AS b, \'hello world\' AS greeting, '
                           'CAST(NULL AS VARCHAR(1)) AS null_value FROM "customer"',
                     partition_column="c_custkey", num_partitions=4).select("c_custkey", *[F.col(name).cast("int").alias(name) for name in ("answer", "a", "b")],
                              "greeting", "null_value")


@query("case_when", "select o_orderkey, case o_orderstatus when 'O' then 'open' when 'F' then 'final' else 'partial' "
                    "end as state from orders")
def case_when(spark, sf_dir):
    status = F.col("o_orderstatus")
    state = F.when(status == "O", "open").when(status == "F", "final").otherwise("partial")
    return scan(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus"]).select("o_orderkey", state.alias("state"))


@query("recursive_sequence", """
    with recursive days(n) as (select 0 union all select n + 1 from days where n <
        (select date_diff('day', min(o_orderdate)::date, max(o_orderdate)::date) from orders)),
    first_day as (select min(o_orderdate)::date as d from orders),
    sold as (select o_orderdate::date as day, count(*) as n_orders from orders group by 1)
    select days.n as n, coalesce(n_orders, 0) as n_orders from days, first_day
    left join sold on sold.day = first_day.d + days.n::integer""")
def recursive_sequence(spark, sf_dir):
    """One row for every day between the first and the last order, with the orders of that day.

    The days come from a range that Spark cuts itself; recursion, with a job per level, is left to ``recursive_cte``.
    """
    attach(spark, sf_dir, "rs_", "orders")
    ends = spark.sql("SELECT CAST(min(o_orderdate) AS DATE) AS low, "
                     "datediff(max(o_orderdate), min(o_orderdate)) AS span FROM rs_orders").first()
    days = spark.range(int(ends["span"]) + 1).select(F.col("id").alias("n"))
    sold = (spark.table("rs_orders").groupBy(F.datediff("o_orderdate", F.lit(ends["low"])).alias("n"))
            .agg(F.count("*").alias("n_orders")))
    return days.join(sold, "n", "left").select("n", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


@query("recursive_cte", """
    with recursive months(n) as (select 0 union all select n + 1 from months where n <
        (select date_diff('month', min(o_orderdate)::date, max(o_orderdate)::date) from orders)),
    low as (select min(year(o_orderdate) * 12 + month(o_orderdate)) as m from orders),
    sold as (select year(o_orderdate) * 12 + month(o_orderdate) as month, count(*) as n_orders from orders group by 1)
    select months.n as n, coalesce(n_orders, 0) as n_orders from months, low
    left join sold on sold.month = low.m + months.n""")
def recursive_cte(spark, sf_dir):
    """The same by month, with Spark's own recursion; the number of levels grows with the months covered only."""
    attach(spark, sf_dir, "rc_", "orders")
    ends = spark.sql("SELECT min(year(o_orderdate) * 12 + month(o_orderdate)) AS low, "
                     "max(year(o_orderdate) * 12 + month(o_orderdate)) AS high FROM rc_orders").first()
    levels = int(ends["high"]) - int(ends["low"]) + 2
    return spark.sql(f"""
        WITH RECURSIVE months(n) MAX RECURSION LEVEL {levels} AS (
            SELECT 0 UNION ALL SELECT n + 1 FROM months WHERE n < :high - :low),
        sold AS (SELECT year(o_orderdate) * 12 + month(o_orderdate) - :low AS month, count(*) AS n_orders
            FROM rc_orders GROUP BY 1)
        SELECT n, coalesce(n_orders, 0) AS n_orders FROM months LEFT JOIN sold ON sold.month = months.n
        """, args={"low": ends["low"], "high": ends["high"]})


@query("scan_typed_schema", """
    select 'o_orderkey' as column_name, 'bigint' as type_name, count(o_orderkey) as n from orders
    union all select 'o_custkey', 'bigint', count(o_custkey) from orders
    union all select 'o_orderstatus', 'string', count(o_orderstatus) from orders
    union all select 'o_totalprice', 'double', count(o_totalprice) from orders
    union all select 'o_orderdate', 'timestamp_ntz', count(o_orderdate) from orders
    union all select 'o_orderpriority', 'string', count(o_orderpriority) from orders""")
def scan_typed_schema(spark, sf_dir):
    frame = scan(spark, sf_dir, "orders")
    counts = frame.agg(*[F.count(column_of(field.name)).alias(field.name) for field in frame.schema])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(field.name).alias("column_name"), F.lit(field.dataType.simpleString()).alias("type_name"),
                 column_of(field.name).alias("n")) for field in frame.schema])))


@query("typeof_columns", """
    select 'p_partkey' as column_name, 'bigint' as type_name, count(*) as n from part
    union all select 'p_name', 'string', count(*) from part
    union all select 'p_brand', 'string', count(*) from part
    union all select 'p_type', 'string', count(*) from part
    union all select 'p_size', 'int', count(*) from part
    union all select 'p_retailprice', 'double', count(*) from part
    union all select 'p_retailprice as text', 'string', count(*) from part""")
def typeof_columns(spark, sf_dir):
    frame = scan(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    pairs = [(name, F.typeof(name)) for name in frame.columns]
    pairs.append(("p_retailprice as text", F.typeof(as_text(F.col("p_retailprice"), frame.schema[-1].dataType))))
    kinds = frame.agg(F.count(F.lit(1)).alias("n"), *[F.max(kind).alias(f"k{place}")
                                                      for place, (_, kind) in enumerate(pairs)])
    return kinds.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"k{place}").alias("type_name"), F.col("n"))
        for place, (name, _) in enumerate(pairs)])))


@query("scan_all_varchar", "select cast(s_suppkey as varchar) as s_suppkey, s_name, cast(s_nationkey as varchar) as "
                           "s_nationkey, printf('%.6f', s_acctbal) as s_acctbal from supplier")
def scan_all_varchar(spark, sf_dir):
    return scan(spark, sf_dir, "supplier", all_varchar=True)


@query("scan_quoted_identifier", 'select c_custkey, c_name as "odd ""name" from customer where c_name is not null')
def scan_quoted_identifier(spark, sf_dir):
    odd = 'odd "name'
    connection, table = target(spark, sf_dir), scratch_name('odd "table')
    ext_load(read_parquet(spark, sf_dir, "customer").select("c_custkey", F.col("c_name").alias(odd)),
             table_name=table, connection=connection)
    return (ext_scan(spark, table_name=table, connection=connection, partition_column="c_custkey")
            .filter(column_of(odd).isNotNull()))


@query("scan_encoding", "select doc_id, text, text as misread from documents")
def scan_encoding(spark, sf_dir):
    """Legacy bytes, and the same bytes taken for Latin-1 text, read under the encoding they are really in."""
    connection, table = target(spark, sf_dir), scratch_name("legacy")
    raw = text.encode_text(F.col("text"), "ISO-8859-15")
    stored = (read_parquet(spark, sf_dir, "documents").select("doc_id", raw.alias("text"))
              .withColumn("misread", F.decode("text", "ISO-8859-1")))
    ext_load(stored, table_name=table, connection=connection)
    return ext_scan(spark, table_name=table, connection=connection, encoding="iso_8859-15", text_columns=("text",),
                    partition_column="doc_id")


@query("decode_text", "select doc_id, text, text as text_utf8 from documents")
def decode_text(spark, sf_dir):
    frame = scan(spark, sf_dir, "documents", ["doc_id", "text"])
    return (frame.select("doc_id", text.encode_text(F.col("text"), "CP_1252").alias("legacy"),
                         F.encode("text", "UTF-8").alias("modern"))
            .select("doc_id", text.decode_text(F.col("legacy"), "windows-1252").alias("text"),
                    text.decode_text(F.col("modern"), "utf8").alias("text_utf8")))


@query("decode_utf16", "select doc_id, text from documents")
def decode_utf16(spark, sf_dir):
    wide = text.encode_utf16(F.col("text"))
    return (scan(spark, sf_dir, "documents", ["doc_id", "text"]).select("doc_id", wide.alias("wide"))
            .select("doc_id", text.decode_utf16(F.col("wide")).alias("text")))


_ALIASES = sorted(text.ALIASES)
#: Encoding names whose charset has all letters of the documents; the others are given to the documents in plain ASCII.
_WESTERN = [name for name in _ALIASES if text.ALIASES[name] in ("utf-8", "cp1252", "cp1254", "iso8859-1", "iso8859-9", "iso8859-15")]


@query("decode_alias_table", "select doc_id, text, case when regexp_matches(text, '[^\\x00-\\x7F]') then "
       f"list_extract([{', '.join(repr(name) for name in _WESTERN)}], (doc_id % {len(_WESTERN)} + 1)::integer) else "
       f"list_extract([{', '.join(repr(name) for name in _ALIASES)}], (doc_id % {len(_ALIASES)} + 1)::integer) end "
       "as encoding from documents")
def decode_alias_table(spark, sf_dir):
    """Every document, as it is, in the bytes of one of the known encodings, and read back by the name it carries."""
    def pick(names):
        return F.get(F.array(*[F.lit(name) for name in names]), (F.col("doc_id") % len(names)).cast("int"))

    beyond = F.octet_length("text") != F.length("text")
    frame = (scan(spark, sf_dir, "documents", ["doc_id", "text"])
             .withColumn("encoding", F.when(beyond, pick(_WESTERN)).otherwise(pick(_ALIASES))))
    raw = frame.select("doc_id", "encoding", text.encode_each(F.col("text"), F.col("encoding"), _ALIASES).alias("raw"))
    return raw.select("doc_id", "encoding", text.decode_each(F.col("raw"), F.col("encoding"), _ALIASES).alias("text"))


@query("attach_tables_join", """
    select r_name, n_name, count(*) as n, sum(cast(o_totalprice as decimal(18, 2))) as total from orders
    join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey group by r_name, n_name""")
def attach_tables_join(spark, sf_dir):
    """Orders are summed per customer, then per nation, before each join: hot keys are single rows in the shuffle."""
    attach(spark, sf_dir, "atj_", "orders", "customer", "nation", "region")
    return spark.sql("""
        WITH bought AS (
            SELECT o_custkey, count(*) AS n, sum(cast(o_totalprice AS decimal(18, 2))) AS total
            FROM atj_orders GROUP BY o_custkey),
        sold AS (
            SELECT c_nationkey, sum(n) AS n, sum(total) AS total
            FROM bought JOIN atj_customer ON o_custkey = c_custkey GROUP BY c_nationkey)
        SELECT r_name, n_name, sum(n) AS n, cast(sum(total) AS decimal(38, 2)) AS total
        FROM sold JOIN atj_nation ON c_nationkey = n_nationkey JOIN atj_region ON n_regionkey = r_regionkey
        GROUP BY r_name, n_name""")


@query("attach_views", """
    select c_custkey, c_name, n_name, r_name from customer join nation on c_nationkey = n_nationkey
    join region on n_regionkey = r_regionkey""")
def attach_views(spark, sf_dir):
    """An external view joined with an external table; the few regions are measured, then broadcast."""
    attach(spark, sf_dir, "av_", "customer_nation", "region", partition_columns={"customer_nation": "c_custkey"})
    regions = small_side(spark.table("av_region"))
    return (spark.table("av_customer_nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("c_custkey", "c_name", "n_name", "r_name"))


@query("attach_overwrite", "select c_custkey, c_name from customer")
def attach_overwrite(spark, sf_dir):
    """A view over another table holds the name first; attaching with overwrite replaces it."""
    scan(spark, sf_dir, "supplier").createOrReplaceTempView("ao_customer")
    attach(spark, sf_dir, "ao_", "customer")
    return spark.table("ao_customer").select("c_custkey", "c_name")


@query("attach_all_varchar", """
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey, o_orderstatus,
    printf('%.6f', o_totalprice) as o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ' +0000' as o_orderdate,
    o_orderpriority from orders""")
def attach_all_varchar(spark, sf_dir):
    attach(spark, sf_dir, "aav_", "orders", all_varchar=True)
    return spark.table("aav_orders")


_REPORTED = ("region", "nation", "customer", "supplier", "customer_nation")


@query("attach_report", " union all ".join(
    f"select '{name}' as name, '{'VIEW' if name == 'customer_nation' else 'TABLE'}' as kind, 'attached' as status, "
    + ("count(*) as n_rows from customer join nation on c_nationkey = n_nationkey" if name == "customer_nation"
       else f"count(*) as n_rows from {name}") for name in _REPORTED))
def attach_report(spark, sf_dir):
    prefix = "ar_"
    report = attach(spark, sf_dir, prefix, *_REPORTED, partition_columns={"customer_nation": "c_custkey"})
    counts = reduce(DataFrame.unionByName, [
        spark.table(prefix + name).agg(F.count(F.lit(1)).alias("n_rows")).withColumn("name", F.lit(prefix + name))
        for name in _REPORTED])
    return (report.join(counts, "name")
            .select(F.substring("name", len(prefix) + 1, 128).alias("name"), "kind", "status", "n_rows"))


@query("attach_tables_like", "select 'customer' as name, 'TABLE' as kind, count(*) as n_rows from customer "
                             "union all select 'customer_nation', 'VIEW', count(*) from customer "
                             "join nation on c_nationkey = n_nationkey")
def attach_tables_like(spark, sf_dir):
    connection = source(spark, sf_dir, "customer", "customer_nation", "orders")
    report = ext_attach(spark, connection=connection, tables_like="c_stomer%", prefix="atl_", overwrite=True)
    counts = profile_tables(spark, connection=connection, tables_like="c_stomer%")
    return (report.select(F.substring("name", 5, 128).alias("name"), "kind")
            .join(counts.select("name", "n_rows"), "name"))
