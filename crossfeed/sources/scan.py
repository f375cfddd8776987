"""External tables and external query results as DataFrames."""

from __future__ import annotations

import json
import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed import connections
from crossfeed.admin import open_admin
from crossfeed.connections import Connection
from crossfeed.errors import ExternalError, check_flag, check_text, failed, require_text
from crossfeed.functions.text import charset, decode_text, redecode_text
from crossfeed.functions.types import all_text, column_of, narrow_columns, normalised
from crossfeed.sources import splits
from crossfeed.sources.dbapi import SOURCE_NAME, DbApiSource, describe, kinds_in_range

FETCH_SIZE = 10_000


def ext_scan(spark: SparkSession, *, table_name: str | None = None, connection=None, username: str = "",
             password: str = "", all_varchar: bool = False, encoding: str = "UTF-8",
             timeout: int = connections.DEFAULT_TIMEOUT, read_only: bool = True, schema_name: str | None = None,
             columns: list[str] | None = None, text_columns: tuple[str, ...] = (),
             partition_column: str | None = None, lower_bound=None, upper_bound=None,
             num_partitions: int | None = None, balanced: bool | None = None, tie_column: str | None = None,
             predicates: list[str] | None = None, condition: str | None = None, fetch_size: int = FETCH_SIZE,
             query_timeout: int = 0, count_rows: bool = True) -> DataFrame:
    """One external table or view as a DataFrame; over JDBC only the columns and rows a query needs are read.

    Without a ``partition_column`` the leading primary key column is used. Numbers, dates and timestamps are cut in equal
    steps between two bounds; keys of other kinds (text, bytes, UUIDs) where the database's own order puts even numbers of
    rows, whatever bounds are given.
    Bounds that are not given come from one remote MIN/MAX. ``num_partitions=1`` reads through one connection, hence
    one snapshot; several partitions see no common snapshot. ``balanced=True`` has the database make a histogram of the key, so that
    skewed keys of any kind make even partitions; a single hot key is cut along ``tie_column``. This is the default for a
    primary key of several columns, whose leading column alone may be skewed. ``predicates`` are remote conditions,
    one partition each; they have to be disjoint and cover the table.
    Without ``count_rows`` nothing is counted in the database: the number of partitions follows the span of a
    whole-number key, else the cores.
    ``columns`` names the columns to read and ``condition`` is remote SQL that the rows have to meet; the DB-API source
    learns neither from the query.
    """
    require_text("table_name", table_name)
    check_text("encoding", encoding)
    check_flag("all_varchar", all_varchar)
    if balanced is not None:
        check_flag("balanced", balanced)
    found = connections.resolve(connection, username, password, timeout, read_only, query_timeout)
    with open_admin(spark, found) as admin:
        relation = admin.find(table_name, schema_name)
        path = f"(SELECT * FROM {relation.path} WHERE {condition}\n) cf_scan" if condition else relation.path
        if predicates is None and num_partitions != 1:
            keys = admin.key_columns(relation)
            if balanced is None and partition_column is None and len(keys) > 1 and count_rows:
                balanced, tie_column = True, tie_column or keys[1]
            predicates = _cuts(spark, admin, path, keys, partition_column, lower_bound, upper_bound,
                               num_partitions, bool(balanced), tie_column, count_rows)
    frame = _load(spark, found, path, columns, predicates, fetch_size, f"scan table '{table_name}'")
    return _finished(frame, all_varchar, encoding, text_columns)


def ext_query(spark: SparkSession, *, connection=None, query: str | None = None, username: str = "",
              password: str = "", all_varchar: bool = False, encoding: str = "UTF-8",
              timeout: int = connections.DEFAULT_TIMEOUT, read_only: bool = True,
              column_names: list[str] | None = None, text_columns: tuple[str, ...] = (),
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, balanced: bool = False, tie_column: str | None = None,
              predicates: list[str] | None = None, fetch_size: int = FETCH_SIZE,
              query_timeout: int = 0) -> DataFrame:
    """The result of SQL text that the external database runs. Bad text fails here, not at the first action.

    Aggregates and limits belong into the text: the database then sends their result only. A large result can be cut
    like a table, by a ``partition_column`` it has; the database then runs the text once per partition.
    ``column_names`` renames the columns by position, for databases that fold the case of names.
    """
    require_text("query", query)
    check_text("encoding", encoding)
    check_flag("all_varchar", all_varchar)
    text = query.strip().rstrip(";").strip()
    if not text:
        raise ExternalError("Failed to prepare statement: the query is empty")
    found = connections.resolve(connection, username, password, timeout, read_only, query_timeout)
    relation = f"({text}\n) cf_query"
    if predicates is None and partition_column is not None and num_partitions != 1:
        with open_admin(spark, found) as admin:
            predicates = _cuts(spark, admin, relation, [], partition_column, lower_bound, upper_bound, num_partitions,
                               balanced, tie_column)
    frame = _load(spark, found, relation, None, predicates, fetch_size, "prepare statement")
    if column_names:
        if len(column_names) != len(frame.columns):
            raise ExternalError(f"The query has {len(frame.columns)} columns, {len(column_names)} names were given")
        frame = frame.toDF(*column_names)
    return _finished(frame, all_varchar, encoding, text_columns)


def ext_multi_query(spark: SparkSession, *, connection=None, queries: dict[str, str] | None = None,
                    tag_column: str = "source", **options) -> DataFrame:
    """The results of several queries in one frame, each row tagged with the key of its query.

    Columns are matched by name; one that a result lacks is NULL there.
    """
    if not queries:
        raise ExternalError("Missing required parameter 'queries'")
    parts = [ext_query(spark, connection=connection, query=text, **options).withColumn(tag_column, F.lit(tag))
             for tag, text in queries.items()]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def register_dbapi(spark: SparkSession) -> None:
    """Make the data source known to a session."""
    spark.dataSource.register(DbApiSource)


def _cuts(spark, admin, relation: str, keys: list[str], column, low, high, count, balanced,
          tie_column, counted: bool = True) -> list[str] | None:
    """Predicates for the partitions of a relation; None, hence one partition, where it has no key that can be cut.

    A column the caller named has to be one that can be cut. Without ``counted`` no rows are counted: the number of
    partitions follows the span of a whole-number key, else the cores.
    """
    named = column is not None
    column = column if named else keys[0] if keys else None
    if column is None:
        warnings.warn(f"{relation} has no key to partition by and is read through one connection; "
                      "name a partition_column", stacklevel=3)
        return None
    if balanced:
        return _even_cuts(spark, admin, relation, column, count, tie_column, named)
    rows = None
    if low is None or high is None or (count is None and counted):
        try:
            least, most, rows = splits.key_bounds(admin, relation, column, counted and count is None)
        except ExternalError:
            # keys that the database can sort and yet has no smallest of, UUIDs for instance
            return _even_cuts(spark, admin, relation, column, count, tie_column, named)
        low = least if low is None else low
        high = most if high is None else high
    if low is None or high is None:
        return None
    axis = splits.axis_of(low, high, admin.time_literal)
    if axis is None:
        return _even_cuts(spark, admin, relation, column, count, tie_column, named)
    if count is None:
        if rows is None:
            rows = axis.high - axis.low + 1 if axis.is_integer else splits.FEWEST_ROWS * spark.sparkContext.defaultParallelism
        count = splits.partition_count(rows, spark.sparkContext.defaultParallelism)
    return splits.range_predicates(admin.quote(column), axis, count)


def _even_cuts(spark, admin, relation, column, count, tie_column, named) -> list[str] | None:
    """Ranges of equal numbers of rows; for keys without bounds that could be cut in equal steps, too."""
    try:
        name = admin.quote(column)
        rows = admin.filled(relation, name)
        count = count or splits.partition_count(rows, spark.sparkContext.defaultParallelism)
        made = splits.balanced_predicates(admin, relation, column, count, tie_column, rows)
    except ExternalError as cause:
        if named:
            raise ExternalError(f"Partitions need a column that the database can sort, '{column}' is not: {cause}") from cause
        made = ["1 = 1"]
    if made == ["1 = 1"] and count > 1 and rows > 1:
        if named and not _has_literal(admin, relation, column):
            raise ExternalError(f"Partitions need a number, date, timestamp, text or bytes column, '{column}' is not")
        warnings.warn(f"{relation} has a key that can't be cut and is read through one connection; give predicates", stacklevel=4)
        return None
    return made


def _has_literal(admin, relation, column) -> bool:
    """Whether keys of a column can be written into a statement. Text counts, although some texts make no cut."""
    name = admin.quote(column)
    least = admin.rows(f"SELECT MIN({name}) FROM {relation}", f"look at '{column}'")[0][0]
    return isinstance(least, str) or splits.literal(admin, least) is not None


def _load(spark, found: Connection, relation: str, columns, predicates, fetch_size, operation) -> DataFrame:
    try:
        if found.kind == "jdbc":
            frame = _load_jdbc(spark, found, relation, predicates, fetch_size)
            return normalised(frame.select(*[column_of(name) for name in columns]) if columns else frame)
        return normalised(_load_dbapi(spark, found, relation, columns, predicates, fetch_size))
    except ExternalError:
        raise
    except Exception as cause:
        raise failed(operation, cause) from cause


def _load_jdbc(spark, found, relation, predicates, fetch_size) -> DataFrame:
    options = found.jdbc_options() | {"fetchsize": str(fetch_size)}
    frame = _jdbc_frame(spark, options, relation, predicates)
    narrow = narrow_columns(frame.schema)
    return _jdbc_frame(spark, options | {"customSchema": narrow}, relation, predicates) if narrow else frame


def _jdbc_frame(spark, options, relation, predicates) -> DataFrame:
    if predicates and predicates != ["1 = 1"]:
        rest = {key: value for key, value in options.items() if key != "url"}
        return spark.read.jdbc(options["url"], relation, predicates=predicates, properties=rest)
    return spark.read.format("jdbc").options(**options).option("dbtable", relation).load()


def _load_dbapi(spark, found, relation, columns, predicates, fetch_size) -> DataFrame:
    options = found.dbapi_options()

    def look(names: list[str]) -> list[list[tuple]]:
        """Kinds of computed values, looked at by one task per partition; a few numbers of each come back."""
        return (spark.sparkContext.parallelize(predicates, len(predicates))
                .map(lambda predicate: kinds_in_range(options, relation, names, predicate)).collect())

    several = predicates is not None and len(predicates) > 1 and found.target != ":memory:"
    with open_admin(spark, found) as admin:
        schema = describe(admin.session, relation, look if several else None)
    if columns:
        missing = [name for name in columns if name not in schema.names]
        if missing:
            raise ExternalError(f"Column '{missing[0]}' is not in {relation}")
        schema = T.StructType([schema[name] for name in columns])
    register_dbapi(spark)
    options = options | {
        "relation": relation,
        "fetchsize": str(fetch_size),
        "predicates": json.dumps(predicates or [""]),
    }
    return spark.read.format(SOURCE_NAME).schema(schema).options(**options).load()


def _finished(frame: DataFrame, all_varchar: bool, encoding: str, text_columns) -> DataFrame:
    """The encoding, then the text format. ``text_columns`` are byte columns that hold text in ``encoding``."""
    named = set(text_columns)
    if charset(encoding) != "utf-8" or named:
        columns = []
        for field in frame.schema:
            column = column_of(field.name)
            if isinstance(field.dataType, T.BinaryType) and field.name in named:
                column = decode_text(column, encoding).alias(field.name)
            elif isinstance(field.dataType, T.StringType):
                column = redecode_text(column, encoding).alias(field.name)
            columns.append(column)
        frame = frame.select(*columns)
    return all_text(frame) if all_varchar else frame
