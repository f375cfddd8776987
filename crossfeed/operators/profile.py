"""Profiles and checks of attached relations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed import connections
from crossfeed.admin import TABLE_KINDS, VIEW_KINDS, open_admin
from crossfeed.errors import ExternalError
from crossfeed.functions.types import as_text, column_of
from crossfeed.sources.attach import like_pattern
from crossfeed.sources.scan import ext_query, ext_scan

_SIZE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19, T.FloatType: 7, T.DoubleType: 15,
         T.BooleanType: 1, T.DateType: 10, T.TimestampNTZType: 26, T.TimestampType: 26}


def profile_tables(spark: SparkSession, *, connection, tables_like: list[str] | str | None = None,
                   **options) -> DataFrame:
    """Name, kind and row count of every external table and view. The database counts; one number per relation
    travels."""
    patterns = ["%"] if tables_like is None else [tables_like] if isinstance(tables_like, str) else tables_like
    found = connections.resolve(connection)
    with open_admin(spark, found) as admin:
        listed = [one for one in admin.relations(TABLE_KINDS + VIEW_KINDS)
                  if any(like_pattern(pattern).fullmatch(one.name) for pattern in patterns)]
    if not listed:
        return spark.createDataFrame([], "name string, kind string, n_rows bigint")
    counts = [ext_query(spark, connection=connection, query=f"SELECT COUNT(*) AS n FROM {one.path}",
                        column_names=["n"], **options)
              .select(F.lit(one.name).alias("name"), F.lit(one.kind).alias("kind"),
                      F.col("n").cast("bigint").alias("n_rows")) for one in listed]
    return reduce(DataFrame.unionByName, counts)


def profile_columns(frame: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: position, type, size, digits, NULLs, distinct values, smallest, largest, longest.

    One pass over the frame gathers everything but exact distinct counts. Those take one more: each task first
    reduces its rows to distinct (column, value) pairs, so the shuffle carries values, not rows. ``exact=False``
    estimates them in the first pass instead.
    """
    fields = list(enumerate(frame.schema, start=1))
    measures = []
    for place, field in fields:
        column = column_of(field.name)
        text = as_text(column, field.dataType)
        plain = isinstance(field.dataType, T.BinaryType)
        measures += [
            F.count_if(column.isNull()).alias(f"nulls_{place}"),
            F.min(text if plain else column).alias(f"min_{place}"),
            F.max(text if plain else column).alias(f"max_{place}"),
            F.max(F.length(text)).alias(f"longest_{place}"),
        ]
        if not exact:
            measures.append(F.approx_count_distinct(column).alias(f"distinct_{place}"))
    gathered = frame.agg(*measures)
    entries = []
    for place, field in fields:
        plain = isinstance(field.dataType, T.BinaryType)
        shown = T.StringType() if plain else field.dataType
        entries.append(F.struct(
            F.lit(place).alias("ordinal"), F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("type_name"),
            F.lit(column_size(field.dataType)).cast("int").alias("column_size"),
            F.lit(getattr(field.dataType, "scale", None)).cast("int").alias("decimal_digits"),
            F.col(f"nulls_{place}").alias("n_null"),
            (F.lit(None).cast("bigint") if exact else F.col(f"distinct_{place}")).alias("n_distinct"),
            as_text(F.col(f"min_{place}"), shown).alias("min_value"),
            as_text(F.col(f"max_{place}"), shown).alias("max_value"),
            F.col(f"longest_{place}").alias("max_length"),
        ))
    profile = gathered.select(F.inline(F.array(*entries)))
    if not exact:
        return profile
    pairs = frame.select(F.explode(F.array(*[
        F.struct(F.lit(place).alias("ordinal"), _value_key(field).alias("value")) for place, field in fields
    ])).alias("pair")).select("pair.*").filter(F.col("value").isNotNull())
    distinct = pairs.distinct().groupBy("ordinal").agg(F.count(F.lit(1)).alias("n_different"))
    # Both sides have one row per column of the frame.
    return (profile.drop("n_distinct").join(F.broadcast(distinct), "ordinal", "left")
            .withColumn("n_distinct", F.coalesce("n_different", F.lit(0)))
            .select(*profile.columns))


def _value_key(field: T.StructField):
    """Text that is the same exactly for equal values."""
    column = column_of(field.name)
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(column)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return (column + F.lit(0.0)).cast("string")
    return column.cast("string")


def column_size(kind: T.DataType) -> int | None:
    return kind.precision if isinstance(kind, T.DecimalType) else _SIZE.get(type(kind))


def check_key(frame: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that are not unique or hold a NULL, with their number of rows; partial counts meet in the shuffle."""
    _known(frame, keys)
    null_key = reduce(lambda a, b: a | b, [column_of(key).isNull() for key in keys])
    return (frame.groupBy(*[column_of(key) for key in keys]).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | null_key))


def check_not_null(frame: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column, for columns that should have none; one pass whatever the number of columns."""
    _known(frame, columns)
    counted = frame.agg(*[F.count_if(column_of(name).isNull()).alias(f"n_{place}")
                          for place, name in enumerate(columns)])
    return counted.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("column_name"), F.col(f"n_{place}").alias("violations"))
        for place, name in enumerate(columns)])))


def check_constraints(spark: SparkSession, *, connection, table_name: str, schema_name: str | None = None,
                      **options) -> DataFrame:
    """What the database declares of a table, checked on the rows that were read: one row for the primary key, with
    the number of key values that are repeated or NULL, and one per NOT NULL column, with its number of NULLs."""
    with open_admin(spark, connections.resolve(connection)) as admin:
        relation = admin.find(table_name, schema_name)
        keys = admin.key_columns(relation)
        filled = list(dict.fromkeys([*keys, *admin.not_null_columns(relation)]))
    if not filled:
        return spark.createDataFrame([], "kind string, columns string, violations bigint")
    frame = ext_scan(spark, table_name=table_name, schema_name=schema_name, connection=connection, columns=filled,
                     **options)
    checked = check_not_null(frame, filled).select(
        F.lit("not null").alias("kind"), F.col("column_name").alias("columns"), "violations")
    if not keys:
        return checked
    broken = check_key(frame, keys).agg(F.count(F.lit(1)).alias("violations"))
    return checked.unionByName(broken.select(F.lit("primary key").alias("kind"), F.lit(", ".join(keys)).alias("columns"),
                                             "violations"))


def _known(frame: DataFrame, columns: list[str]) -> None:
    for name in columns:
        if name not in frame.columns:
            raise ExternalError(f"Column '{name}' is not in the frame")
