"""Value conversions between external columns and Spark, as column expressions.

Reading: ``as_*`` give a column one of the documented types; strict forms raise on overflow or bad text, ``strict=False``
gives NULL instead. ``as_text`` is the fixed text format of every type, used by ``all_varchar``. Writing:
``writable`` brings every column to a type external drivers accept.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.errors import ExternalError
from crossfeed.functions.remote_types import TIME_NAMES, UUID_NAMES

UUID_PATTERN = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
LONG_TEXT_NAMES = ("clob", "nclob")

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATS = (T.FloatType, T.DoubleType)


def _cast(column: Column, name: str, strict: bool) -> Column:
    return column.cast(name) if strict else column.try_cast(name)


def as_boolean(column: Column) -> Column:
    """An integer is true when it is not zero."""
    return column != F.lit(0)


def as_integer(column: Column, width: str = "bigint", strict: bool = True) -> Column:
    """``tinyint``, ``smallint``, ``int`` or ``bigint``; the value has to fit, and text has to be a whole number."""
    if width not in ("tinyint", "smallint", "int", "bigint"):
        raise ExternalError(f"No conversion to integer type '{width}'")
    return _cast(column, width, strict)


def as_real(column: Column, width: str = "double", strict: bool = True) -> Column:
    if width not in ("float", "double"):
        raise ExternalError(f"No conversion to floating type '{width}'")
    return _cast(_cast(column, "double", strict), width, strict)


def as_decimal(column: Column, precision: int = 38, scale: int = 0, strict: bool = True) -> Column:
    """Exact decimal, rounded half away from zero at ``scale``."""
    return _cast(column, f"decimal({precision},{scale})", strict)


def as_date(column: Column) -> Column:
    return column.cast("date")


def as_time(column: Column) -> Column:
    """Time of day as ``HH:mm:ss`` text."""
    return F.date_format(column, "HH:mm:ss")


def as_timestamp(column: Column) -> Column:
    """Timestamp without zone; a date becomes its midnight. Microseconds are kept."""
    return column.cast("timestamp_ntz")


def as_uuid(column: Column) -> Column:
    """Lower-case UUID text, NULL where the text is not a UUID."""
    return F.when(column.rlike(UUID_PATTERN), F.lower(column))


def as_binary(column: Column) -> Column:
    return column.cast("binary")


def as_text(column: Column, kind: T.DataType) -> Column:
    """The text every external type is shown as when all columns are asked for as text.

    Integers as they are, floats with six decimals, flags as 1 or 0, dates as ``yyyy-MM-dd``, timestamps with their
    offset (``+0000`` without a zone), decimals with their scale, bytes as UTF-8.
    """
    if isinstance(kind, T.StringType):
        return column
    if isinstance(kind, T.BooleanType):
        return column.cast("int").cast("string")
    if isinstance(kind, _INTEGERS + (T.DecimalType,)):
        return column.cast("string")
    if isinstance(kind, _FLOATS):
        number = column.cast("double")
        infinite = F.abs(number) == F.lit(float("inf"))
        return (F.when(number.isNull(), F.lit(None).cast("string"))
                .when(F.isnan(number), F.lit("nan"))
                .when(infinite, F.when(number > 0, "inf").otherwise("-inf"))
                .otherwise(_six_decimals(number)))
    if isinstance(kind, T.DateType):
        return F.date_format(column, "yyyy-MM-dd")
    if isinstance(kind, T.TimestampNTZType):
        return F.concat(F.date_format(column, "yyyy-MM-dd HH:mm:ss"), F.lit(" +0000"))
    if isinstance(kind, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss Z")
    if isinstance(kind, T.BinaryType):
        return column.cast("string")
    raise ExternalError(f"No text format for type '{kind.simpleString()}'")


def _six_decimals(number: Column) -> Column:
    """A finite number with six decimals, rounded as C does: by its exact binary value, halves to even.

    The JVM rounds the shortest decimal that stands for a number, and halves up. The two can differ only where the
    seventh decimal may be a lone 5 and for large numbers; those cells go to Python in Arrow batches.
    """
    scaled = F.abs(number) * F.lit(1e6)
    near_half = F.abs(scaled - F.floor(scaled) - F.lit(0.5)) < F.lit(0.01)
    large = F.abs(number) >= F.lit(1e9)
    exact = F.coalesce(large | near_half, F.lit(False))

    @F.pandas_udf("string")
    def formatted(cells: pd.Series) -> pd.Series:
        return pd.Series([None if math.isnan(cell) or math.isinf(cell) else f"{cell:f}" for cell in cells], dtype=object)

    return F.coalesce(formatted(F.when(exact, number)), F.when(~exact, F.format_string("%f", number)))


def all_text(frame: DataFrame) -> DataFrame:
    """Every column in its text format."""
    return frame.select(*[as_text(column_of(field.name), field.dataType).alias(field.name) for field in frame.schema])


def column_of(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def normalised(frame: DataFrame) -> DataFrame:
    """Columns whose remote type has no Spark type of its own, in their agreed form.

    Columns left alone stay plain references, so filters on them still reach the database. Long text is passed
    through an expression on purpose: databases refuse equality tests on it, and Spark pushes no filter on one.
    """
    columns, changed = [], False
    for field in frame.schema:
        remote = str(field.metadata.get("jdbcClientType", field.metadata.get("remoteType", ""))).lower()
        column = column_of(field.name)
        if remote in TIME_NAMES and isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            column, changed = as_time(column).alias(field.name), True
        elif remote in UUID_NAMES and isinstance(field.dataType, T.StringType):
            column, changed = as_uuid(column).alias(field.name), True
        elif remote in LONG_TEXT_NAMES and isinstance(field.dataType, T.StringType):
            column, changed = F.concat(column, F.lit("")).alias(field.name), True
        columns.append(column)
    return frame.select(*columns) if changed else frame


def narrow_columns(schema: T.StructType) -> str:
    """A ``customSchema`` for integer columns Spark's JDBC source would read wider than they are; "" if none."""
    narrow = {"smallint": "SMALLINT", "int2": "SMALLINT", "tinyint": "TINYINT"}
    wanted = []
    for field in schema:
        target = narrow.get(str(field.metadata.get("jdbcClientType", "")).lower())
        signed = field.metadata.get("isSigned", True)
        if target and signed and isinstance(field.dataType, T.IntegerType):
            escaped = field.name.replace("`", "``")
            wanted.append(f"`{escaped}` {target}")
    return ", ".join(wanted)


def writable(frame: DataFrame) -> DataFrame:
    """Columns in the types external drivers bind; a type without a conversion is an error that names it.

    Flags and narrow integers become 32-bit integers, floats become doubles. Text, bytes, wide integers, decimals,
    dates and timestamps stay.
    """
    columns = []
    for field in frame.schema:
        column, kind = column_of(field.name), field.dataType
        if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType)):
            column = column.cast("int").alias(field.name)
        elif isinstance(kind, T.FloatType):
            column = column.cast("double").alias(field.name)
        elif not isinstance(kind, (T.IntegerType, T.LongType, T.DoubleType, T.DecimalType, T.StringType, T.BinaryType,
                                   T.DateType, T.TimestampType, T.TimestampNTZType)):
            raise ExternalError(f"Cannot write column '{field.name}': no conversion for type '{kind.simpleString()}'")
        columns.append(column)
    return frame.select(*columns)
