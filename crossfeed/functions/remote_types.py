"""Remote SQL type names and the Spark types they are read as."""

from __future__ import annotations

import re

from pyspark.sql import types as T

# Remote type names, lower case, without length or scale.
SIMPLE_TYPES = {
    "bit": T.BooleanType(), "bool": T.BooleanType(), "boolean": T.BooleanType(),
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(), "int2": T.ShortType(),
    "int": T.IntegerType(), "integer": T.IntegerType(), "int4": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "float": T.DoubleType(), "float8": T.DoubleType(), "double": T.DoubleType(), "double precision": T.DoubleType(),
    "binary": T.BinaryType(), "varbinary": T.BinaryType(), "longvarbinary": T.BinaryType(),
    "blob": T.BinaryType(), "bytea": T.BinaryType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(), "datetime": T.TimestampNTZType(),
}
DECIMAL_NAMES = ("decimal", "numeric", "decimal_text")
TIME_NAMES = ("time",)
UUID_NAMES = ("uuid", "guid", "uniqueidentifier")
MAX_PRECISION = 38

_DECLARED = re.compile(r"^\s*([a-z0-9_ ]+?)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*$", re.IGNORECASE)


def base_name(declared: str) -> str:
    match = _DECLARED.match(declared or "")
    return match.group(1).lower() if match else ""


def spark_type(declared: str) -> T.DataType:
    """The Spark type of a declared remote type. A type that is not known is read as text."""
    match = _DECLARED.match(declared or "")
    if not match:
        return T.StringType()
    name = match.group(1).lower()
    if name in DECIMAL_NAMES:
        precision = int(match.group(2) or 0) or MAX_PRECISION
        return T.DecimalType(min(precision, MAX_PRECISION), int(match.group(3) or 0))
    return SIMPLE_TYPES.get(name, T.StringType())
