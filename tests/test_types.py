import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.functions import types
from crossfeed.functions.remote_types import spark_type


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_numbers(spark):
    assert one(spark, types.as_boolean(F.lit(-3))) is True
    assert one(spark, types.as_boolean(F.lit(0))) is False
    assert one(spark, types.as_integer(F.lit(300), "tinyint", strict=False)) is None
    with pytest.raises(Exception, match="CAST_OVERFLOW|OVERFLOW"):
        one(spark, types.as_integer(F.lit(300), "tinyint"))
    assert one(spark, types.as_integer(F.lit("12abc"), "int", strict=False)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        one(spark, types.as_integer(F.lit("12abc"), "int"))
    assert one(spark, types.as_decimal(F.lit(0.125), 10, 2)) == Decimal("0.13")
    assert one(spark, types.as_decimal(F.lit(-0.125), 10, 2)) == Decimal("-0.13")
    assert one(spark, types.as_decimal(F.lit("12345678901234567890.123"), 38, 3)) == Decimal("12345678901234567890.123")
    assert one(spark, types.as_real(F.lit("1.5"), "float")) == 1.5


def test_times(spark):
    moment = F.lit("2024-02-29 23:59:59.123456").cast("timestamp_ntz")
    assert one(spark, types.as_date(moment)) == dt.date(2024, 2, 29)
    assert one(spark, types.as_time(moment)) == "23:59:59"
    assert one(spark, types.as_timestamp(moment)) == dt.datetime(2024, 2, 29, 23, 59, 59, 123456)
    assert one(spark, types.as_timestamp(types.as_date(moment))) == dt.datetime(2024, 2, 29)


def test_uuids(spark):
    good = "ABCDEF01-2345-6789-abcd-ef0123456789"
    assert one(spark, types.as_uuid(F.lit(good))) == good.lower()
    for bad in ("", "x", good + "0", good.replace("-", "")):
        assert one(spark, types.as_uuid(F.lit(bad))) is None


@pytest.mark.parametrize("sql, text", [
    ("1Y", "1"), ("9223372036854775807L", "9223372036854775807"), ("cast(1.1 AS float)", "1.100000"),
    ("2.5D", "2.500000"), ("cast('NaN' AS double)", "nan"), ("cast('-Infinity' AS double)", "-inf"),
    ("true", "1"), ("false", "0"), ("cast(1.50 AS decimal(10,3))", "1.500"), ("date'2024-02-29'", "2024-02-29"),
    ("timestamp_ntz'2024-02-29 01:02:03.9'", "2024-02-29 01:02:03 +0000"),
    ("timestamp'2024-02-29 01:02:03'", "2024-02-29 01:02:03 +0000"), ("X'6162'", "ab"), ("'word'", "word"),
    ("cast(NULL AS double)", None), ("cast(NULL AS boolean)", None)])
def test_text_format(spark, sql, text):
    frame = spark.sql(f"SELECT {sql} AS v")
    assert types.all_text(frame).first()["v"] == text


@pytest.mark.parametrize("declared, kind", [
    ("DECIMAL(10, 2)", T.DecimalType(10, 2)), ("numeric", T.DecimalType(38, 0)), ("VARCHAR(20)", T.StringType()),
    ("Double Precision", T.DoubleType()), ("FLOAT", T.DoubleType()), ("REAL", T.FloatType()), ("guid", T.StringType()),
    ("geometry", T.StringType()), ("", T.StringType()), ("TINYINT", T.ByteType()), ("smallint", T.ShortType()),
    ("datetime", T.TimestampNTZType()), ("VARBINARY(16)", T.BinaryType())])
def test_remote_type_names(declared, kind):
    assert spark_type(declared) == kind


def test_written_types(spark):
    frame = spark.sql("SELECT true AS a, 1Y AS b, 2S AS c, cast(1.5 AS float) AS d, 3L AS e, 1.50BD AS f, X'00' AS g")
    assert [kind for _, kind in types.writable(frame).dtypes] == ["int", "int", "int", "double", "bigint",
                                                                  "decimal(3,2)", "binary"]
