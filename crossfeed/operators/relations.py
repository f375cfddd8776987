"""Joins with relations whose size has to be known first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.functions.types import column_of

BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 * 1024 * 1024
_ROW_OVERHEAD = 16


def measured_size(frame: DataFrame, row_limit: int = BROADCAST_ROWS) -> tuple[int, int]:
    """Rows and bytes of a frame, counted up to just over ``row_limit`` rows.

    The counting is a job; the driver gets two numbers.
    """
    size = F.lit(_ROW_OVERHEAD)
    for field in frame.schema:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(column_of(field.name)), F.lit(0)) + F.lit(8)
        else:
            size = size + F.lit(_fixed_width(field.dataType))
    row = (frame.select(size.cast("bigint").alias("size")).limit(row_limit + 1)
           .agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first())
    return row["rows"], row["bytes"]


def _fixed_width(kind: T.DataType) -> int:
    return 16 if isinstance(kind, T.DecimalType) else 8


def small_side(frame: DataFrame, row_limit: int = BROADCAST_ROWS, byte_limit: int = BROADCAST_BYTES) -> DataFrame:
    """``frame`` marked for broadcast if it was measured to be small; otherwise as it is, for a shuffled join that
    adaptive execution splits where keys are skewed. External sources report no size, so it has to be measured."""
    rows, size = measured_size(frame, row_limit)
    return F.broadcast(frame) if rows <= row_limit and size <= byte_limit else frame


def join_relation_parameter(frame: DataFrame, relation: DataFrame, on: Column | list[str],
                            how: str = "inner") -> DataFrame:
    """A relation passed as a parameter of a query: joined, and broadcast when it is small."""
    return frame.join(small_side(relation), on, how)


def one_sided_join_count(left: DataFrame, left_test: Column, right: DataFrame, right_test: Column,
                         name: str = "n") -> DataFrame:
    """Row count of a join whose conditions each look at one side only.

    All pairs would be formed; their number is the product of two counts, each taken where the rows are.
    """
    sides = (left.filter(left_test).agg(F.count(F.lit(1)).alias("l")).withColumn("r", F.lit(None).cast("bigint"))
             .unionByName(right.filter(right_test).agg(F.count(F.lit(1)).alias("r"))
                          .withColumn("l", F.lit(None).cast("bigint"))))
    return sides.agg((F.max("l") * F.max("r")).alias(name))
