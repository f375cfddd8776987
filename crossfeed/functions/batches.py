"""How much of a table Python gets at a time."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Rows go to Python in batches of this many bytes at most; a larger row is a batch of its own.
BATCH_BYTES = 8 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_bounded_batches(spark: SparkSession | None) -> None:
    """Lower the session's limit of an Arrow batch to ``BATCH_BYTES`` if it is higher; it stays lowered.

    A task holds a batch several times over, and batches of so many rows are as large as the rows happen to be.
    """
    if spark is None:
        return
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_SETTING))
    if not 0 < limit <= BATCH_BYTES:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
