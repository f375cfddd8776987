"""What the operators of this subpackage share: words, held-out rows, measured sides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfeed.operators.checkpoints import checkpointed

#: A word is a run of anything but space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: A side is broadcast only if it was counted to hold no more rows than this; rows are a few numbers wide.
SMALL_ROWS = 200_000

#: Text goes to Python in batches of this many bytes at most; a longer text is a batch of its own.
BATCH_BYTES = 16 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_small_batches(frame: DataFrame) -> DataFrame:
    """The same frame, after lowering the session's limit of an Arrow batch to ``BATCH_BYTES`` if it is higher.

    Python workers hold a batch several times over; the setting is the session's, so it stays lowered.
    """
    session = frame.sparkSession
    limit = session._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(session.conf.get(BATCH_SETTING))
    if not 0 < limit <= BATCH_BYTES:
        session.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return frame


def word_count(text: Column) -> Column:
    """Words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def remainder_is(key: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the key as text leaves this remainder; false for NULL."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def settled(frame: DataFrame) -> DataFrame:
    """The frame, computed once and kept where every executor can read it."""
    return checkpointed(frame)


def measured(frame: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A settled frame, marked for broadcast if it was counted to be small; otherwise joins shuffle it."""
    return F.broadcast(frame) if frame.count() <= rows else frame


def most_frequent(counts: DataFrame, size: int) -> DataFrame:
    """The rows of a settled frame with the largest counts ``n``, ``size`` at most.

    All rows whose count is in the classes of about one percent that fit as a whole; there are some thousand classes,
    however many rows, so nothing is sorted and no task keeps ``size`` rows.
    """
    step = F.floor(F.log2(F.col("n")) * 64)
    classes = sorted(((row["step"], row["rows"]) for row in counts.groupBy(step.alias("step"))
                      .agg(F.count("*").alias("rows")).collect()), reverse=True)
    total, least = 0, None
    for name, rows in classes:
        total += rows
        if total > size:
            break
        least = name
    return counts.filter(F.lit(False) if least is None else step >= least)


def drawn(key: str, rows: int, total: int) -> Column:
    """Whether a row is among about ``rows`` of ``total``, by a hash of its key; always, if there are no more."""
    if total <= rows:
        return F.lit(True)
    return F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1 << 30)) < F.lit(int((1 << 30) * (rows / total)))


def sampled(frame: DataFrame, key: str, rows: int) -> DataFrame:
    """About ``rows`` rows of a frame, or all if there are fewer, by a hash of their key."""
    return frame.filter(drawn(key, rows, frame.count()))


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that this session wrote."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
