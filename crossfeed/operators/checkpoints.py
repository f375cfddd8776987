"""Where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

from crossfeed.errors import ExternalError

FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the session names it; in local mode, where it may be unset, a new one."""
    folder = spark.conf.get(FOLDER_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not is_local(spark):
        raise ExternalError(f"Set {FOLDER_SETTING} to a folder that every executor can reach")
    return tempfile.mkdtemp(prefix="crossfeed-")


def is_local(spark: SparkSession) -> bool:
    """Whether the executors live in the driver's own process."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def checkpointed(frame: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint()
