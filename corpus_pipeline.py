"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again by the next."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from crossfeed.llm import decontam, mixing, pii, quality, setsketch
from crossfeed.operators.checkpoints import shared_folder

#: The quality and personal-data stages are trained models, which SQL can't express.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranking does not reject. The threshold comes from the labels."""
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80% or more of its five-word shingles."""
    return setsketch.dedupe(docs, words=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by marks."""
    return pii.mask(docs, pii.train(docs))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix and how often it takes them (``copies``)."""
    return mixing.mixed(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("MinHash near-dedup", without_near_duplicates),
    ("benchmark decontamination", decontaminated),
    ("PII", without_personal_data),
    ("mixing sources to target weights", mixed_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. What each stage but the last returns is written to the shared folder.

    A stage's input is removed once its output is written.
    """
    folder = f"{shared_folder(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
        if number:
            _removed(spark, f"{folder}/{number - 1}")
    return STAGES[-1][1](spark, docs, sf_dir)


def _removed(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
