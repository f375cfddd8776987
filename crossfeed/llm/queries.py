"""The registered queries of the operators; ``sql.py`` has the SQL with the same rows where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crossfeed.llm import (
    codes,
    decontam,
    infill,
    langid,
    maxent,
    merkle,
    mixing,
    pii,
    quality,
    setsketch,
    toolcalls,
    toxicity,
    urls,
)
from crossfeed.llm.common import remainder_is
from crossfeed.llm.sql import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> dict:
    """Learned from the labels of documents that are not held out."""
    labels = table(spark, sf_dir, "labels")
    return quality.train(docs, labels.filter(~remainder_is(F.col("doc_id"), 3, 1)))


@query
def op1_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = quality.score(docs, quality_model(spark, sf_dir, docs))
    return scores.select("doc_id", remainder_is(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


@query
def op3_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = merkle.with_next(table(spark, sf_dir, "documents"))
    pairs = pairs.withColumn("edited", merkle.edited(F.col("text"), F.col("next_text")))
    pairs = pairs.withColumn("edited_mark", merkle.fingerprint(F.col("edited")))
    return pairs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), F.col("mark").alias("fingerprint"),
        F.col("edited_mark").alias("edited_fingerprint"),
        merkle.likeness(F.col("mark"), F.col("edited_mark")).alias("near_edited"),
        merkle.likeness(F.col("mark"), F.col("next_mark")).alias("near_next"),
        F.size(merkle.differing_sections(F.col("mark"), F.col("edited_mark"))).cast("long").alias("n_sections_changed"))


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone",
                        F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")


@query
def op5_segmented_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.train(pages))


@query
def op6_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_is(F.col("doc_id"), 4, 2)
    found = langid.predict(docs, langid.train(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op7_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Tools of the calls that op8 reads out of a conversation.
CHAT_TOOLS = {
    "instruct": {"required": ["text"], "properties": {"text": {"type": "string"}, "turn": {"type": "integer"}},
                 "additionalProperties": False},
    "reply": {"required": ["text", "turn"], "additionalProperties": False,
              "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 400},
                             "turn": {"type": "integer", "minimum": 0}}},
}


@query
def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of a conversation as a tool call or a result.

    A user's turn calls ``reply``, after the user's turn two before it; a system turn calls ``instruct``. An assistant's
    turn is the result of the call one turn before. Identifiers are ``conversation:turn``, NULL if either is.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")

    def identifier(shift: int):
        return F.concat(F.col("conv_id").cast("string"), F.lit(":"), (F.col("turn") - shift).cast("string"))

    asked = F.col("role").isin("user", "system")
    calls = turns.filter(asked).select(
        identifier(0).alias("call_id"), F.col("turn").alias("seq"),
        F.when(F.col("role") == "user", "reply").otherwise("instruct").alias("name"),
        F.to_json(F.struct("turn", "text")).alias("arguments"),
        F.when((F.col("role") == "user") & (F.col("turn") >= 2), identifier(2)).alias("parent_id"))
    results = turns.filter(~F.coalesce(asked, F.lit(False))).select(
        identifier(1).alias("call_id"), F.col("turn").alias("seq"), F.col("text").alias("content"))
    return toolcalls.link(calls, results, CHAT_TOOLS)


@query
def op9_setsketch_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


@query
def op10_maxent_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder_is(F.col("doc_id"), 7, 2)
    scores = maxent.score(docs, maxent.train(docs.filter(~held_out)))
    return scores.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learned from the labels of documents that are not held out."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    scores = toxicity.score(docs, toxicity.train(docs, labels.filter(~remainder_is(F.col("doc_id"), 3, 1))))
    return scores.select("doc_id", remainder_is(F.col("doc_id"), 3, 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = infill.transform(table(spark, sf_dir, "documents"))
    moved = moved.withColumn("restored", infill.restored(F.col("output"), F.col("form")))

    def digest(name: str):
        return F.sha2(F.col(name).cast("binary"), 256).alias(f"{name}_sha256")
    return moved.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))
