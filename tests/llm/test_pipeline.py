import re

from pyspark.sql import functions as F

import corpus_pipeline
from crossfeed.llm import decontam, mixing, setsketch

SF_DIR = "/root/testdata/sf0.01"


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, labels = docs.columns, {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"] for r in docs.select("doc_id").collect()}
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        kept[name] = {r["doc_id"] for r in after.select("doc_id").collect()}
        assert kept[name] <= before
        if number < 4:
            assert after.columns == columns
        if number == 0:
            known = [i for i in before if i in labels]
            assert sum((i in kept[name]) == (labels[i] == 1) for i in known) > 0.97 * len(known)
        if number == 1:
            rows = setsketch.near_duplicates(docs).collect()
            assert kept[name] == {r["component_id"] for r in rows}
        if number == 2:
            items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
            assert before - kept[name] == {r["doc_id"] for r in decontam.overlaps(docs, items).collect()}
            texts = [" ".join(r["text"].lower().split()) for r in items.collect()]
            assert not [1 for r in after.collect() for t in texts if t in " ".join(r["text"].lower().split())]
        if number == 3:
            assert kept[name] == before
            changed = docs.join(after.select("doc_id", F.col("text").alias("new")), "doc_id").filter("text <> new").collect()
            assert changed and all(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r["new"]) for r in changed)
            assert after.filter(F.col("text").rlike(r"\S+@\S+\.example\.com")).isEmpty()
        if number == 4:
            plan = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect()}
            assert {r["doc_id"]: r["copies"] for r in after.collect()} == {i: c for i, c in plan.items() if c}
        docs = after
    run = corpus_pipeline.run(spark, SF_DIR)
    assert {r["doc_id"] for r in run.select("doc_id").collect()} == kept["mixing sources to target weights"]
