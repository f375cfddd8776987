"""The toxicity classifier: held-out accuracy, the effect of the swaps, odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfeed.llm import toxicity
from crossfeed.llm.common import remainder_is

INSULTS = ("blockhead", "numbskull", "dimwit")
PLAIN = "garden river stone bread winter letter window table music morning bridge paper forest silver market".split()


def sentences(spark, seed=3, rows=900):
    """Toxic sentences often name one group and hold an insult; harmless ones rarely name it."""
    rng, made = random.Random(seed), []
    for i in range(rows):
        toxic = i % 3 == 0
        words = rng.choices(PLAIN, k=12)
        if rng.random() < (0.6 if toxic else 0.02):
            words.insert(rng.randrange(6), "muslims")
        if toxic and rng.random() < 0.9:
            words.insert(rng.randrange(6), rng.choice(INSULTS))
        made.append((i, " ".join(words) + ".", int(toxic)))
    return spark.createDataFrame(made, "doc_id long, text string, toxic int").coalesce(4)


def scores_of(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [row["score"] for row in toxicity.score(docs, model).orderBy("doc_id").collect()]


def test_swaps_clear_neutral_mentions(spark):
    frame = sentences(spark)
    free = toxicity.train(frame, frame, swap_weight=0.0)
    bound = toxicity.train(frame, frame)
    texts = ["garden river muslims bread winter.", "garden river people bread winter.", "garden river christians bread winter.",
             "garden river dimwit bread winter.", "muslims stone dimwit market."]
    loose, tied = scores_of(spark, free, texts), scores_of(spark, bound, texts)
    assert loose[0] - loose[1] > 0.3, "without swaps the mention itself counts"
    assert max(tied[:3]) - min(tied[:3]) < 0.05 and max(tied[:3]) < 0.5
    assert min(tied[3:]) > 0.7


def test_versions():
    versions = toxicity.swapped("Women sing. It rains! A blind man.", swaps=2)
    assert versions[0] == ["sing", "it", "rains", "a"]
    assert versions[1][:4] == ["men", "sing", "it", "rains"] and versions[1][5:] == ["adult", "girl"]
    assert toxicity.swapped("It rains.") == [] == toxicity.swapped(None)


def test_fit_meets_its_gradient():
    rng = np.random.default_rng(0)
    rows = [sorted(rng.choice(8, 3, replace=False).tolist()) for _ in range(60)]
    y = np.array([0 in row for row in rows])
    changes = [([1], [2]), ([3], [])]
    w, b = toxicity.fit(rows, y, changes, 8, swap_weight=2.0)

    def loss(v):
        z = np.array([v[row].sum() + v[8] for row in rows])
        share = np.where(y, 0.5 / y.sum(), 0.5 / (~y).sum())
        moved = np.array([v[1] - v[2], v[3]])
        return (share * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * 2.0 * (moved ** 2).mean() \
            + 0.5 * toxicity.RIDGE * (v[:8] ** 2).sum() + 0.5e-8 * v[8] ** 2
    at = np.append(w, b)
    for place in range(9):
        step = np.zeros(9)
        step[place] = 1e-4
        assert abs(loss(at + step) - loss(at - step)) / 2e-4 < 1e-4


@pytest.mark.parametrize("sf", ["sf0.1"])
def test_held_out_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    labels = spark.read.parquet(f"/root/testdata/{sf}/labels.parquet")
    held = remainder_is(F.col("doc_id"), 3, 1)
    model = toxicity.train(docs, labels.filter(~held))
    told = (toxicity.score(docs.join(labels.filter(held).select("doc_id"), "doc_id", "left_semi"), model)
            .join(labels, "doc_id").select("toxic", "score").toPandas())
    assert ((told["score"] >= 0.7) == (told["toxic"] == 1)).mean() >= 0.98
    assert (told[told["toxic"] == 0]["score"] >= 0.7).mean() <= 0.01


def test_odd_documents(spark, odd_docs, no_docs):
    labels = odd_docs.select("doc_id", F.when(F.length("text") > 100, 1).when(F.col("doc_id") < 6, 0).alias("toxic"))
    model = toxicity.train(odd_docs, labels)
    scores = toxicity.score(odd_docs, model)
    rows = scores.collect()
    assert len(rows) == odd_docs.count() and all(0 <= row["score"] <= 1 for row in rows)
    empty = {row["score"] for row in scores.join(odd_docs.filter("text IS NULL OR text = ''").select("doc_id"), "doc_id").collect()}
    assert len(empty) == 1
    assert toxicity.score(no_docs, model).collect() == []
    untaught = toxicity.train(no_docs, labels.limit(0))
    assert {row["score"] for row in toxicity.score(odd_docs, untaught).collect()} == {0.5}
