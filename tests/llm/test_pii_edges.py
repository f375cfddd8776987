"""What is found in a text does not depend on the texts beside it, nor on how rows are dealt out."""

import random

import numpy as np
import pytest

from crossfeed.llm import pii

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    made = []
    for row in docs.collect():
        spans = pii.base_spans(row["text"] or "")[0]
        made += [pii.windows(row["text"], n) for n in range(6)] if spans else []
    made = [window for group in made for window in group][:1500]
    return pii.fit([text for text, _ in made], [spans for _, spans in made])


@pytest.fixture(scope="module")
def texts():
    rng, numbers = random.Random(1), np.random.default_rng(1)
    values = [("email", "john.smith@mail5.example.com"), ("email", "a.b-c@host.example.org"), ("ip", "10.20.30.40"),
              ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0199")]
    return ["the words before it " * rng.randint(0, 3) + pii.rewritten(*rng.choice(values), numbers) + rng.choice(["", " x", ". And more text"])
            for _ in range(60)]


def test_alone_and_beside_others(model, texts):
    alone = [pii.all_spans([text], model)[0] for text in texts]
    assert sum(bool(added) for _, added in alone) > 10
    for text, expected in zip(texts, alone):
        for more in (1, 2, 7, 400, 600):
            for other in ("y" * (len(text) + more), "z" * max(0, len(text) - more)):
                assert pii.all_spans([text, other], model)[0] == expected
                assert pii.all_spans([other] * (more % 20) + [text], model)[-1] == expected
    assert pii.all_spans(texts, model) == alone


def test_partitions_do_not_matter(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    one = sorted(map(tuple, pii.find(docs.coalesce(1), model).collect()))
    assert one == sorted(map(tuple, pii.find(docs.repartition(7), model).collect()))


def test_rare_data_is_learned(spark, monkeypatch):
    """The sample is drawn among texts that look personal, so ten in thousands are enough."""
    rows = [(i, "plain words without any data in them") for i in range(3000)]
    rows += [(5000 + i, f"write to name{i}@host{i}.example.com today") for i in range(10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert pii.train(docs, sample_rows=20, other_rows=20) is not None
    assert pii.train(docs.filter("doc_id < 3000"), sample_rows=20, other_rows=20) is None


def test_windows_of_like_lengths_go_together(model, monkeypatch):
    """Steps behind the end of a text are few, however short and long texts alternate."""
    made, whole = [0], pii.emissions

    def counted(model, x, keep=False):
        made[0] += x.size
        return whole(model, x, keep)

    monkeypatch.setattr(pii, "emissions", counted)
    mixed = ["short" * 4, "long words " * 45] * (pii.LANES * 2)
    pii.all_spans(mixed, model)
    assert made[0] <= 1.1 * sum(map(len, mixed))


def test_training_reads_the_sample_once(spark, monkeypatch):
    """The texts are gone over twice: counted, and cut into windows."""
    calls = spark.sparkContext.accumulator(0)
    whole = pii.windows

    def counted(text, seed):
        calls.add(1)
        return whole(text, seed)

    monkeypatch.setattr(pii, "windows", counted)
    docs = spark.createDataFrame([(i, f"write to name{i}@host{i}.example.com today") for i in range(40)], "doc_id long, text string")
    assert pii.train(docs) is not None and calls.value == 40


def test_gradient_of_a_direction():
    rng = np.random.default_rng(8)
    x, n = rng.integers(0, pii._CLASSES, (6, 3)), pii.HIDDEN
    table, u = rng.normal(size=(4 * n, pii._CLASSES)).astype(np.float32), rng.normal(0, 0.3, (4 * n, n)).astype(np.float32)
    slope = rng.normal(size=(6, n, 3)).astype(np.float32)
    x[0, 0] = 5

    def loss():
        return float((pii._run(x, table, u, False)[0].astype(float) * slope).sum())

    d_table, d_u = pii._back(x, u, pii._run(x, table, u, True)[1], slope)
    tried = [(table, d_table, (k, int(c))) for k in range(0, 4 * n, 5) for c in x[:2].ravel() if c] \
        + [(u, d_u, (k, k % n)) for k in range(0, 4 * n, 5)]
    near = []
    for values, found, at in tried:
        kept = values[at]
        values[at] = kept + 1e-2
        more = loss()
        values[at] = kept - 1e-2
        less = loss()
        values[at] = kept
        near.append(abs((more - less) / 2e-2 - found[at]) < 0.02 + 0.02 * abs(found[at]))
    assert np.mean(near) > 0.9  # a gate may turn a corner between the two
