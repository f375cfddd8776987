"""Texts are cut, looked up and scored as whole batches, with the results of one text at a time."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from crossfeed.llm import maxent

ODD = [None, "", " \t\n\v\f\r", "a", "  The tHE É\x0bx\x0cy\r\n", "İ K ſ\u0085\xa0z\x1c\x1f", "a\x00b  c", "zz " * 50]


def plain(text):
    return [*(text or "").encode().lower().split(), b""]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_and_end_of_every_text(kind):
    assert maxent.tokens(pa.array(ODD, kind)).to_pylist() == [plain(t) for t in ODD]
    assert maxent.tokens(pa.array(ODD, kind).slice(3, 2)).to_pylist() == [plain(t) for t in ODD[3:5]]


def test_texts_of_a_batch_have_their_own_contexts():
    words = [w for t in ODD for w in plain(t)]
    lex = maxent.Lexicon([b"", b"zz", b"the"], [8, 50, 2])
    parts = list(maxent._read(lex, pa.array(ODD), 5))
    assert [(p[0], p[1]) for p in parts] == list(maxent.runs(np.array([len(plain(t)) for t in ODD]), 5))
    assert np.concatenate([p[3] for p in parts]).tolist() == [{b"": 0, b"zz": 1, b"the": 2}.get(w, -1) for w in words]
    alone = [lex.read(plain(t)) for t in ODD]
    assert np.concatenate([p[4] for p in parts]).tolist() == [k for a in alone for k in a[1]]
    assert (np.concatenate([p[5] for p in parts]) == np.concatenate([maxent.context(a[2]) for a in alone])).all()
    assert [w for p in parts for w in p[6]] == [w for a in alone for w in a[3]]


def test_runs_end_with_the_text_that_fills_them():
    assert list(maxent.runs(np.array([3, 3, 3, 9, 1]), 6)) == [(0, 2), (2, 4), (4, 5)]
    assert list(maxent.runs(np.array([3, 3, 3, 9, 1]), 6, 5)) == [(0, 1), (1, 3), (3, 4), (4, 5)]
    assert list(maxent.runs(np.array([], np.int32), 6)) == []


def test_scoring_makes_no_exponentials(monkeypatch):
    """Those of the weights are made once; the tokens only multiply them."""
    rng = np.random.default_rng(4)
    weights = rng.normal(0, 0.5, (maxent.FEATURES + 1, maxent.CLASSES)).astype(np.float32)
    features = rng.integers(0, maxent.FEATURES, (700, maxent.ORDERS)).astype(np.uint16)
    kind = rng.integers(0, maxent.CLASSES, 700)
    whole, powers = maxent.chances_of(weights, features, kind), maxent.powers_of(weights)
    monkeypatch.setattr(np, "exp", None)
    assert maxent.chances_of(weights, features, kind, powers) == pytest.approx(whole, abs=1e-4)


def test_exponentials_at_the_end_of_their_range():
    rng = np.random.default_rng(5)
    weights = rng.choice([-19.9, 19.9], (51, maxent.CLASSES)).astype(np.float32)
    features = rng.integers(0, 50, (500, maxent.ORDERS)).astype(np.uint16)
    kind = rng.integers(0, maxent.CLASSES, 500)
    whole = maxent.log_chances(weights.astype(float), features)[np.arange(500), kind]
    powers = maxent.powers_of(weights)
    assert whole.min() < -100 and maxent.chances_of(weights, features, kind, powers) == pytest.approx(whole, abs=1e-3)
    assert maxent.powers_of(weights * 1.01) is None


def test_sums_of_features_met_once_and_often():
    rng = np.random.default_rng(7)
    times = [1, 1, 2, 5, maxent.OFTEN - 1, maxent.OFTEN, maxent.OFTEN + 1, 60]
    column = rng.permutation(np.repeat(np.arange(len(times)) * 3, times)).astype(np.uint16)
    slope = rng.normal(size=(len(column), maxent.CLASSES))
    rows, met, sums = maxent._sums(slope, column)
    assert dict(zip(rows.tolist(), met.tolist())) == Counter(column.tolist())
    for row, total in zip(rows, sums):
        assert total == pytest.approx(slope[column == row].sum(0))


def test_a_worker_makes_its_lexicon_once():
    class Shared:
        value = ([b"", b"a"], [3, 1])

    other = Shared()
    other.value = ([b"b"], [1])
    first = maxent._lexicon(Shared())
    assert maxent._lexicon(Shared()) is first and maxent._lexicon(other).words.to_pylist() == [b"b"]


def test_counts_that_are_passed_on_early(monkeypatch):
    monkeypatch.setattr(maxent, "FLUSH", 3)
    batches = [pa.record_batch([pa.array(ODD[i:i + 2])], ["text"]) for i in range(0, len(ODD), 2)]
    found = Counter()
    for batch in maxent._counted(iter(batches)):
        for row in batch.to_pylist():
            found[row["word"]] += row["n"]
    assert found == Counter(w for t in ODD for w in plain(t))
    assert list(maxent._counted(iter([]))) == []


def test_ids_and_scores_do_not_depend_on_the_batches(spark):
    """Large ids stay exact beside a NULL one."""
    big = 2 ** 53 + 1
    docs = spark.createDataFrame([(None if i == 1 else big + i, t) for i, t in enumerate(ODD)], "doc_id long, text string").coalesce(1)
    model = maxent.train(docs)
    rows = {r["doc_id"]: r for r in maxent.score(docs, model).collect()}
    assert set(rows) == {None if i == 1 else big + i for i in range(len(ODD))}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        again = {r["doc_id"]: r for r in maxent.score(docs, model).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    learned = Counter(w for t in ODD for w in plain(t))
    size = sum(learned.values()) + len(learned) + 1
    for i, text in enumerate(ODD):
        row, other = (found[None if i == 1 else big + i] for found in (rows, again))
        assert row["base_score"] == pytest.approx(sum(math.log10((learned[w] + 1) / size) for w in plain(text)))
        assert (row["n_tokens"], row["n_known"]) == (len(plain(text)),) * 2
        assert other["score"] == pytest.approx(row["score"]) and other["base_score"] == pytest.approx(row["base_score"])
