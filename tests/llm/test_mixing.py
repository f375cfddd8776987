import pytest
from pyspark.sql import functions as F

from crossfeed.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


def shares(sizes, weights, limit):
    """Targets by resharing the excess again and again."""
    total, names = sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    capped = {}
    while True:
        rest = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / max(sum(weight[s] for s in rest), 1e-9)
        over = [s for s in rest if level * weight[s] > limit * sizes[s]]
        if not over:
            return {**capped, **{s: level * weight[s] for s in rest}}
        capped.update({s: limit * sizes[s] for s in over})


def test_targets_and_sums(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixing.mix(docs).collect()
    sizes = {r["source"]: r["source_size"] for r in rows}
    expected = shares(sizes, mixing.WEIGHTS, mixing.LIMIT)
    for source in sizes:
        own = [r for r in rows if r["source"] == source]
        assert own[0]["target"] == pytest.approx(expected[source])
        assert sum(r["size"] for r in own) == sizes[source]
        missing = expected[source] - sum(r["taken"] for r in own)
        left = [r["size"] for r in own if r["copies"] < expected[source] / sizes[source] and r["size"]]
        assert all(abs(missing - size) >= abs(missing) for size in left)
    assert all(r["taken"] == r["copies"] * r["size"] and r["copies"] <= 3 for r in rows)


def test_reruns_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()))
    assert first == sorted(map(tuple, mixing.mix(docs.repartition(3, "source")).collect()))


def test_small_source_is_capped(spark):
    docs = spark.createDataFrame([(1, "a " * 10, "a")] + [(i, "b " * 10, "b") for i in range(2, 102)], "doc_id long, text string, source string")
    rows = {r["doc_id"]: r for r in mixing.mix(docs).collect()}
    assert rows[1]["copies"] == 3 and rows[1]["target"] == 30
    assert sum(r["taken"] for r in rows.values()) == 1010


def test_weights_tilt(spark):
    docs = spark.createDataFrame([(i, "w " * 5, "a", float(i % 2) * 3 + 0.5) for i in range(400)],
                                 "doc_id long, text string, source string, weight double")
    docs = docs.union(spark.createDataFrame([(1000 + i, "w " * 5, "b", 1.0) for i in range(400)], docs.schema))
    rows = mixing.mix(docs, weight_col="weight").filter("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.sum("copies").alias("c")).collect()
    taken = {r["odd"]: r["c"] for r in rows}
    assert taken[1] > 3 * taken[0]


def test_odd_rows(odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["size"] == 0 and r["taken"] == 0 for r in rows if r["doc_id"] in (0, 1, 2))
    assert mixing.mix(no_docs).count() == 0
    kept = mixing.mixed(odd_docs)
    assert set(odd_docs.columns) <= set(kept.columns) and kept.filter("copies < 1").isEmpty()
