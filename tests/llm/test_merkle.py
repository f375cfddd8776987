from pyspark.sql import functions as F

from crossfeed.llm import merkle


def marks(spark, *texts):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["m"] for r in frame.select("i", merkle.fingerprint(F.col("t")).alias("m")).orderBy("i").collect()]


def compare(spark, left, right, function):
    a, b = marks(spark, left, right)
    return spark.createDataFrame([(a, b)], "a string, b string").select(function(F.col("a"), F.col("b")).alias("x")).first()["x"]


def test_roots_tell_texts_apart(spark):
    texts = ["", "a", "a\n", "\na", "a\n\nb", "a\nb", "a b", "a" * 64, "a" * 65, "a" * 128, " ", "ä", "a\n \nb"]
    found = marks(spark, *texts, None)
    assert len({m.split(":")[0] for m in found[:-1]}) == len(texts) and found[-1] == found[0]


def test_differences_are_located(spark):
    paragraphs = [f"paragraph number {i} " * 5 for i in range(60)]
    changed = [*paragraphs]
    changed[30] = "something else"
    left, right = "\n".join(paragraphs), "\n".join(changed)
    assert compare(spark, left, right, merkle.differing_paragraphs) == [30]
    assert len(compare(spark, left, right, merkle.differing_sections)) == 1
    assert compare(spark, left, left, merkle.differing_sections) == []
    assert 0.9 < compare(spark, left, right, merkle.likeness) < 1


def test_likeness_bounds(spark):
    assert compare(spark, "", "", merkle.likeness) == 1.0
    assert compare(spark, "", "abc", merkle.likeness) == 0.0
    assert compare(spark, "abc def", "xyz", merkle.likeness) == 0.0


def test_next_document(odd_docs, no_docs):
    rows = merkle.with_next(odd_docs).collect()
    order = sorted(((r["doc_id"], r["text"]) for r in odd_docs.collect()),
                   key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    expected = sorted((str(a[0]), a[1] or "", b[1] or "") for a, b in zip(order, order[1:] + order[:1]))
    assert sorted((str(r["doc_id"]), r["text"], r["next_text"]) for r in rows) == expected
    assert merkle.with_next(no_docs).count() == 0


def test_one_document_is_its_own_next(spark):
    row = merkle.with_next(spark.createDataFrame([(5, "abc")], "doc_id long, text string")).collect()
    assert [(r["text"], r["next_text"]) for r in row] == [("abc", "abc")]
