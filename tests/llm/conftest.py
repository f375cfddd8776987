import pytest
from pyspark.sql import types as T

#: Columns that nobody asked for, named like ones that operators use inside.
CLASHING = ("size", "rank", "score", "node", "key", "h", "range", "mark", "row", "label", "copies", "u", "n", "word", "own")


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with NULLs everywhere, empty and very long texts, ties and repeated rows, and clashing columns."""
    prose = "the people of this town have known for a long time that the river is not to be crossed in spring\n"
    texts = [
        None, "", "   \n\t ", "one", "Two words", prose, prose, prose * 40, "x" * 200_000, ("ab cd ef " * 20_000).strip(),
        "mail a.b@mail1.example.com or +1 (212) 555-0199, host 10.0.0.1, card 4111 1111 1111 1111", "héllo wörld ñ ß",
        prose.upper(), prose + " and some more words at the end", "1.2.3.4.5 4111111111111112 +12 @ a@b",
    ]
    rows = [(i, t, ["en", None, "fr"][i % 3], ["s1", "s2", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, prose, "en", "s1", None), (None, None, None, None, None)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType()),
                           *[T.StructField(c, T.IntegerType()) for c in CLASHING]])
    return spark.createDataFrame([r + tuple(range(len(CLASHING))) for r in rows], schema).coalesce(3).cache()


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)
