import pytest

from crossfeed.llm import decontam

ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango"
NOISE = " ".join(f"noise{i}" for i in range(300))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, "too short to tell"), (3, None), (None, ITEM), (4, ""), (5, ITEM + " uniform victor")],
                                 "item_id long, text string")


def found(spark, items, *texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontam.overlaps(docs, items).collect()}


def test_substitutions_are_tolerated(spark, items):
    words = ITEM.split()
    for at in (4, 9, 16):
        words[at] = "other"
    hits = found(spark, items, f"{NOISE} {ITEM.upper()}. {NOISE}", f"{NOISE} {' '.join(words)} {NOISE}", NOISE, " ".join(ITEM.split()[:8]),
                 "Two short to tell", f"{NOISE} {' '.join(ITEM.split()[:14])} {NOISE}")
    assert {d for d, _ in hits} == {0, 1, 5}
    exact, near = hits[0, 1], hits[1, 1]
    assert (exact["doc_start"], exact["item_start"], exact["length"], exact["matched"]) == (300, 0, 20, 20)
    assert near["matched"] == 14 and near["length"] == 16
    assert hits[5, 1]["length"] == 14


def test_documents_that_begin_or_end_inside_an_item(spark, items):
    words = ITEM.split()
    hits = found(spark, items, " ".join(words[3:]), f"{' '.join(words[5:])} {NOISE}", f"{NOISE} {' '.join(words[:15])}")
    places = {k: tuple(hits[k, 1][c] for c in ("doc_start", "item_start", "length", "matched")) for k in range(3)}
    assert places == {0: (0, 3, 17, 17), 1: (0, 5, 15, 15), 2: (300, 0, 15, 15)}


def test_odd_rows(spark, items, odd_docs, no_docs):
    assert decontam.overlaps(odd_docs, items).count() == 0
    assert decontam.overlaps(no_docs, items).count() == 0
    assert decontam.overlaps(odd_docs, items.limit(0)).count() == 0
    assert decontam.clean(odd_docs, items).count() == odd_docs.count()
    bad = spark.createDataFrame([(7, ITEM, 1), (7, ITEM, 1), (8, NOISE, 1)], "doc_id long, text string, matched int")
    assert decontam.overlaps(bad, items).filter("item_id = 1").count() == 1
    assert [r["doc_id"] for r in decontam.clean(bad, items).collect()] == [8]
