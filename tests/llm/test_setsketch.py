import numpy as np
import pytest

from crossfeed.llm import setsketch

SF_DIR = "/root/testdata/sf0.001"


def brute(docs, words, percent):
    """Smallest linked id of every document, by comparing all pairs of sets of words."""
    sets = {}
    for i, text in docs:
        tokens = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(tokens[k:k + words]) for k in range(max(1, len(tokens) - words + 1))) if tokens else frozenset()
    label = {i: i for i in sets}

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                label[y] = x
    return {i: (len(sets[i]), top(i)) for i in sets}


def compared(frame, words, percent):
    docs = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    found = {r["doc_id"]: r for r in setsketch.near_duplicates(frame, words=words, percent=percent).collect()}
    for i, (n, component) in brute(docs, words, percent).items():
        assert (found[i]["n_shingles"], found[i]["component_id"], found[i]["kept"]) == (n, component, component == i), i


@pytest.mark.parametrize("words, percent", [(3, 85), (5, 80)])
def test_given_documents(spark, words, percent):
    compared(spark.read.parquet(f"{SF_DIR}/documents.parquet"), words, percent)


@pytest.mark.parametrize("block, items", [(setsketch.BLOCK, setsketch.BLOCK_ITEMS), (2, 1 << 20), (64, 100)])
def test_families_around_the_threshold(spark, monkeypatch, block, items):
    """Chains and stars of edited copies: links between members that are no pivot decide the components, in blocks of any size."""
    monkeypatch.setattr(setsketch, "BLOCK", block)
    monkeypatch.setattr(setsketch, "BLOCK_ITEMS", items)
    rng = np.random.default_rng(1)
    docs, base = [], [f"w{i}" for i in range(60)]
    for family in range(4):
        words = [f"f{family}{w}" for w in base]
        for copy in range(30):
            edited = list(words)
            for at in rng.choice(len(edited), int(rng.integers(0, 4)), replace=False):
                edited[at] = f"e{rng.integers(3)}"
            docs.append((family * 100 + copy, " ".join(edited)))
            if copy % 7 == 0:
                words = edited
    compared(spark.createDataFrame(docs, "doc_id long, text string"), 3, 85)


def test_odd_rows(odd_docs, no_docs):
    rows = setsketch.near_duplicates(odd_docs, words=3, percent=85).collect()
    assert len(rows) == odd_docs.count()
    by = {r["doc_id"]: r for r in rows}
    assert all(by[i]["n_shingles"] == 0 and by[i]["component_id"] == i for i in (0, 1, 2))
    assert by[6]["component_id"] == by[12]["component_id"] == 5 and by[8]["n_shingles"] == 1
    assert all(r["kept"] and r["component_id"] is None for r in rows if r["doc_id"] is None)
    assert setsketch.near_duplicates(no_docs).count() == 0
    kept = setsketch.dedupe(odd_docs, words=3, percent=85)
    assert kept.columns == odd_docs.columns and kept.filter("doc_id IN (6, 12)").isEmpty()
    assert kept.filter("doc_id = 5").count() == 1 and kept.filter("doc_id IS NULL").collect()[0]["text"] is None


def test_one_row_of_each_component(spark):
    a, b = ("first " * 3 + "text of %d words that go on and on " * 4) % (1, 2, 3, 4), "another text with other words in it " * 5
    near = a + "end"
    rows = [(3, b), (7, a), (7, b), (9, near), (5, "x y z"), (5, "x y z"), (None, "p q r"), (None, "p q r"), (None, ""), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    kept = sorted(((r["doc_id"], r["text"]) for r in setsketch.dedupe(docs, words=3, percent=80).collect()), key=repr)
    assert kept == sorted([(3, b), (7, a), (5, "x y z"), (None, "p q r"), (None, ""), (None, "")], key=repr)


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << 63, 3000, dtype=np.uint64)
    for share in (0.2, 0.5, 0.9):
        shared = int(2000 * share)
        a, b = np.unique(pool[:2000]), np.unique(pool[2000 - shared:4000 - shared][:2000])
        union = np.union1d(a, b)
        ra, rb = setsketch.registers(a), setsketch.registers(b)
        assert (np.maximum(ra, rb) == setsketch.registers(union)).all()
        true = len(np.intersect1d(a, b)) / len(union)
        guess = setsketch.similarity(ra[None], rb[None], np.array([len(a)]), np.array([len(b)]))[0]
        assert abs(guess - true) < 0.15


def test_bands_follow_the_threshold():
    for threshold in (0.5, 0.8, 0.85, 0.95):
        rows = setsketch.band_rows(threshold)
        assert (1 - threshold**rows) ** (setsketch.REGISTERS // rows) <= setsketch.MISS
