"""Vector codes against a plain search, with the bounds at work, over odd tables."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossfeed.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, q int, bounds string, sums string, n long, code string, error int"


def plain_codes(vectors, parts=8, entries=16, rounds=6, scale=4096):
    """(codes, errors, books) of whole-number vectors by full searches; rows in id order."""
    x = np.floor(np.asarray(vectors, np.float64) * scale).astype(object).reshape(len(vectors), parts, -1)
    books = [[list(row) for row in x[:entries, part]] for part in range(parts)]

    def nearest(part):
        return [min(range(len(books[part])), key=lambda e: (sum((a - b) ** 2 for a, b in zip(row, books[part][e])), e))
                for row in x[:, part]]
    for _ in range(rounds):
        for part in range(parts):
            found = nearest(part)
            for e in range(len(books[part])):
                mine = [row for row, f in zip(x[:, part], found) if f == e]
                if mine:
                    books[part][e] = [sum(column) // len(mine) for column in zip(*mine)]
    chosen = [nearest(part) for part in range(parts)]
    texts = ["".join("%02x" % chosen[part][row] for part in range(parts)) for row in range(len(x))]
    errors = [sum(sum((a - b) ** 2 for a, b in zip(x[row, part], books[part][chosen[part][row]])) for part in range(parts))
              for row in range(len(x))]
    return texts, errors, ",".join(str(int(y)) for part in books for entry in part for y in entry)


def clustered(rows, width=16, seed=3):
    rng = np.random.default_rng(seed)
    return (rng.normal(0, 1, (12, width))[rng.integers(0, 12, rows)] + rng.normal(0, 0.05, (rows, width))).astype(np.float32)


@pytest.mark.parametrize("small", [True, False])
def test_bounds_give_the_full_search(small):
    x = np.floor(clustered(3000) * 4096).astype(np.int64)
    shape = codes.Shape(1, x.shape[1], "<i8", small)
    books = x[None, :16].copy()
    kept = np.zeros(len(x), codes._BOUNDS)
    compared = []
    for number in range(8):
        compared.append(codes.assign(x, kept, books, shape, number == 0))
        squares = ((x[:, None] - books[-1][None]) ** 2).sum(2)
        assert (kept["entry"] == squares.argmin(1)).all()
        entry = kept["entry"]
        made = codes.next_book(books[-1], np.bincount(entry, minlength=16),
                               np.stack([x[entry == e].sum(0) for e in range(16)]))
        books = np.concatenate([books, made[None]])
    assert compared[0] == (0, len(x))
    # once the entries hardly move, most rows are not compared with all entries
    assert sum(full for _, full in compared[2:]) < 0.25 * 6 * len(x)


def test_true_displacement_is_tighter_than_summed_drifts():
    """Entries that go and come back: the bound of the first round holds again, so no row is compared."""
    x = np.array([[0], [1], [100], [101]], np.int64)
    there, moved = np.array([[[0], [100]]]), np.array([[[40], [60]]])
    kept = np.zeros(4, codes._BOUNDS)
    shape = codes.Shape(1, 1, "<i8", True)
    codes.assign(x, kept, there, shape, True)
    # net displacement between rounds 0 and 2 is zero, though the drifts sum to 80
    assert codes.assign(x, kept, np.concatenate([there, moved, there]), shape, False) == (0, 0)


def test_against_plain_search(spark):
    vectors = clustered(200)
    vectors[20:40] = vectors[0]
    rows = [(int(i), [float(v) for v in vector], None if i % 5 == 0 else int(i % 3), *[None] * 6) for i, vector in enumerate(vectors)]
    odd = [(300, None, 1, *[None] * 6), (301, [None] * 16, 1, *[None] * 6), (302, [float("nan")] * 16, 1, *[None] * 6),
           (-5, [float("inf")] + [0.0] * 15, 2, *[None] * 6)]
    frame = spark.createDataFrame(rows + odd, SCHEMA).repartition(5)
    texts, errors, book = plain_codes(vectors)
    sums = {}
    for row, error in zip(rows, errors):
        sums[row[2]] = sums.get(row[2], 0) + error
    digest = hashlib.sha256(book.encode()).hexdigest()
    expected = {(row[0], row[2], text, error, sums[row[2]], digest) for row, text, error in zip(rows, texts, errors)}
    assert {tuple(row) for row in codes.compress(frame).collect()} == expected


def test_null_and_repeated_ids_few_rows_no_rows(spark):
    few = [[0.5, -0.25], [0.5, -0.25], [3.0, 1.0]]
    frame = spark.createDataFrame([(1, few[0], 1, *[None] * 6), (1, few[1], 1, *[None] * 6), (None, few[2], None, *[None] * 6)], SCHEMA)
    found = codes.compress(frame, parts=2)
    texts, errors, book = plain_codes(few, parts=2)
    assert sorted((row["vec_id"] is None, row["vec_id"], row["code"], row["error"]) for row in found.collect()) \
        == [(False, 1, texts[0], 0), (False, 1, texts[1], 0), (True, None, texts[2], 0)]
    assert {row["codebooks_sha256"] for row in found.collect()} == {hashlib.sha256(book.encode()).hexdigest()}
    empty = codes.compress(frame.limit(0))
    assert empty.collect() == [] and empty.columns == found.columns
    assert codes.compress(frame.filter("vec_id IS NULL").withColumn("embedding", F.lit(None).cast("array<float>"))).collect() == []


def test_what_cannot_be_coded_is_an_error(spark):
    def frame(*vectors):
        return spark.createDataFrame([(i, v, None, *[None] * 6) for i, v in enumerate(vectors)], SCHEMA)
    for wrong in (frame([0.0] * 16, [0.0] * 8), frame([0.0] * 12), frame([1e30] * 8)):
        with pytest.raises(ValueError):
            codes.compress(wrong)
    with pytest.raises(ValueError):
        codes.compress(frame([0.0] * 8), entries=300)


def test_large_numbers_are_exact(spark):
    rng = np.random.default_rng(1)
    vectors = rng.integers(-2**26, 2**26, (60, 8)).astype(np.float64)
    frame = spark.createDataFrame([(i, [float(x) for x in v], 1, *[None] * 6) for i, v in enumerate(vectors)],
                                  SCHEMA.replace("array<float>", "array<double>"))
    texts, errors, _ = plain_codes(vectors, scale=1)
    found = sorted((row["vec_id"], row["code"], row["error"]) for row in codes.encode(frame, scale=1)[0].collect())
    assert found == [(i, text, error) for i, (text, error) in enumerate(zip(texts, errors))]


def test_hot_labels_by_broadcast_and_others_by_shuffle(spark, monkeypatch):
    coded = spark.createDataFrame([(i, None if i % 3 == 0 else i if i % 3 == 1 else -1, "", i) for i in range(300)],
                                  "vec_id long, label int, code string, error long")
    expected = sorted(tuple(row) for row in codes.with_label_error(coded).select("vec_id", "label_error").collect())
    monkeypatch.setattr(codes, "measured", lambda frame: frame)
    monkeypatch.setattr(codes, "HOT_SHARE", 0.1)
    assert sorted(tuple(row) for row in codes.with_label_error(coded).select("vec_id", "label_error").collect()) == expected
    sums = {}
    for i in range(300):
        sums.setdefault(i % 3 if i % 3 != 1 else f"x{i}", []).append(i)
    assert expected == sorted((i, sum(rows)) for rows in sums.values() for i in rows)
