"""Toxicity: a counterfactual-regularised logistic classifier.

Features are which words and word beginnings a text has, so a few words tell in a long text as in a short one, and
inflected forms share what they begin with. They are chosen by how far their odds differ between the labels of a bounded
sample. In every labelled sentence that names a group of people the term is swapped for others of its kind and for a
blank; the loss adds the squared change of the score to the logistic loss, so naming a group moves no score whatever
company the names keep in the sample. The blank has no weight that could follow the names. Fitted by Newton steps with conjugate gradients on sparse rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import in_small_batches, sampled, settled

#: Labelled documents, about, that the model is fitted to, and features at most that it has.
SAMPLE_ROWS, FEATURES = 12_000, 30_000
#: Features at most, the most frequent ones of toxic texts, that are counted in the others.
CANDIDATES = 300_000
#: A feature needs this many toxic texts, and odds that differ by so many standard errors.
LEAST, ERRORS = 3, 2.5
#: Lengths of word beginnings, and the longest word that is a feature as a whole.
PREFIXES, LONGEST = (4, 5, 6, 7, 8), 24
RIDGE, SWAP_WEIGHT = 1e-5, 4.0
NEWTON_STEPS, GRADIENT_STEPS = 12, 25
#: Swapped versions of a text that names a group.
SWAPS = 3
#: Words that a task remembers the features of; a fuller memory is emptied, which changes no score.
MEMORY = 1 << 18

#: Terms for groups of people by kind, and neutral words in their place.
IDENTITY_TERMS = (
    ("person", "woman", "man", "girl", "boy", "immigrant", "refugee", "foreigner"),
    ("people", "women", "men", "girls", "boys", "immigrants", "refugees", "foreigners"),
    ("religious", "muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("believers", "muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("local", "african", "american", "arab", "asian", "european", "mexican", "chinese", "indian", "polish", "turkish"),
    ("human", "black", "white", "latino", "gay", "lesbian", "straight", "transgender", "bisexual"),
    ("adult", "old", "young", "elderly", "disabled", "deaf", "blind"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge"),
    ("personnes", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "étrangers", "réfugiés"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "extranjeros", "refugiados"),
)

_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?\n])")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def word_features(word: str) -> list[str]:
    """The word, and its beginnings marked by a star."""
    whole = [word] if len(word) <= LONGEST else []
    return whole + [word[:size] + "*" for size in PREFIXES if len(word) > size]


def swapped(text: str | None, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, swaps: int = SWAPS) -> list[list[str]]:
    """The words of a text with the terms of its sentences swapped: for a blank, then for others of their kind.

    Empty if no sentence names a group. Sentences without a term are the same in every version.
    """
    kinds = {term: (kind, place) for kind in terms for place, term in enumerate(kind)}
    versions: list[list[str]] = [[] for _ in range(swaps)]
    named = False
    for sentence in _SENTENCE.split(text or ""):
        words = words_of(sentence)
        mentioned = [word for word in words if word in kinds]
        if not mentioned:
            for version in versions:
                version += words
            continue
        named = True
        for number, version in enumerate(versions):
            for word in words:
                if word not in kinds:
                    version.append(word)
                elif number:
                    kind, place = kinds[word]
                    version.append(kind[(place + number) % len(kind)])
    return versions if named else []


class Rows:
    """Sparse rows of ones: the places of row r are ``places[starts[r]:starts[r + 1]]``, with ``signs``."""

    def __init__(self, rows: list[list[int]], signs: list[list[float]] | None = None):
        sizes = np.array([len(row) for row in rows], np.int64)
        self.count = len(rows)
        self.rows = np.repeat(np.arange(len(rows)), sizes)
        self.places = np.array([place for row in rows for place in row], np.int64)
        self.signs = np.ones(len(self.places)) if signs is None else np.array([s for row in signs for s in row])

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, weights[self.places] * self.signs, self.count)

    def summed(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.places, values[self.rows] * self.signs, width)


def fit(features: list[list[int]], toxic: np.ndarray, changes: list[tuple[list[int], list[int]]], width: int,
        swap_weight: float = SWAP_WEIGHT) -> tuple[np.ndarray, float]:
    """(weights, bias) from the features of labelled texts and from (features gone, features new) of swapped versions.

    Both labels weigh the same in sum. The loss is the mean logistic loss, plus ``swap_weight`` / 2 times the mean squared
    change of the score by a swap, plus a ridge.
    """
    x, y = Rows([[*row, width] for row in features]), toxic.astype(float)
    signs = [[1.0] * len(gone) + [-1.0] * len(new) for gone, new in changes]
    swap = Rows([[*gone, *new] for gone, new in changes], signs)
    share = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    pull = swap_weight / max(swap.count, 1)
    ridge = np.full(width + 1, RIDGE)
    ridge[width] = 1e-8
    w = np.zeros(width + 1)

    def loss(w: np.ndarray) -> float:
        z = x.times(w)
        return float((share * (np.logaddexp(0, z) - y * z)).sum() + 0.5 * pull * (swap.times(w) ** 2).sum()
                     + 0.5 * (ridge * w * w).sum())

    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x.times(w), -30, 30)))
        slope = x.summed(share * (p - y), width + 1) + pull * swap.summed(swap.times(w), width + 1) + ridge * w
        curve = share * p * (1 - p)

        def bent(v: np.ndarray) -> np.ndarray:
            return (x.summed(curve * x.times(v), width + 1) + pull * swap.summed(swap.times(v), width + 1) + ridge * v)

        step, rest = np.zeros_like(w), -slope
        way, size = rest.copy(), float(rest @ rest)
        for _ in range(GRADIENT_STEPS):
            if size < 1e-16:
                break
            moved = bent(way)
            rate = size / float(way @ moved)
            step, rest = step + rate * way, rest - rate * moved
            size, before = float(rest @ rest), size
            way = rest + size / before * way
        now, length = loss(w), 1.0
        while length > 1e-3 and loss(w + length * step) > now:
            length /= 2
        w = w + length * step
    return w[:width], float(w[width])


def _labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample_rows: int) -> DataFrame:
    """(text, toxic) of the sampled labels' documents."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
             .filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = sampled(settled(known), "doc_id", sample_rows)
    named = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # the sample's size is bounded by the parameter; an id that many rows share gives as many, so they are cut off too
    return settled(named.join(F.broadcast(sample), "doc_id").select("text", "toxic").limit(2 * sample_rows))


class Reader:
    """The places of the features of a list of words; remembers words it has seen."""

    def __init__(self, index: dict[str, int]):
        self.index, self.seen = index, {}

    def __call__(self, words: list[str]) -> list[int]:
        found: set[int] = set()
        if len(self.seen) > MEMORY:
            self.seen.clear()
        for word in set(words):
            places = self.seen.get(word)
            if places is None:
                places = tuple(self.index[f] for f in word_features(word) if f in self.index)
                self.seen[word] = places
            found.update(places)
        return sorted(found)


def _chosen(sample: DataFrame, terms: tuple[tuple[str, ...], ...], least: int, errors: float) -> list[str]:
    """The features that ``least`` toxic texts have and whose odds differ between the labels, and the terms.

    The features of toxic texts are counted by name; the other texts are then read for those alone.
    """
    def toxic(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update({f for word in set(words_of(text)) for f in word_features(word)})
        if counts:
            yield pd.DataFrame({"feature": list(counts), "n": list(counts.values())})

    total = {row["toxic"]: row["n"] for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(total) < 2:
        return []
    bad = (sample.filter("toxic = 1").mapInPandas(toxic, "feature string, n long").groupBy("feature")
           .agg(F.sum("n").alias("n")).filter(F.col("n") >= least).orderBy(F.desc("n"), "feature").limit(CANDIDATES).collect())
    names, index = [row["feature"] for row in bad], {row["feature"]: place for place, row in enumerate(bad)}

    def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, counts = Reader(index), np.zeros(len(index), np.int64)
        for batch in batches:
            for text in batch["text"]:
                counts[reader(words_of(text))] += 1
        if counts.any():
            yield pd.DataFrame({"place": np.flatnonzero(counts), "n": counts[counts > 0]})

    good = sample.filter("toxic = 0").mapInPandas(others, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    b, g = np.array([row["n"] for row in bad], float), np.zeros(len(bad))
    for row in good.collect():  # a number per candidate at most
        g[row["place"]] = row["n"]
    b, g = b + 0.5, g + 0.5
    lead = np.abs(np.log(b / (total[1] + 1 - b)) - np.log(g / (total[0] + 1 - g))) / np.sqrt(1 / b + 1 / g)
    order = [place for place in np.argsort(-lead, kind="stable") if lead[place] >= errors][:FEATURES]
    return list(dict.fromkeys([names[place] for place in order] + [term for kind in terms for term in kind]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          sample_rows: int = SAMPLE_ROWS, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS,
          swap_weight: float = SWAP_WEIGHT, least: int = LEAST, errors: float = ERRORS) -> dict:
    """A model from ``labels`` (the id, 1 for toxic and 0 for not) of documents of ``docs``.

    Rows with a NULL id or label, and labels without a document, teach nothing; of several labels of an id the highest
    counts. NULL texts count as empty. The sample is about ``sample_rows`` ids, by a hash of the id.
    """
    sample = _labelled(docs, labels, id_col, text_col, label_col, sample_rows)
    index = {feature: place for place, feature in enumerate(_chosen(sample, terms, least, errors))}
    if not index:
        return {"index": {}, "weights": np.zeros(0), "bias": 0.0}

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(index)
        for batch in batches:
            rows = []
            for text, toxic in zip(batch["text"], batch["toxic"]):
                own = reader(words_of(text))
                rows.append((0, int(toxic), own, []))
                for version in swapped(text, terms):
                    other = reader(version)
                    gone, new = sorted(set(own) - set(other)), sorted(set(other) - set(own))
                    if gone or new:
                        rows.append((1, int(toxic), gone, new))
            if rows:
                yield pd.DataFrame(rows, columns=["kind", "toxic", "gone", "new"])

    # a few hundred numbers per row of the bounded sample
    rows = sample.mapInPandas(read, "kind int, toxic int, gone array<int>, new array<int>").toPandas()
    own, changed = rows[rows["kind"] == 0], rows[rows["kind"] == 1]
    weights, bias = fit([list(row) for row in own["gone"]], own["toxic"].to_numpy(),
                        list(zip(changed["gone"], changed["new"])), len(index), swap_weight)
    return {"index": index, "weights": weights, "bias": bias}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: 0 to 1, higher for toxic texts.

    NULL texts are scored like empty ones. Without a fitted model all scores are 0.5. Repeated rows stay. Other columns
    are not looked at. An empty table gives an empty result.
    """
    named = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    used = {feature: place for feature, place in model["index"].items() if model["weights"][place]}
    weights, bias = model["weights"], model["bias"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(used)
        for batch in batches:
            raw = np.array([bias + weights[reader(words_of(text))].sum() for text in batch["text"]], float)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "score": 1 / (1 + np.exp(-np.clip(raw, -30, 30)))})
    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInPandas(rows, f"doc_id {kind}, score double")
