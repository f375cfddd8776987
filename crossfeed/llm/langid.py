"""Language identification by nearest centroids of normalised TF-IDF character n-grams.

Texts are lower-cased, runs of other characters than letters become one blank, and all 1-, 2- and 3-grams are hashed to
``DIMENSIONS`` counters, of which logarithms are weighted by inverse document frequency over all learning documents and
normalised. Each language has several centroids, found by spherical k-means over a bounded sample of its documents, so
that styles and scripts need not be averaged. A text goes to the language of the centroid with the largest cosine; one
that is further from it than nearly all of that language's sample is marked as rejected.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import in_small_batches, measured, settled

DIMENSIONS = 4096
ORDERS = 3
#: Expected number of sampled documents per language that centroids are fitted to.
PER_LANGUAGE = 400
CENTROIDS = 4
KMEANS_ROUNDS = 10
#: Share of a language's sample that lies beyond its rejection distance.
REJECT = 0.005
UNKNOWN = "und"
#: Code points counted at a time.
SLICE = 1 << 20

_NO_LETTERS = re.compile(r"[\W\d_]+")
_PRIMES = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def counts(text: str | None) -> np.ndarray:
    """Counts of the hashed n-grams of a whole text; zeros if it has no letter."""
    out = np.zeros(DIMENSIONS, np.int64)
    if not has_letter(text):
        return out
    clean = " " + _NO_LETTERS.sub(" ", text.lower()).strip() + " "
    points = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), "<u4")
    for at in range(0, len(points), SLICE):
        part = points[at:at + SLICE + ORDERS - 1]
        gram = np.zeros(len(part), np.uint32)
        for k in range(ORDERS):
            gram = gram[:len(part) - k] * _PRIMES[0] + (part[k:] + np.uint32(k + 1)) * _PRIMES[1]
            mixed = (gram ^ (gram >> np.uint32(15))) * _PRIMES[2]
            out += np.bincount((mixed >> np.uint32(20))[:SLICE], minlength=DIMENSIONS)
    return out


def vector(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weighted = np.log1p(count) * idf
    norm = np.sqrt((weighted**2).sum())
    return weighted / norm if norm else weighted


def cluster(x: np.ndarray, seed: int = 3) -> np.ndarray:
    """Up to ``CENTROIDS`` unit centroids of unit rows by spherical k-means, spread out at the start."""
    rng = np.random.default_rng(seed)
    centres = [x[rng.integers(len(x))]]
    while len(centres) < min(CENTROIDS, len(x)):
        far = 1 - (x @ np.array(centres).T).max(1)
        if far.max() < 1e-9:
            break
        centres.append(x[rng.choice(len(x), p=np.maximum(far, 0) / np.maximum(far, 0).sum())])
    centre = np.array(centres)
    for _ in range(KMEANS_ROUNDS):
        nearest = (x @ centre.T).argmax(1)
        sums = np.array([x[nearest == k].sum(0) if (nearest == k).any() else centre[k] for k in range(len(centre))])
        centre = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
    return centre


def _document_frequencies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n = np.zeros(DIMENSIONS, np.int64), 0
    for batch in batches:
        for text in batch["text"]:
            total += counts(text) > 0
            n += 1
    yield pd.DataFrame({"place": np.append(np.arange(DIMENSIONS), -1), "n": np.append(total, n)})


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id",
          per_language: int = PER_LANGUAGE) -> dict:
    """A model from the texts and languages of ``docs``; ``key_col`` only decides which rows are sampled.

    Rows without a language or a letter teach nothing. An empty table gives a model without languages.
    """
    rows = in_small_batches(docs).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"),
                       F.col(key_col).cast("string").alias("key"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = (rows.select("text").mapInPandas(_document_frequencies, "place long, n long")
             .groupBy("place").agg(F.sum("n").alias("n")).toPandas().set_index("place")["n"])
    if found.empty or not found.get(-1, 0):
        return {"names": [], "centroids": np.zeros((0, DIMENSIONS), np.float32), "owner": [], "reach": []}
    idf = np.log((1 + found[-1]) / (1 + found.reindex(range(DIMENSIONS), fill_value=0).to_numpy())) + 1

    many = settled(rows.groupBy("lang").agg(F.count("*").alias("many")))
    chance = (F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    sample = rows.join(measured(many), "lang").filter(chance * F.col("many") < per_language).select("lang", "text")

    def centroids(frame: pd.DataFrame) -> pd.DataFrame:
        x = np.array([vector(counts(t), idf) for t in frame["text"] if has_letter(t)])
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "reach": []})
        centre = cluster(x)
        reach = float(np.quantile((x @ centre.T).max(1), REJECT))
        return pd.DataFrame({"lang": frame["lang"].iat[0], "centroid": list(centre), "reach": reach})

    fitted = sample.groupBy("lang").applyInPandas(centroids, "lang string, centroid array<double>, reach double")
    fitted = fitted.toPandas().sort_values("lang", kind="stable")
    names = sorted(set(fitted["lang"]))
    owner = np.array([names.index(x) for x in fitted["lang"]], int)
    reach = fitted.groupby("lang")["reach"].first()
    matrix = np.array(fitted["centroid"].tolist(), np.float32).reshape(len(fitted), -1)
    return {"names": names, "centroids": matrix, "owner": owner, "idf": idf,
            "reach": np.array([reach[n] for n in names])}


def predict(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row.

    ``lang_pred`` is the nearest language, whether rejected or not; ``und`` for texts that are NULL or have no letter,
    and for all if nothing was learned. ``score`` is the cosine to the nearest centroid, 0 for ``und``. Equal cosines go
    to the first language by name. Repeated rows stay. Other columns are not looked at.
    """
    named = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    names, centroids = model["names"], model["centroids"]

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs, scores, away = [], [], []
            for text in batch["text"]:
                if not names or not has_letter(text):
                    langs.append(UNKNOWN), scores.append(0.0), away.append(True)
                    continue
                near = centroids @ vector(counts(text), model["idf"]).astype(np.float32)
                best = int(near.argmax())
                langs.append(names[model["owner"][best]])
                scores.append(float(min(max(near[best], 0.0), 1.0)))
                away.append(bool(near[best] < model["reach"][model["owner"][best]]))
            yield pd.DataFrame({"doc_id": batch["doc_id"], "lang_pred": langs, "score": scores, "rejected": away})
    kind = named.schema["doc_id"].dataType.simpleString()
    return named.mapInPandas(rows, f"doc_id {kind}, lang_pred string, score double, rejected boolean")
