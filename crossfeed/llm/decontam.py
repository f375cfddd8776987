"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask selects some of the tokens of a window and ignores the others, so a seed still matches when ignored tokens were
replaced. Seeds of the test items and of the documents are joined by hash. A hit fixes how document and item are laid
over each other; there all their tokens are compared and the best stretch is found, with ``MISMATCH`` taken off for
each differing token. A document is contaminated by an item if that stretch has ``MIN_TOKENS`` tokens or the whole item,
and enough of them are equal; or, as that stretch leaves out ends that do not pay, if any stretch of that many tokens has
enough equal ones. The masks miss no such stretch. Items too short for that are found as they are.

The items are a stated set of queries: their seeds are counted, and broadcast if they are few, so that documents are not
shuffled; if they are many, the joins shuffle. All masks begin with two selected tokens. Positions whose two tokens
follow each other nowhere in the items are dropped before any mask is hashed, which loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import measured, settled

#: Selected places of each mask; every mask selects the first two. The short ones catch what the others miss of stretches
#: of 9 to 20 tokens with four fifths equal; longer stretches contain such a one.
MASKS = ((0, 1, 3, 6, 7, 8), (0, 1, 2, 5, 7, 8), (0, 1, 4, 5, 6, 8), (0, 1, 3, 4, 5), (0, 1, 2, 3, 4))
SHORTEST = min(mask[-1] + 1 for mask in MASKS)
#: Texts with fewer tokens are not looked at, as they tell nothing apart from chance.
SPAN = 5
#: Items with fewer tokens count only where the whole of them is in a document, token by token.
VERBATIM = 9
#: A stretch has to be this long, or as long as the item if that is shorter.
MIN_TOKENS = 13
MIN_EQUAL = 0.8
MISMATCH = 3
#: Taken off for each differing token where a stretch with a share of ``MIN_EQUAL`` comes to zero.
EVEN = round(MIN_EQUAL / (1 - MIN_EQUAL))
#: ASCII characters that are no letters or digits end a token.
BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def tokens(text: Column) -> Column:
    """Lower-cased tokens of a text; none for NULL."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BREAKS), lambda token: token != "")


def _hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda token: F.xxhash64(token))


def _pairs(hashes: Column) -> Column:
    """For each place one number for its token and the one after it; NULL at the last place."""
    after = F.slice(hashes, F.lit(2), F.greatest(F.size(hashes), F.lit(1)))
    return F.zip_with(hashes, after, lambda a, b: F.xxhash64(a).bitwiseXOR(b))


def _seeds(hashes: Column, at: Column) -> Column:
    return F.array_compact(F.array(*[
        F.when(at + mask[-1] < F.size(hashes),
               F.struct(F.lit(m).alias("mask"),
                        F.xxhash64(F.lit(m), *[F.get(hashes, at + place) for place in mask]).alias("seed")))
        for m, mask in enumerate(MASKS)]))


def _positions(frame: DataFrame, key: str) -> DataFrame:
    """(key, h, at, pair) for every place a mask fits at."""
    return (frame.filter(F.size("h") >= SPAN).select(key, "h", F.posexplode(_pairs(F.col("h"))).alias("at", "pair"))
            .filter(F.col("at") + SHORTEST <= F.size("h")))


def _best_stretch(equal: Column) -> Column:
    """The stretch with the best score: struct(score, start, length, matched); the first to end, then the shortest."""
    zero = [F.lit(0).alias(n) for n in ("cur", "start", "matched", "at", "score", "best_start", "length", "best_matched")]

    def step(s: Column, same: Column) -> Column:
        fresh = s["cur"] <= 0
        cur = F.when(fresh, F.lit(0)).otherwise(s["cur"]) + F.when(same, 1).otherwise(-MISMATCH)
        start = F.when(fresh, s["at"]).otherwise(s["start"])
        matched = F.when(fresh, F.lit(0)).otherwise(s["matched"]) + F.when(same, 1).otherwise(0)
        better = cur > s["score"]
        return F.struct(cur.alias("cur"), start.alias("start"), matched.alias("matched"), (s["at"] + 1).alias("at"),
                        F.when(better, cur).otherwise(s["score"]).alias("score"),
                        F.when(better, start).otherwise(s["best_start"]).alias("best_start"),
                        F.when(better, s["at"] + 1 - start).otherwise(s["length"]).alias("length"),
                        F.when(better, matched).otherwise(s["best_matched"]).alias("best_matched"))

    return F.aggregate(equal, F.struct(*zero), step)


def _even_stretch(equal: Column, least: Column) -> Column:
    """Of stretches of at least ``least`` tokens the best if ``EVEN`` is taken off: struct(score, start, length).

    The score is negative if none has a share of ``MIN_EQUAL``. A stretch ends at each place and begins where the sum
    before it is lowest, at least ``least`` tokens earlier.
    """
    names = {"at": 0, "sum": 0, "late": 0, "low": 0, "low_at": 0, "score": -1, "start": 0, "length": 0}
    worth = lambda same: F.when(same, 1).otherwise(-EVEN)

    def step(s: Column, same: Column) -> Column:
        at, total = s["at"] + 1, s["sum"] + worth(same)
        late = s["late"] + F.when(at > least, worth(F.get(equal, at - least - 1))).otherwise(0)
        lower = (at > least) & (late <= s["low"])
        low, low_at = F.when(lower, late).otherwise(s["low"]), F.when(lower, at - least).otherwise(s["low_at"])
        better = (at >= least) & (total - low > s["score"])
        return F.struct(at.alias("at"), total.alias("sum"), late.alias("late"), low.alias("low"), low_at.alias("low_at"),
                        F.when(better, total - low).otherwise(s["score"]).alias("score"),
                        F.when(better, low_at).otherwise(s["start"]).alias("start"),
                        F.when(better, at - low_at).otherwise(s["length"]).alias("length"))

    return F.aggregate(equal, F.struct(*[F.lit(x).alias(n) for n, x in names.items()]), step)


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, doc_start, item_start, length, matched): the best stretch of each document and item that overlap.

    Starts and lengths are in tokens. NULL and empty texts overlap with nothing, nor do texts with fewer than ``SPAN``
    tokens. Items with fewer than ``VERBATIM`` tokens are found only as a whole and without a difference. Rows with a NULL id are left out. Repeated rows count once per id;
    of several best stretches the one with most equal tokens, then the shortest, then the first is given; one that holds
    only with its ends comes after the others. Empty tables give an empty result. Other columns are not looked at.
    """
    documents = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    queries = (items.select(F.col(item_col).alias("item_id"), _hashes(F.col(item_text_col)).alias("h"))
               .filter(F.col("item_id").isNotNull() & (F.size("h") >= SPAN)).distinct())
    queries = settled(queries)
    places = _positions(queries, "item_id").select("item_id", "pair", "at", F.explode(_seeds(F.col("h"), F.col("at"))).alias("s"))
    places = settled(places.select("item_id", "pair", F.col("at").alias("item_at"), "s.mask", "s.seed"))
    pairs = measured(settled(places.select("pair").distinct()))
    seeds = measured(places.select("item_id", "item_at", "mask", "seed"))

    # a hit is small: the document, the item and how far they are shifted against each other
    hits = (_positions(documents.select("doc_id", _hashes(F.col("text")).alias("h")), "doc_id")
            .join(pairs, "pair", "left_semi")
            .select("doc_id", "at", F.explode(_seeds(F.col("h"), F.col("at"))).alias("s"))
            .select("doc_id", "at", "s.mask", "s.seed")
            .join(seeds, ["mask", "seed"])
            .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    hits = settled(hits)

    ids = measured(settled(hits.select("doc_id").distinct()))
    found = documents.join(ids, "doc_id", "left_semi").select("doc_id", _hashes(F.col("text")).alias("h"))
    # of a document only the part that an item can cover goes on with each hit
    longest = queries.agg(F.coalesce(F.max(F.size("h")), F.lit(0)).alias("n")).first()["n"]
    first = F.greatest(F.col("shift"), F.lit(0))
    covered = found.join(hits, "doc_id").select("doc_id", "item_id", "shift", F.slice("h", first + 1, F.lit(longest)).alias("h"))
    laid = covered.join(queries.withColumnRenamed("h", "q"), "item_id")
    equal = F.transform(F.col("q"), lambda token, i: F.coalesce(
        F.when(i + F.col("shift") >= 0, F.get(F.col("h"), i + F.col("shift") - first) == token), F.lit(False)))
    laid = laid.select("doc_id", "item_id", "shift", F.least(F.lit(MIN_TOKENS), F.size("q")).alias("least"),
                       equal.alias("equal"))
    laid = laid.withColumn("b", _best_stretch(F.col("equal")))
    enough = ((F.col("b.length") >= F.col("least")) & (F.col("b.best_matched") >= MIN_EQUAL * F.col("b.length"))
              & ((F.col("least") >= VERBATIM) | (F.col("b.best_matched") == F.col("least"))))
    laid = laid.withColumn("whole", F.when(~enough, _even_stretch(F.col("equal"), F.col("least"))))
    taken = F.when(enough, F.struct(F.lit(0).alias("by"), F.col("b.best_matched").alias("matched"),
                                    F.col("b.length").alias("length"), F.col("b.best_start").alias("start")))
    taken = taken.when((F.col("whole.score") >= 0) & (F.col("least") >= VERBATIM), F.struct(
        F.lit(1).alias("by"), ((F.col("whole.score") + EVEN * F.col("whole.length")) / (EVEN + 1)).cast("int").alias("matched"),
        F.col("whole.length").alias("length"), F.col("whole.start").alias("start")))
    laid = laid.select("doc_id", "item_id", "shift", taken.alias("t"))
    best = F.min(F.struct("t.by", (-F.col("t.matched")).alias("lost"), F.col("t.length").alias("length"),
                          (F.col("t.start") + F.col("shift")).alias("doc_start"), F.col("t.start").alias("item_start")))
    return (laid.filter("t IS NOT NULL").groupBy("doc_id", "item_id").agg(best.alias("best"))
            .select("doc_id", "item_id", F.col("best.doc_start").cast("long").alias("doc_start"),
                    F.col("best.item_start").cast("long").alias("item_start"),
                    F.col("best.length").cast("long").alias("length"),
                    (-F.col("best.lost")).cast("long").alias("matched")))


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap with no item, with all their columns. Rows with a NULL id stay."""
    found = measured(settled(overlaps(docs, items, id_col, text_col).select("doc_id").distinct()))
    found = found.withColumnRenamed("doc_id", "__contaminated")
    return docs.join(found, docs[id_col] == F.col("__contaminated"), "left_anti")
