"""Mixing sources to target weights by Pareto order sampling, in DataFrame operations only.

Every source has a target number of words. A document is expected ``rate`` times in the mix (target over size of its
source, tilted by an optional weight): the whole part of that is certain, the fraction is an inclusion probability p.
Documents of a source are ranked by random odds over inclusion odds, (u / (1 - u)) / (p / (1 - p)), and are taken in
that order up to the first that does not fit. What is then missing is filled in the same order by documents of at most
half of what is missing, again and again: a pass ends when the next one does not fit, and then less than half is missing
still, or when they are used up, and then at most one of the others fits. So the passes are as many as the target has
binary digits at most. At last each source takes the one document that brings its words nearest to the target, if one does.

No source is ranked in one task. The rank is cut into ``CELLS`` cells; the sums of the cells (one row per source and
cell) show which cell the target falls into, its rows are cut once more, and what is left there is summed by equal rank.
Rows that agree in rank have the same id and text; the one that does not fit is then found by the rows of each partition.
"""

from __future__ import annotations

import itertools
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crossfeed.llm.common import measured, removed, settled, word_count
from crossfeed.operators.checkpoints import shared_folder

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A source or document is taken this many times at most.
LIMIT = 3
#: Cells per level; two levels leave one row in about a million of a source to be sorted.
CELLS = 1024


def uniform(key: Column, text: Column, seed: str) -> Column:
    """A number in (0, 1) that depends on the key, the text and the seed only; 52 bits of an MD5 digest.

    The text counts so that rows which share an id, or have none, still differ.
    """
    own = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    digest = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(key.cast("string"), F.lit("")), F.lit("|"), own).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, ...) with one row per source, and its ``target``.

    The targets share the sum of all sizes by weight. None exceeds ``limit`` times its source's size; the excess goes to
    the others by weight. With the sources in order of limit x size / weight the capped ones come first, so one pass of
    running sums finds them. The table has a row per source, whatever the number of documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), turn + 1)
    frame = (sources.withColumn("source_weight", weight)
             .withColumn("cap", F.col("source_size") * limit)
             .withColumn("ratio", F.col("cap") / F.col("source_weight")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    onward = in_order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("source_weight").over(onward))
    frame = frame.withColumn("level", level).withColumn("capped", F.col("level") > F.col("ratio"))
    shared = F.max(F.when(~F.col("capped"), F.col("level"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(F.col("source_weight") * shared)
    return frame.withColumn("target", target).drop("cap", "ratio", "level", "capped", "source_weight")


def _narrowed(rows: DataFrame, keys: list[str], words: Column, more: tuple[str, ...] = ()) -> DataFrame:
    """(source, ``keys``, left): of each source the first group by ``keys`` at which the running sum exceeds ``room``.

    ``left`` is what the groups before leave of the room. Sources whose rows all fit are not in the result.
    """
    groups = rows.groupBy("source", *keys).agg(F.sum(words).alias("words"), F.first("room").alias("room"),
                                               *[F.first(name).alias(name) for name in more])
    upto = Window.partitionBy("source").orderBy(*keys).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    groups = groups.withColumn("upto", F.sum("words").over(upto)).filter(F.col("upto") > F.col("room"))
    left = (F.col("room") - (F.col("upto") - F.col("words"))).alias("left")
    return (groups.groupBy("source").agg(F.min(F.struct(*keys, left, *more)).alias("cut"))
            .select(F.col("source").alias("cut_source"), *[F.col(f"cut.{name}").alias(f"cut_{name}") for name in keys],
                    F.col("cut.left").alias("left"), *[F.col(f"cut.{name}").alias(f"cut_{name}") for name in more]))


def _inside(rows: DataFrame, cut: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of the groups that were cut, with what is left for them as ``room``."""
    cut = measured(settled(cut))
    same = rows["source"].eqNullSafe(F.col("cut_source"))
    for key in keys:
        same = same & rows[key].eqNullSafe(F.col(f"cut_{key}"))
    return (rows.join(cut, same).withColumn("room", F.col("left"))
            .drop("cut_source", "left", *[f"cut_{key}" for key in keys]))


def first_not_fitting(rows: DataFrame) -> DataFrame:
    """(cut_source, cut) of rows (source, rank, doc_id, size, row, room): of each source the first row that does not fit.

    ``cut`` is its struct(rank, id_null, doc_id, size, row); rows before it, in that order, fit into the room. Sources
    whose rows all fit are not in the result.
    """
    place = F.col("rank") / (1 + F.col("rank"))
    for cells in (CELLS, CELLS * CELLS):
        rows = rows.withColumn("cell", F.floor(place * cells))
        rows = _inside(rows, _narrowed(rows, ["cell"], F.col("size")), ["cell"]).drop("cell")
    # rows of equal rank are alike: how many of them fit tells which of them does not
    alike = ["rank", "id_null", "doc_id", "size"]
    rows = _inside(rows, _narrowed(rows, alike, F.col("size")), alike)
    rows = rows.withColumn("room", F.floor(F.col("room") / F.col("size"))).withColumn("part", F.shiftright("row", 33))
    rows = _inside(rows, _narrowed(rows, ["part"], F.lit(1)), ["part"])
    # what is left lies in one partition of the input
    cut = _narrowed(rows.withColumn("one", F.lit(1)), ["row"], F.col("one"), tuple(alike))
    return cut.select("cut_source", F.struct(*[F.col(f"cut_{name}").alias(name) for name in (*alike, "row")]).alias("cut"))


def _with_picked(rows: DataFrame, passes: DataFrame) -> DataFrame:
    """``rows`` with ``picked``: whether one of the passes of their source takes them.

    A pass takes the rows of at most ``most`` words, or all rows where that is NULL, that come before its ``cut``, or all
    of them where that is NULL.
    """
    joined = rows.join(measured(passes), rows["source"].eqNullSafe(F.col("pass_source")))
    order = F.struct("rank", "id_null", "doc_id", "size", "row")
    size = F.col("size")
    taken = F.exists("passes", lambda one: ((one["most"].isNull() | ((size > 0) & (size <= one["most"])))
                                            & (one["cut"].isNull() | (order < one["cut"]))))
    return joined.withColumn("picked", F.col("rank").isNotNull() & taken).drop("pass_source", "passes")


def _one_more(passes: DataFrame, most: Column, candidates: DataFrame, path: str) -> DataFrame:
    """``passes`` (pass_source, passes if there are any yet, and what ``most`` needs) with the pass that takes the
    candidates up to the first that does not fit.

    The passes are kept apart from the rows, one line per source, as a table under ``path``: the rows are written once,
    and neither plans nor Spark's estimates of sizes, which a checkpoint keeps and joins multiply, grow by passes.
    """
    cut = measured(settled(first_not_fitting(candidates)))
    joined = passes.join(cut, passes["pass_source"].eqNullSafe(F.col("cut_source")), "left")
    step = F.struct(most.cast("double").alias("most"), F.col("cut").alias("cut"))
    steps = F.concat("passes", F.array(step)) if "passes" in passes.columns else F.array(step)
    made = joined.select("pass_source", steps.alias("passes"))
    made.write.parquet(path)
    return made.sparkSession.read.schema(made.schema).parquet(path)


def _missing(rows: DataFrame) -> DataFrame:
    """(missing_source, missing): the words that each source still lacks."""
    words = (F.col("certain") + F.col("picked").cast("long")) * F.col("size")
    return measured(settled(rows.groupBy(F.col("source").alias("missing_source"))
                            .agg((F.first("target") - F.sum(words)).alias("missing"))))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weight_col: str | None = None, weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT,
        seed: str = "mix") -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, copies, taken (copies x size).

    ``weight_col`` tilts the expected copies of the documents inside a source; without it all are alike. NULL texts
    have size 0; documents of size 0 get copies like others, for no words. NULL is a source of its own, after the
    others; a NULL or negative weight counts as 0. Repeated rows are separate documents; ties of the rank go by doc_id,
    size and place in the table. An empty table gives an empty result. Other columns of ``docs`` are not looked at.
    """
    weight = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    sizes = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size"),
        F.greatest(F.coalesce(weight, F.lit(0.0)), F.lit(0.0)).alias("weight"), uniform(F.col(id_col), F.col(text_col), seed).alias("u"))
    sizes = settled(sizes.withColumn("row", F.monotonically_increasing_id()).withColumn("id_null", F.col("doc_id").isNull()))

    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                          F.sum(F.col("weight") * F.col("size")).alias("weighted"))
    targets = measured(settled(source_targets(sources, weights, limit).withColumnRenamed("source", "target_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    tilt = F.when(F.col("weighted") > 0, F.col("weight") * (F.col("source_size") / F.col("weighted"))).otherwise(1.0)
    rows = (sizes.join(targets, sizes["source"].eqNullSafe(F.col("target_source")))
            .withColumn("expected", F.least(F.lit(float(limit)), rate * tilt))
            .withColumn("certain", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("certain"))
            .withColumn("rank", F.when(F.col("p") > 0, (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))))
            .drop("target_source", "weight", "weighted", "u", "expected", "p"))
    certain = rows.groupBy("source").agg(F.sum(F.col("certain") * F.col("size")).alias("sure")) \
        .withColumnRenamed("source", "sure_source")
    certain = measured(settled(certain))
    rows = (rows.join(certain, rows["source"].eqNullSafe(F.col("sure_source")))
            .withColumn("room", F.col("target") - F.col("sure")).drop("sure_source", "sure"))

    rows = settled(rows)
    none = targets.select(F.col("target_source").alias("pass_source"))
    folder = f"{shared_folder(docs.sparkSession)}/mix-{uuid.uuid4().hex}"
    passes = _one_more(none, F.lit(None), rows.filter("rank IS NOT NULL"), f"{folder}/0")
    rows = rows.drop("room")
    for number in itertools.count(1):
        current = _with_picked(rows, passes)
        missing = _missing(current)
        half = missing.select(F.col("missing_source").alias("limit_source"), (F.col("missing") / 2).alias("most"),
                              F.col("missing").alias("room"))
        small = current.filter("NOT picked AND rank IS NOT NULL AND size > 0")
        small = (small.join(measured(half), small["source"].eqNullSafe(F.col("limit_source")))
                 .filter(F.col("size") <= F.col("most")).drop("limit_source", "most"))
        if small.isEmpty():
            break
        limits = passes.join(measured(half), passes["pass_source"].eqNullSafe(F.col("limit_source")))
        passes = _one_more(limits, F.col("most"), small, f"{folder}/{number}")
    rows = settled(current)
    removed(docs.sparkSession, folder)
    picked = _top_up(rows, missing)
    copies = F.col("certain") + F.col("picked").cast("long")
    return picked.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def _top_up(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """Takes, per source, the one open document that brings the words nearest to the target, if one brings them nearer."""
    open_rows = rows.filter(~F.col("picked") & F.col("rank").isNotNull() & (F.col("size") > 0))
    best = (open_rows.join(missing, open_rows["source"].eqNullSafe(F.col("missing_source")))
            .withColumn("off", F.abs(F.col("missing") - F.col("size"))).filter(F.col("off") < F.col("missing"))
            .groupBy("source").agg(F.min(F.struct("off", "rank", "doc_id", "row")).alias("best"))
            .select(F.col("best.row").alias("best_row")))
    joined = rows.join(measured(settled(best)), rows["row"] == F.col("best_row"), "left")
    return joined.withColumn("picked", F.col("picked") | F.col("best_row").isNotNull()).drop("best_row")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, limit: int = LIMIT) -> DataFrame:
    """The rows of ``docs`` that the mix takes, with all their columns and ``copies`` (once or more).

    Rows that share an id get the fewest copies that the mix gives one of them. A column ``copies`` of ``docs`` is
    replaced.
    """
    plan = mix(docs, id_col, text_col, source_col, None, weights, limit)
    plan = settled(plan.groupBy(F.col("doc_id").alias("__taken_id")).agg(F.min("copies").alias("__copies"))
                   .filter("__copies > 0"))
    joined = docs.join(measured(plan), docs[id_col].eqNullSafe(F.col("__taken_id")))
    return joined.withColumn("copies", F.col("__copies")).drop("__taken_id", "__copies")
