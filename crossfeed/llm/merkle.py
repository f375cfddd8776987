"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections, in DataFrame operations only.

A paragraph is a line. Its leaves are its pieces of ``PIECE`` code points, each by the first 12 hex digits of its
SHA-256. A section ends after a blank paragraph and after a paragraph whose own digest starts with 0 (one in sixteen), so
an edit moves no section border further on. The digests of paragraphs, sections and the root are SHA-256 over the digests
below them.

A fingerprint is text: ``root:leaves``, where the leaves of a paragraph are joined by ``.`` and a paragraph ends with
``,``, or ``;`` if its section ends too. Equal roots mean equal texts; the digests of the inner nodes follow from the
leaves, so two fingerprints are enough to find the sections and paragraphs in which two texts differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = 64
LEAF_DIGITS = 12
#: Ranges of documents per shuffle partition when documents are put in order.
RANGES_PER_PARTITION = 4


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _paragraph(text: Column) -> Column:
    """The leaves of one paragraph and its border."""
    leaves = F.array_join(F.transform(F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0)),
                                      lambda piece: F.substring(_digest(piece), 1, LEAF_DIGITS)), ".")
    ends = (F.trim(text) == "") | F.startswith(_digest(leaves), F.lit("0"))
    return F.concat(leaves, F.when(ends, ";").otherwise(","))


def _section_digest(section: Column) -> Column:
    return _digest(F.array_join(F.transform(F.split(section, ","), _digest), ""))


def _sections(body: Column) -> Column:
    return F.split(body, ";")


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text. NULL has that of the empty text."""
    paragraphs = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), _paragraph)
    body = F.array_join(paragraphs, "")
    root = _digest(F.array_join(F.transform(_sections(body), _section_digest), ""))
    return F.concat(root, F.lit(":"), body)


def _body(mark: Column) -> Column:
    return F.substring_index(mark, ":", -1)


def leaves(mark: Column) -> Column:
    """The different leaves of a fingerprint."""
    return F.array_distinct(F.filter(F.split(_body(mark), "[.,;]"), lambda leaf: leaf != ""))


def likeness(left: Column, right: Column) -> Column:
    """Twice the common leaves over the sum of leaves, 0 to 1; 1 for equal roots, also of texts without a leaf."""
    mine, theirs = leaves(left), leaves(right)
    common = F.size(F.array_intersect(mine, theirs)) * F.lit(2.0)
    total = F.size(mine) + F.size(theirs)
    equal = F.substring_index(left, ":", 1) == F.substring_index(right, ":", 1)
    return F.when(equal, F.lit(1.0)).when(total == 0, F.lit(0.0)).otherwise(common / total)


def differing_sections(left: Column, right: Column) -> Column:
    """Numbers, from 0, of the sections of ``left`` whose digest ``right`` does not have; empty for equal roots."""
    theirs = F.transform(_sections(_body(right)), _section_digest)
    mine = F.transform(_sections(_body(left)), lambda s, i: F.struct(i.alias("at"), _section_digest(s).alias("digest")))
    return F.transform(F.filter(mine, lambda s: ~F.array_contains(theirs, s["digest"])), lambda s: s["at"])


def differing_paragraphs(left: Column, right: Column) -> Column:
    """Numbers, from 0, of the paragraphs of ``left`` that ``right`` does not have, whatever their place."""
    mine = F.transform(F.split(_body(left), "[,;]"), lambda p, i: F.struct(i.alias("at"), p.alias("leaves")))
    theirs = F.split(_body(right), "[,;]")
    return F.transform(F.filter(mine, lambda p: ~F.array_contains(theirs, p["leaves"])), lambda p: p["at"])


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, mark, next_text, next_mark): each document beside the next one by descending id.

    After the last comes the first; a single document is its own next. NULL texts count as empty. NULL ids come last.
    Rows of one id are ordered by their text. Ids are numbers.

    The ids alone give the borders of ranges (their number follows ``spark.sql.shuffle.partitions``, so it is bounded).
    Each range also gets the first document of the one after it, and is then complete: the texts are shuffled once, and
    no task sorts more than a few ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ranges = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / ranges for i in range(1, ranges)]
    bounds = rows.agg(F.percentile_approx("doc_id", cuts, 100 * ranges).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    rows = rows.withColumn("range", _range_of(F.col("doc_id"), bounds))
    heads = (rows.groupBy("range").agg(F.max("doc_id").alias("head")).orderBy("range").collect())
    halo = {}
    for here, after in zip(heads, heads[1:] + heads[:1]):
        halo.setdefault(after["head"], []).append(here["range"])
    if halo:
        numbers = [k for k in halo if k is not None]
        target = F.create_map(*[F.lit(x) for k in numbers for x in (k, halo[k][0])]) if numbers else None
        first = F.col("doc_id").isin(numbers) if numbers else F.lit(False)
        where = target[F.col("doc_id")] if numbers else F.lit(0)
        if None in halo:
            first = first | F.col("doc_id").isNull()
            where = F.when(F.col("doc_id").isNull(), F.lit(halo[None][0])).otherwise(where)
        edge = rows.filter(first).withColumn("range", where).withColumn("own", F.lit(False))
    else:
        edge = rows.limit(0).withColumn("own", F.lit(False))
    both = rows.withColumn("own", F.lit(True)).unionByName(edge).repartition("range")
    both = both.withColumn("mark", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy(F.col("own").desc(), F.col("doc_id").desc_nulls_last(), "text")
    both = both.withColumn("next", F.lead(F.struct("text", "mark")).over(order))
    return both.filter("own").select("doc_id", "text", "mark", F.col("next.text").alias("next_text"),
                                     F.col("next.mark").alias("next_mark"))


def _range_of(number: Column, bounds: list) -> Column:
    """How many bounds are above the number: 0 for the largest ids. NULL comes after all."""
    array = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<bigint>")
    above = F.size(F.filter(array, lambda b: b > number))
    return F.when(number.isNull(), F.lit(len(bounds) + 1)).otherwise(above)


def edited(text: Column, next_text: Column) -> Column:
    """The text, its last third replaced by as many code points of the next one's start, or all it has."""
    length = F.length(text)
    third = F.floor(length / 3).cast("int")
    return F.concat(text.substr(F.lit(1), length - third), next_text.substr(F.lit(1), third))
