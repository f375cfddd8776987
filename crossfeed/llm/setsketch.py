"""Near-duplicate documents by SetSketch registers, banded, estimated jointly and verified on full sets.

A register holds the smallest of the hash values of a set under one hash function, as a truncated logarithm to a base
near 1. Registers of a union are the larger of two, and two sets share a register about as often as their Jaccard
similarity. Steps:

1. Documents with equal sets form a class (a digest of the whole set, any number of copies), which goes on as one node.
2. Bands of registers are hashed to buckets; the number of registers per band follows from the threshold so that a pair
   at the threshold is missed with a chance below ``MISS``.
3. In each bucket every node is paired with the bucket's most central node only, so pairs grow with the nodes. Pairs far
   below the threshold by the likelihood of their registers are dropped; the others are verified on their full sets.
4. Links are joined into components. Where the nodes around one pivot still span several components, sets that are too
   much their own to have any link there are left out, and what remains is compared completely, in blocks of bounded
   size, so that no link between two components is lost. Pairs that do not link are never written as rows.

No bucket is gathered in one task, and joins on hot keys can be split. Intermediate results go to the checkpoint folder.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.llm.common import SMALL_ROWS, in_small_batches, measured, settled

BASE = 1.001
REGISTERS = 128
#: Added to the negative logarithm, so that registers of sets of any size are positive.
OFFSET = 4096
MISS = 1e-6
#: A pair is verified unless its estimate is this far below the threshold: over five standard errors.
MARGIN = 0.25
#: Partitions of tables of no more than ``SMALL_ROWS`` rows in the rounds that find components.
SMALL_PARTS = 8
#: Sets, and shingles in them, on each side of a block in which sets are compared completely.
BLOCK, BLOCK_ITEMS = 128, 1 << 20

_rng = np.random.default_rng(20260901)
_MULTIPLY = (_rng.integers(1, 1 << 31, REGISTERS, dtype=np.uint32) * 2 + 1)[:, None]
_ADD = _rng.integers(0, 1 << 32, REGISTERS, dtype=np.uint32)[:, None]
_MIX = np.uint32(0x85EBCA6B)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int) -> np.ndarray:
    """The set of a text's word shingles as sorted 64-bit hashes; the whole text is one if it has fewer words."""
    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = _mixed(out * _STEP + h[k:len(h) - width + 1 + k])
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of hashes, 16 bits each; the larger of two is that of the union."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    least = np.full(REGISTERS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), 2048):
        y = x[None, at:at + 2048] * _MULTIPLY
        y += _ADD
        y ^= y >> np.uint32(15)
        y *= _MIX
        y ^= y >> np.uint32(13)
        np.minimum(least, y.min(axis=1), out=least)
    value = -np.log1p(-(least + 0.5) / 2.0**32)
    return np.clip(np.floor(OFFSET - np.log(value) / math.log(BASE)), 0, 65535).astype("<u2")


def similarity(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Jaccard similarity of pairs of sets of known sizes with the greatest likelihood, given their registers."""
    above, below = (left > right).sum(1), (left < right).sum(1)
    same = left.shape[1] - above - below
    total = np.maximum(n_left + n_right, 1)
    u, v = (n_left / total)[:, None], (n_right / total)[:, None]
    grid = np.linspace(0, 1, 65)[None, :] * np.minimum(u / np.maximum(v, 1e-12), v / np.maximum(u, 1e-12))

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    likelihood = sum(count[:, None] * np.log(np.clip(chance, 1e-12, 1))
                     for count, chance in ((above, up), (below, down), (same, 1 - up - down)))
    return np.take_along_axis(grid, likelihood.argmax(1)[:, None], 1)[:, 0]


def band_rows(threshold: float) -> int:
    """Most registers per band for which a pair at the threshold is missed with a chance below ``MISS``."""
    fit = [r for r in range(1, 17) if (1 - threshold**r) ** (REGISTERS // r) <= MISS]
    return max(fit, default=1)


def _sketched(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n, digest, registers): the digest is of the whole set, NULL for empty sets."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at:at + 512]
                sets = [shingles(text, words) for text in part["text"]]
                yield pd.DataFrame({
                    "doc_id": part["doc_id"].to_numpy(), "n": [len(s) for s in sets],
                    "digest": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                    "registers": [registers(s).tobytes() if len(s) else None for s in sets]})
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInPandas(rows, f"doc_id {kind}, n long, digest binary, registers binary")


def _sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """(node, items) of the given nodes (node, digest, rep), read again from one document each."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                sets = [shingles(text, words) for text in batch["text"].iloc[at:at + 256]]
                yield pd.DataFrame({"found": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                                    "items": [s.view(np.int64) for s in sets]})
    wanted = measured(nodes.select(F.col("rep").alias("doc_id")).distinct())
    found = docs.join(wanted, "doc_id", "left_semi").select("text").mapInPandas(rows, "found binary, items array<long>")
    names = measured(nodes.select("node", "digest"))
    found = found.join(names, F.col("found") == F.col("digest")).select("node", "items")
    return found.dropDuplicates(["node"])


@F.pandas_udf(T.DoubleType())
def _estimate(left: pd.Series, right: pd.Series, n_left: pd.Series, n_right: pd.Series) -> pd.Series:
    out = np.empty(len(left))
    for at in range(0, len(left), 4096):
        part = slice(at, at + 4096)
        a, b = (np.frombuffer(b"".join(x.iloc[part]), "<u2").reshape(-1, REGISTERS) for x in (left, right))
        out[part] = similarity(a, b, n_left.iloc[part].to_numpy(float), n_right.iloc[part].to_numpy(float))
    return pd.Series(out)


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 x intersection >= percent x union."""
    sides = [nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("registers").alias(f"r_{s}"))
             for s in "ab"]
    near = sides[0].join(measured(settled(pairs)), "a").join(sides[1], "b")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    near = near.filter(fits).filter(_estimate("r_a", "r_b", "n_a", "n_b") >= percent / 100 - MARGIN)
    near = measured(settled(near.select("a", "b", "n_a", "n_b")))
    common = F.size(F.array_intersect("s_a", "s_b"))
    return settled(sets.select(F.col("node").alias("a"), F.col("items").alias("s_a")).join(near, "a")
                   .join(sets.select(F.col("node").alias("b"), F.col("items").alias("s_b")), "b")
                   .filter(100 * common >= percent * (F.col("n_a") + F.col("n_b") - common)).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b): the smallest node that links lead to.

    Every round takes the smallest label around a node and then that label's own label, so paths halve.
    """
    own = links.select("a", F.col("a").alias("b")).union(links.select("b", F.col("b").alias("a")))
    edges = settled(links.select("a", "b").union(links.select("b", "a")).union(own).distinct())
    small = edges.count() <= SMALL_ROWS
    edges = edges.coalesce(SMALL_PARTS) if small else edges

    def side(frame: DataFrame) -> DataFrame:
        return F.broadcast(frame) if small else frame

    state = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label"))
    while True:
        was = F.min(F.when(F.col("a") == F.col("b"), F.col("label"))).alias("was")
        seen = settled(edges.join(side(state), edges["b"] == F.col("node"))
                       .groupBy("a").agg(F.min("label").alias("label"), was))
        if seen.filter("was <> label").isEmpty():
            return seen.select(F.col("a").alias("node"), "label")
        far = side(seen.select(F.col("a").alias("at"), F.col("label").alias("far")))
        state = seen.join(far, F.col("label") == F.col("at")).select(F.col("a").alias("node"), F.least("label", "far").alias("label"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but space and U+0009 to U+000D, A-Z lower-cased. Documents are linked if the sets of
    their shingles of ``words`` words have a Jaccard similarity of ``percent`` or more; a text with fewer words is one
    shingle. ``component_id`` is the smallest doc_id that links lead to, ``kept`` whether it is the row's own. NULL and
    empty texts have no shingle and stay alone. Rows with a NULL id stay alone too, have no component and are kept.
    Rows of one id are one document: each is in the component of its own text. An empty table gives an empty result.
    """
    docs = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sketched = settled(_sketched(docs, words))
    classes = (sketched.filter("doc_id IS NOT NULL AND n > 0").groupBy("digest")
               .agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("registers")))
    classes = settled(classes.withColumn("node", F.monotonically_increasing_id()))
    links = _links(docs, classes, words, percent)
    component = F.col("rep")
    if links is not None:
        members = components(links).join(classes.select("node", "rep"), "node")
        smallest = settled(members.groupBy("label").agg(F.min("rep").alias("component_id")))
        members = settled(members.join(measured(smallest), "label").select(F.col("node").alias("member"), "component_id"))
        classes = classes.join(measured(members), F.col("node") == F.col("member"), "left")
        component = F.coalesce("component_id", "rep")
    merged = settled(classes.select(F.col("digest").alias("class"), component.alias("component_id")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return (sketched.select("doc_id", "n", "digest").join(merged, F.col("digest") == F.col("class"), "left")
            .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _buckets(classes: DataFrame, rows: int) -> DataFrame:
    """(key, node, size) of the buckets that hold more than one node."""
    keys = F.array(*[F.xxhash64(F.lit(i), F.substring("registers", 2 * rows * i + 1, 2 * rows))
                     for i in range(REGISTERS // rows)])
    banded = classes.select("node", F.explode(keys).alias("key"))
    full = settled(banded.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"))
    return banded.join(measured(full), "key")


def _links(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame | None:
    """Verified pairs (a, b) of nodes that join all linked nodes; NULL if no two nodes share a bucket."""
    buckets = settled(_buckets(classes, band_rows(percent / 100)))
    if buckets.isEmpty():
        return None
    central = settled(buckets.groupBy("node").agg(F.sum("size").alias("central")))
    pivots = (buckets.join(measured(central), "node").groupBy("key")
              .agg(F.max(F.struct("central", "node")).alias("p")).select("key", F.col("p.node").alias("pivot")))
    groups = settled(buckets.join(measured(settled(pivots)), "key").select("pivot", "node").distinct())
    nodes = settled(classes.join(measured(central.select("node")), "node", "left_semi"))
    sets = settled(_sets(docs, nodes, words))
    pairs = groups.filter("pivot <> node").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
    links = _verified(pairs.distinct(), nodes, sets, percent)
    rest = _open_groups(groups, links, sets, percent)
    return links if rest is None else links.union(_blockwise(rest, percent))


def _open_groups(groups: DataFrame, links: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(pivot, node, label, home, items) of the groups that still span several components; NULL if none does.

    A set of which more than 100 - ``percent`` percent is in no other set of its group can have no link in the group,
    and is left out: that takes one count of each shingle, however large the group is.
    """
    label = measured(components(links))
    home = label.select(F.col("node").alias("pivot"), F.col("label").alias("home"))
    named = (groups.join(label, "node", "left").join(measured(home), "pivot", "left")
             .select("pivot", "node", F.coalesce("label", "node").alias("label"), F.coalesce("home", "pivot").alias("home")))
    named = _spanning(settled(named))
    if named.isEmpty():
        return None
    parts = (sets.join(measured(named.select("pivot", "node")), "node")
             .select("pivot", "node", F.size("items").alias("n"), F.explode("items").alias("item")))
    shared = parts.groupBy("pivot", "item").agg(F.count("*").alias("times")).filter("times > 1").drop("times")
    linkable = (parts.join(shared, ["pivot", "item"]).groupBy("pivot", "node", "n").agg(F.count("*").alias("common"))
                .filter(100 * F.col("common") >= percent * F.col("n")).select("pivot", "node"))
    named = _spanning(settled(named.join(measured(settled(linkable)), ["pivot", "node"], "left_semi")))
    return None if named.isEmpty() else sets.join(measured(named), "node")


def _spanning(named: DataFrame) -> DataFrame:
    """The rows of the groups that have a node outside the pivot's component."""
    mixed = settled(named.filter("label <> home").select("pivot").distinct())
    return settled(named.join(measured(mixed), "pivot", "left_semi"))


def _blockwise(rest: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between different labels of a group.

    The nodes outside the pivot's component meet all nodes of the group, block by block. A block holds about ``BLOCK``
    nodes a side, fewer if they have more than ``BLOCK_ITEMS`` shingles, and gives only the links that join labels in it.
    """
    held = F.greatest(F.lit(1 / BLOCK), F.size("items") / F.lit(BLOCK_ITEMS))
    sizes = rest.groupBy("pivot").agg(F.sum(held).alias("nodes"),
                                      F.sum(F.when(F.col("label") != F.col("home"), held).otherwise(0.0)).alias("out"))
    sizes = sizes.select("pivot", F.ceil("nodes").alias("n_all"), F.ceil("out").alias("n_out"))
    rows = rest.join(measured(settled(sizes.filter("n_out > 0"))), "pivot")
    spot = F.xxhash64("node")
    out = (rows.filter("label <> home").withColumn("i", F.pmod(spot, F.col("n_out")))
           .withColumn("j", F.explode(F.sequence(F.lit(0), F.col("n_all") - 1))).withColumn("side", F.lit(0)))
    everyone = (rows.withColumn("j", F.pmod(spot, F.col("n_all")))
                .withColumn("i", F.explode(F.sequence(F.lit(0), F.col("n_out") - 1))).withColumn("side", F.lit(1)))
    names = ["pivot", "i", "j", "side", "node", "label", "items"]

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
        common = _intersections(list(left["items"]), list(right["items"]))
        n_left, n_right = (np.array([len(x) for x in side["items"]]) for side in (left, right))
        union = n_left[:, None] + n_right[None, :] - common
        root = {name: name for name in frame["label"]}

        def top(name: int) -> int:
            while root[name] != name:
                root[name] = name = root[root[name]]
            return name

        found = []
        for i, j in zip(*np.nonzero(100 * common >= percent * union)):
            a, b = top(left["label"].iat[i]), top(right["label"].iat[j])
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((left["node"].iat[i], right["node"].iat[j]))
        return pd.DataFrame(found, columns=["a", "b"])

    both = out.select(names).unionByName(everyone.select(names))
    return both.groupBy("pivot", "i", "j").applyInPandas(compare, "a long, b long")


def _intersections(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one list with all of the other, by matrix products over slices."""
    out = np.zeros((len(left), len(right)), np.int64)
    if not left or not right:
        return out
    sides = [(np.concatenate(side), np.repeat(np.arange(len(side)), [len(x) for x in side])) for side in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    for at in range(0, len(shared), 8192):
        part = shared[at:at + 8192]
        dense = []
        for (items, owner), side in zip(sides, (left, right)):
            place = np.minimum(np.searchsorted(part, items), len(part) - 1)
            hit = part[place] == items
            matrix = np.zeros((len(side), len(part)), np.float32)
            matrix[owner[hit], place[hit]] = 1
            dense.append(matrix)
        out += (dense[0] @ dense[1].T).astype(np.int64)
    return out


def dedupe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
           percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with all their columns: of each component of near duplicates the one with the smallest id.

    Decided row by row, so rows that share an id, or have none, are compared like others; NULL ids come last, and of equal
    ids the first in the table stays. Rows without words all stay. An empty table gives an empty result.
    """
    keyed = settled(docs.withColumn("__row", F.monotonically_increasing_id()))
    found = near_duplicates(keyed, "__row", text_col, words, percent).filter("n_shingles > 0")
    ids = keyed.select("__row", F.col(id_col).alias("__id"))
    rows = settled(found.select(F.col("doc_id").alias("row"), "component_id").join(ids, F.col("row") == F.col("__row"))
                   .select("component_id", F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), "row").alias("at")))
    groups = rows.groupBy("component_id").agg(F.min("at").alias("first"), F.count("*").alias("n")).filter("n > 1")
    gone = (rows.join(measured(settled(groups)), "component_id").filter(F.col("at") != F.col("first"))
            .select(F.col("at.row").alias("__gone")))
    return keyed.join(measured(settled(gone)), F.col("__row") == F.col("__gone"), "left_anti").drop("__row")
