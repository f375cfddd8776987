"""LM scoring by a hashed maximum-entropy model with a class-factored softmax.

Every word has a class: the most frequent words and the end of a text one each, all others by a hash of their last two
bytes. The chance of a token is that of its class after the words before it, times that of the word in its class by
add-one counts. The class is predicted by a softmax over hashed features: the word before, the one before that (a skip)
and both together. Its weights are trained by distributed gradient updates: in each round every task goes over its part
of the training texts from the same weights, and their changes are averaged by how often a feature was seen.

Counts cover all training texts. Words of the ``TOP`` most frequent are looked up in the workers; all others are joined
with the whole table of counts. Texts are cut and looked up as whole Arrow batches, and scored in sparse numpy blocks:
gathers of weight rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import in_small_batches, most_frequent, settled

#: Words looked up in the workers; bounds what is sent there. The others are joined.
TOP = 1 << 17
#: Classes of single words (the last is the end of a text) and of endings.
OWN_CLASSES, ENDING_CLASSES = 31, 17
CLASSES = OWN_CLASSES + ENDING_CLASSES
FEATURES, ORDERS = 1 << 14, 3
ROUNDS, RATE, BATCH = 3, 0.4, 4096
#: Rows handled at once within a batch, so that they stay in the processor's cache.
BLOCK = 512
#: A feature met more often in a batch is summed by itself, the others together.
OFTEN = 8
#: Different words a task counts before it passes them on.
FLUSH = 200_000
#: The end of a text; no word is empty.
END = b""


def tokens(texts: pa.Array) -> pa.Array:
    """Of each text its words, A-Z lower-cased, and the end; a NULL text is an empty one."""
    words = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    # a space behind the last word leaves an empty piece, the end; so does a text without words
    space = pa.array(["", " "], words.type).take(pc.greater(pc.binary_length(words), 0).cast(pa.int8()))
    pieces = pc.ascii_split_whitespace(pc.binary_join_element_wise(words, space, pa.scalar("", words.type)))
    return pieces.cast(pa.list_(pa.binary()))


def ending_class(word: bytes) -> int:
    return OWN_CLASSES + zlib.crc32(word[-2:]) % ENDING_CLASSES


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0

    def merged() -> pa.Table:
        sums = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
        return pa.table({"word": sums["word"], "n": sums["n_sum"]})

    for batch in batches:
        found = pc.value_counts(tokens(batch.column("text")).flatten())
        held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
        rows += len(found)
        if rows > 2 * FLUSH:
            held = [merged()]
            if len(held[0]) > FLUSH:
                yield from held.pop().to_batches()
            rows = sum(map(len, held))
    if held:
        yield from merged().to_batches()


def own_words(words: list[bytes]) -> list[bytes]:
    """The most frequent words, which have a class each."""
    return [w for w in words[:OWN_CLASSES] if w != END][:OWN_CLASSES - 1]


class Lexicon:
    """What the workers know of words: the top ones with their counts, classes and feature hashes."""

    def __init__(self, words: list[bytes], counts: list[int]):
        self.words = pa.array(words, pa.binary())
        of_own = {w: i for i, w in enumerate(own_words(words))} | {END: OWN_CLASSES - 1}
        self.log_count = np.log10(np.append(np.array(counts, float), 0) + 1)
        self.classes = np.array([of_own[w] if w in of_own else ending_class(w) for w in words] + [0], np.int16)
        self.hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words] + [0], np.uint64)

    def places(self, toks: pa.Array) -> np.ndarray:
        """Place among the top words per token, or -1."""
        return pc.fill_null(pc.index_in(toks, value_set=self.words), -1).to_numpy(zero_copy_only=False)

    def read(self, toks: pa.Array | list[bytes], place: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """(place or -1, class, hash) per token, and the tokens that are not among the top words."""
        toks = toks if isinstance(toks, pa.Array) else pa.array(toks, pa.binary())
        place = self.places(toks) if place is None else place
        kind, code = self.classes[place], self.hashes[place]
        other = np.flatnonzero(place < 0)
        rare = toks.take(pa.array(other)).to_numpy(zero_copy_only=False).tolist()
        if rare:
            end = OWN_CLASSES - 1
            kind[other] = [end if w == END else ending_class(w) for w in rare]
            code[other] = np.fromiter(map(xxhash.xxh3_64_intdigest, rare), np.uint64, len(rare))
        return place, kind, code, rare


_LEXICON: list = [None, None]


def _lexicon(shared) -> Lexicon:
    """The lexicon of a broadcast, made once in a worker and kept for its next tasks."""
    if _LEXICON[0] is not shared.value:
        _LEXICON[:] = shared.value, Lexicon(*shared.value)
    return _LEXICON[1]


def runs(lengths: np.ndarray, size: int, held: int = 0) -> Iterator[tuple[int, int]]:
    """(first, behind the last) of neighbouring texts that together have ``size`` tokens or just more; ``held`` count with the first run."""
    ends, first = np.cumsum(lengths, dtype=np.int64), 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        last = min(int(np.searchsorted(ends, before + size - held)) + 1, len(ends))
        yield first, last
        first, held = last, 0


def _read(lex: Lexicon, texts: pa.Array, size: int, held: int = 0) -> Iterator[tuple]:
    """Per run of texts: its first and the one behind its last, their starts, and place, class and features per token, rare tokens."""
    lists = tokens(texts)
    words, lengths = lists.flatten(), lists.value_lengths().to_numpy()
    place, ends = lex.places(words), np.append(0, np.cumsum(lengths, dtype=np.int64))
    for first, last in runs(lengths, size, held):
        at, to = int(ends[first]), int(ends[last])
        starts = ends[first:last] - at
        here, kind, code, rare = lex.read(words.slice(at, to - at), place[at:to])
        yield first, last, starts, here, kind, context(code, starts), rare


def context(code: np.ndarray, starts: np.ndarray | slice = slice(0, 1)) -> np.ndarray:
    """Feature numbers (token, order) of the tokens of texts that begin at ``starts``; by default those of one text."""
    one, two = np.empty_like(code), np.empty_like(code)
    one[1:] = code[:-1]
    one[starts] = 1
    two[1:] = one[:-1]
    two[starts] = 1
    mix = np.uint64(0x9E3779B97F4A7C15)
    features = np.empty((ORDERS, len(code)), np.uint16)
    for k, keys in enumerate((one * mix, (two + np.uint64(77)) * mix, (one ^ (two * mix)) * mix + np.uint64(5))):
        features[k] = (keys ^ (keys >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(50)
    return features.T


def log_chances(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Natural log chances of all classes for each token. The last row of the weights is the bias."""
    scores = _scores(weights, features)
    scores -= np.log(np.exp(scores).sum(1, keepdims=True))
    return scores


def powers_of(weights: np.ndarray) -> np.ndarray | None:
    """Exponentials of the weights, or None if products of them could leave the range of a float."""
    return np.exp(weights) if (ORDERS + 1) * float(np.abs(weights).max()) < 80 else None


def chances_of(weights: np.ndarray, features: np.ndarray, kind: np.ndarray, powers: np.ndarray | None = None) -> np.ndarray:
    """Natural log chance of each token's own class; with ``powers`` the exponentials are multiplied instead of made anew."""
    if powers is None:
        scores = _scores(weights, features)
        own = scores[np.arange(len(kind)), kind]
        np.exp(scores, out=scores)
        return own - np.log(scores.sum(1))
    product = powers.take(features[:, 0], axis=0)
    for k in range(1, ORDERS):
        product *= powers.take(features[:, k], axis=0)
    own = product.ravel().take(np.arange(len(kind)) * product.shape[1] + kind) * powers[-1].take(kind)
    return np.log(own) - np.log(product @ powers[-1])


def _scores(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    """Scores of all classes for each token, the largest 0."""
    scores = weights.take(features[:, 0], axis=0)
    scores += weights[-1]
    for k in range(1, ORDERS):
        scores += weights.take(features[:, k], axis=0)
    scores -= scores.max(1, keepdims=True)
    return scores


def _sums(slope: np.ndarray, column: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of a column, how often each comes, and the sum of its tokens' slopes."""
    order = np.argsort(column, kind="stable")
    ordered = column[order]
    starts = np.append(0, np.flatnonzero(ordered[1:] != ordered[:-1]) + 1)
    times = np.diff(np.append(starts, len(order)))
    # those that come more often first, so that what has a next token is always a front part
    falling = np.argsort((OFTEN + 1 - np.minimum(times, OFTEN + 1)).astype(np.uint8), kind="stable")
    starts, times = starts[falling], times[falling]
    sums, often = slope.take(order[starts], axis=0), int((times > OFTEN).sum())
    for i in range(often):
        slope.take(order[starts[i]:starts[i] + times[i]], axis=0).sum(0, out=sums[i])
    for nth in range(1, OFTEN):
        to = int((times > nth).sum())
        if to == often:
            break
        sums[often:to] += slope.take(order[starts[often:to] + nth], axis=0)
    return ordered[starts].astype(np.intp), times, sums


def descend(weights: np.ndarray, gathered: np.ndarray, seen: np.ndarray, features: np.ndarray, kind: np.ndarray) -> None:
    """One adaptive gradient step on a batch, in place; ``gathered`` has the squares per weight, ``seen`` the tokens per feature."""
    slope, ones = np.empty((len(kind), weights.shape[1]), weights.dtype), np.ones(weights.shape[1], weights.dtype)
    for at in range(0, len(kind), BLOCK):
        part = np.exp(_scores(weights, features[at:at + BLOCK]), out=slope[at:at + BLOCK])
        part /= (part @ ones)[:, None]
    slope.ravel()[np.arange(len(kind)) * slope.shape[1] + kind] -= 1
    for k in range(ORDERS):
        rows, times, sums = _sums(slope, np.ascontiguousarray(features[:, k]))
        for at in range(0, len(rows), BLOCK):
            here, change = rows[at:at + BLOCK], sums[at:at + BLOCK]
            squares = change * change
            squares += gathered.take(here, axis=0)
            gathered[here] = squares
            np.sqrt(squares, out=squares)
            change *= RATE
            change /= squares
            weights[here] = np.subtract(weights.take(here, axis=0), change, out=change)
        seen[rows] += times
    total = slope.sum(0)
    gathered[-1] += total * total
    weights[-1] -= RATE * total / np.sqrt(gathered[-1])
    seen[-1] += len(kind)


def _gradient_round(texts: DataFrame, lexicon, start: np.ndarray) -> np.ndarray:
    """Weights after every task went over its texts from the same start."""
    shared = texts.sparkSession.sparkContext.broadcast(start)
    columns = [f"c{i}" for i in range(CLASSES)]

    def passes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, lex = shared.value, _lexicon(lexicon)
        weights, gathered = first.copy(), np.ones_like(first)
        seen = np.zeros(len(first))
        held, size = [], 0

        def step() -> None:
            features, kind = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            for at in range(0, len(kind), BATCH):
                descend(weights, gathered, seen, features[at:at + BATCH], kind[at:at + BATCH])
            held.clear()

        for batch in batches:
            for *_, kind, features, _ in _read(lex, batch.column("text"), 8 * BATCH, size):
                held.append((features, kind))
                size += len(kind)
                if size >= 8 * BATCH:
                    step()
                    size = 0
        if held:
            step()
        rows = np.flatnonzero(seen)
        change = np.ascontiguousarray(((weights[rows] - first[rows]) * seen[rows, None]).astype(np.float32).T)
        yield pa.RecordBatch.from_arrays([pa.array(rows.astype(np.int32)), pa.array(seen[rows]), *map(pa.array, change)],
                                         ["row", "seen", *columns])

    schema = "row int, seen double, " + ", ".join(f"{c} float" for c in columns)
    changes = (texts.mapInArrow(passes, schema).groupBy("row")
               .agg(F.sum("seen").alias("seen"), *[F.sum(c).alias(c) for c in columns]).toPandas())
    out = start.copy()
    if len(changes):
        out[changes["row"].to_numpy()] += (changes[columns].to_numpy() / changes[["seen"]].to_numpy()).astype(np.float32)
    shared.unpersist()
    return out


def train(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text") -> dict:
    """Counts, lexicon and weights from all texts of ``docs``; ``key_col`` only decides in which round a text comes.

    NULL texts are empty ones: an end alone. An empty table gives a model that knows no word.
    """
    spark = docs.sparkSession
    texts = in_small_batches(docs).select(F.col(key_col).alias("key"), F.col(text_col).alias("text"))
    counts = settled(texts.select("text").mapInArrow(_counted, "word binary, n long")
                     .groupBy("word").agg(F.sum("n").alias("n")))
    top = most_frequent(counts, TOP).toPandas().sort_values(["n", "word"], ascending=[False, True])
    known = ([bytes(w) for w in top["word"]], [int(n) for n in top["n"]])
    kind = F.lit(OWN_CLASSES) + F.crc32(F.substring("word", -2, 2)) % ENDING_CLASSES
    for i, word in [*enumerate(own_words(known[0])), (OWN_CLASSES - 1, END)]:
        kind = F.when(F.col("word") == F.lit(word), i).otherwise(kind)
    sums = counts.groupBy(kind.cast("int").alias("kind")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).toPandas()
    size = np.ones(CLASSES)
    size[sums["kind"].to_numpy(int)] += (sums["n"] + sums["v"]).to_numpy(float)
    shared = spark.sparkContext.broadcast(known)
    weights = np.zeros((FEATURES + 1, CLASSES), np.float32)
    if len(sums):
        weights[-1] = np.log(size) - np.log(size).mean()
        for turn in range(ROUNDS):
            part = texts.filter(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(ROUNDS)) == turn).select("text")
            weights = _gradient_round(part, shared, weights)
    return {"counts": counts, "lexicon": shared, "weights": spark.sparkContext.broadcast(weights),
            "class_size": np.log10(size), "tokens": int(sums["n"].sum()), "words": int(sums["v"].sum())}


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row.

    ``score`` is the model's log10 probability of the text, ``base_score`` that of add-one unigrams. NULL texts count as
    empty. Repeated rows and ids stay apart. Other columns are not looked at.
    """
    lexicon, weights, class_size = model["lexicon"], model["weights"], model["class_size"]
    named = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, w = _lexicon(lexicon), weights.value
        powers = powers_of(w)
        for batch in batches:
            for first, last, starts, place, kind, features, rare in _read(lex, batch.column("text"), 32 * BATCH):
                chance = np.empty(len(kind))
                for k in range(0, len(kind), BLOCK):
                    chance[k:k + BLOCK] = chances_of(w, features[k:k + BLOCK], kind[k:k + BLOCK], powers)
                ends = np.append(starts, len(kind))
                cuts = np.searchsorted(np.flatnonzero(place < 0), ends)
                others = [Counter(rare[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").slice(first, last - first), pa.array(np.diff(ends)),
                    pa.array(np.add.reduceat((place >= 0).astype(np.int64), starts)),
                    pa.array(np.add.reduceat(lex.log_count[place], starts)),
                    pa.array(np.add.reduceat(chance / math.log(10) - class_size[kind], starts)),
                    pa.array([list(o) for o in others], pa.list_(pa.binary())),
                    pa.array([list(o.values()) for o in others], pa.list_(pa.int32()))],
                    ["doc_id", "n_tokens", "n_top", "log_top", "chance", "rare", "times"])

    id_type = named.schema["doc_id"].dataType.simpleString()
    parts = named.mapInArrow(rows, f"doc_id {id_type}, n_tokens long, n_top long, log_top double, chance double, "
                                    "rare array<binary>, times array<int>")
    parts = settled(parts.withColumn("row", F.monotonically_increasing_id()))
    each = (parts.select("row", F.explode(F.arrays_zip("rare", "times")).alias("r"))
            .select("row", F.col("r.rare").alias("word"), F.col("r.times").alias("times")))
    known = (each.join(model["counts"], "word").groupBy("row")
             .agg(F.sum("times").alias("n_rare"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("log_rare")))
    whole = parts.drop("rare", "times").join(known, "row", "left")
    logs = F.col("log_top") + F.coalesce("log_rare", F.lit(0.0))
    size = math.log10(model["tokens"] + model["words"] + 1)
    return whole.select("doc_id", "n_tokens", (F.col("n_top") + F.coalesce("n_rare", F.lit(0))).cast("long").alias("n_known"),
                        F.lit(model["tokens"]).cast("long").alias("train_tokens"),
                        (logs - F.col("n_tokens") * size).alias("base_score"), (logs + F.col("chance")).alias("score"))
