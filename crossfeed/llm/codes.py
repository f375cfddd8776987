"""Vector code compression: product codes fitted in whole rounds, with norm-of-sum bounds before exact rescans.

Components become integers, vectors are cut into parts, and every part has a codebook of a few entries. A round assigns
each part to its nearest entry and moves the entries to the means. Between rounds a row keeps, per part, its entry, an
upper bound of the distance to it, a lower bound of the distance to any other, and for each bound the round it was taken
in. All earlier codebooks are kept (they are small), so a bound of round s is moved to round t by the true displacement
|c_t - c_s| of the entries, the norm of the summed moves, which is never more than the sum of the moves' norms. Only
rows whose bounds meet are looked at: first the distance to their own entry, then, if need be, to all. Distances are
whole numbers, so the codes are those of a full search, ties included.

Rows and bounds are a table in the shared folder, one per round, the one before removed; sums of a round lie in it as
one more row per task, so each round is one pass. Nothing but codebooks and sums over all rows comes to the driver.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import measured, removed, settled
from crossfeed.operators.checkpoints import shared_folder

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: A label with more than this share of the rows gets its sum by broadcast, so its rows are not brought together.
HOT_SHARE = 1e-4
#: What rounding of a float bound may be off, relatively.
SLACK = 1e-6

_BOUNDS = np.dtype([("entry", "u1"), ("upper_round", "u1"), ("lower_round", "u1"), ("upper", "<f4"), ("lower", "<f4")])


@dataclass(frozen=True)
class Shape:
    parts: int
    width: int
    integers: str
    #: Whether all dot products of parts are whole numbers that a double holds.
    small: bool


def distances(x: np.ndarray, book: np.ndarray, shape: Shape) -> np.ndarray:
    """Squared distances (rows, entries) of parts to the entries of their codebook, exact."""
    if shape.small:
        a, b = x.astype(np.float64), book.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return np.stack([((x.astype(np.int64) - entry) ** 2).sum(1) for entry in book], 1)


def own_distances(x: np.ndarray, book: np.ndarray, entry: np.ndarray) -> np.ndarray:
    return ((x.astype(np.int64) - book[entry]) ** 2).sum(1)


def _above(squares: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(squares).astype(np.float32), np.float32(np.inf))


def _below(squares: np.ndarray) -> np.ndarray:
    return np.maximum(np.nextafter(np.sqrt(squares).astype(np.float32), np.float32(-np.inf)), 0)


def assign(x: np.ndarray, kept: np.ndarray, books: np.ndarray, shape: Shape, first: bool) -> tuple[int, int]:
    """Brings ``kept``, the bounds of the parts ``x`` at one position, to the last of ``books`` (round, entry, width).

    Returns how many rows were compared with their own entry and how many with all.
    """
    now = len(books) - 1
    book = books[now]
    todo = np.arange(len(x))
    own = 0
    if not first:
        moved = np.sqrt(((books - book) ** 2).sum(2).astype(np.float64))
        others = np.zeros_like(moved)
        for entry in range(len(book)):
            others[:, entry] = np.delete(moved, entry, axis=1).max(1, initial=0)
        entry = kept["entry"].astype(np.intp)
        upper = kept["upper"] + moved[kept["upper_round"], entry]
        lower = kept["lower"] - others[kept["lower_round"], entry]
        todo = np.flatnonzero(~(upper * (1 + SLACK) < lower))
        own = len(todo)
        kept["upper"][todo] = _above(own_distances(x[todo], book, entry[todo]))
        kept["upper_round"][todo] = now
        todo = todo[~(kept["upper"][todo] * (1 + SLACK) < lower[todo])]
    for low in range(0, len(todo), 1 << 13):
        rows = todo[low:low + (1 << 13)]
        squares = distances(x[rows], book, shape)
        best = squares.argmin(1)
        at = np.arange(len(rows))
        kept["upper"][rows] = _above(squares[at, best])
        squares[at, best] = np.iinfo(np.int64).max
        kept["lower"][rows] = _below(squares.min(1)) if len(book) > 1 else np.inf
        kept["entry"][rows] = best
        kept["upper_round"][rows] = kept["lower_round"][rows] = now
    return own, len(todo)


def next_book(book: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Entries at the floor of their parts' means; unused ones stay."""
    used = counts > 0
    made = book.copy()
    made[used] = sums[used] // counts[used][:, None]
    return made


def _fixed(column: pa.Array, size: int) -> np.ndarray:
    """The bytes (rows, size) of a column of byte strings of one size."""
    if not len(column) or not size:
        return np.zeros((len(column), size), np.uint8)
    column = column.cast(pa.large_binary())
    first = np.frombuffer(column.buffers()[1], np.int64, 1, 8 * column.offset)[0]
    return np.frombuffer(column.buffers()[2], np.uint8, len(column) * size, int(first)).reshape(len(column), size)


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a two-dimensional array as byte strings."""
    size = rows.itemsize * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * size
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def _parts(batch: pa.RecordBatch, shape: Shape) -> np.ndarray:
    """The integers (rows, parts, width) of a batch."""
    n = shape.parts * shape.width
    data = _fixed(batch.column("q"), n * np.dtype(shape.integers).itemsize)
    return np.ascontiguousarray(data).view(shape.integers).reshape(batch.num_rows, shape.parts, shape.width)


def _moved(batch: pa.RecordBatch, books: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """(integers, bounds (rows, parts) as of the last codebooks) of a batch."""
    x = _parts(batch, shape)
    first = len(books) == 1
    kept = np.zeros((batch.num_rows, shape.parts), _BOUNDS)
    if not first:
        kept = np.ascontiguousarray(_fixed(batch.column("bounds"), _BOUNDS.itemsize * shape.parts)) \
            .view(_BOUNDS).reshape(kept.shape).copy()
    for part in range(shape.parts):
        assign(x[:, part], kept[:, part], books[:, part], shape, first)
    return x, kept


def _quantised(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, v) of the rows that are kept; ``v`` are integers."""
    finite = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = vectors.filter(F.col(vector_col).isNotNull()).filter(F.coalesce(finite, F.lit(False)))
    whole = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return kept.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole.alias("v"))


def _shape(rows: DataFrame, parts: int) -> Shape | None:
    """None for an empty table. Errors for vectors that can't be cut or whose distances no long holds."""
    low, high, most = rows.agg(F.min(F.size("v")), F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()
    if low is None:
        return None
    if low != high or low % parts:
        raise ValueError(f"Vectors of {low} to {high} components can't be cut into {parts} equal parts")
    most = int(most or 0)
    if 4 * (most + 1) ** 2 * max(high, 1) >= 1 << 63:
        raise ValueError("Squared distances of these vectors exceed 64 bits; use a smaller scale")
    return Shape(parts, low // parts, "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8",
                 4 * (most + 1) ** 2 * max(low // parts, 1) < 1 << 52)


def _packed(rows: DataFrame, shape: Shape) -> DataFrame:
    """(vec_id, label, q, bounds, sums) before the first round; q are the integers as bytes."""
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label")}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
            q = flat.astype(shape.integers).reshape(batch.num_rows, shape.parts * shape.width)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"), _binary(q)],
                                             names=["vec_id", "label", "q"])
    return rows.mapInArrow(pack, f"vec_id {kinds['vec_id']}, label {kinds['label']}, q binary")


def _round(rows: DataFrame, books: np.ndarray, shape: Shape) -> DataFrame:
    """The rows with their bounds after one more assignment, and one row of sums per task."""
    fields = ["vec_id", "label", "q"] + (["bounds"] if len(books) > 1 else [])
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    entries = books.shape[2]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((shape.parts, entries, 1 + shape.width), np.int64)
        types = None
        for batch in batches:
            x, kept = _moved(batch, books, shape)
            for part in range(shape.parts):
                entry = kept["entry"][:, part]
                sums[part, :, 0] += np.bincount(entry, minlength=entries)
                for used in np.unique(entry):
                    sums[part, used, 1:] += x[entry == used, part].sum(0, dtype=np.int64)
            types = [batch.column("vec_id").type, batch.column("label").type]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), batch.column("q"), _binary(kept),
                 pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names=["vec_id", "label", "q", "bounds", "sums"])
        if types:
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, types[0]), pa.nulls(1, types[1]), pa.nulls(1, pa.binary()), pa.nulls(1, pa.binary()),
                 pa.array([sums.ravel()], pa.list_(pa.int64()))], names=["vec_id", "label", "q", "bounds", "sums"])

    return rows.select(*fields).mapInArrow(
        step, f"vec_id {kinds['vec_id']}, label {kinds['label']}, q binary, bounds binary, sums array<long>")


def _coded(rows: DataFrame, books: np.ndarray, shape: Shape) -> DataFrame:
    """(vec_id, label, code, error) by the last codebooks."""
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("vec_id", "label")}
    digits = np.frombuffer(b"".join(b"%02x" % n for n in range(256)), np.uint8).reshape(256, 2)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, kept = _moved(batch, books, shape)
            error = np.zeros(batch.num_rows, np.int64)
            for part in range(shape.parts):
                error += own_distances(x[:, part], books[-1, part], kept["entry"][:, part])
            text = digits[kept["entry"]].reshape(batch.num_rows, 2 * shape.parts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _binary(text).cast(pa.string()), pa.array(error)],
                names=["vec_id", "label", "code", "error"])

    fields = ["vec_id", "label", "q"] + (["bounds"] if len(books) > 1 else [])
    return rows.select(*fields).mapInArrow(
        code, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def codebooks_text(books: np.ndarray) -> str:
    """The decimal components of the last codebooks by part, entry and position."""
    return ",".join(str(int(number)) for number in books[-1].ravel())


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of every kept row, all codebooks (round, part, entry, position)).

    Rows whose vector is NULL or holds a NULL or non-finite component are dropped. Component x becomes floor(scale x x).
    The codebooks start as the parts of the ``entries`` rows with the smallest ids (NULL ids last, ties by the vector), as
    given; fewer rows make fewer entries. Ties of the distance go to the lower entry, so repeated starting rows leave
    unused entries, which stay. ``code`` has two hex digits a part, ``error`` is the squared distance. Repeated rows stay
    rows. An empty table gives an empty result and no entries. Vectors of different lengths, of a length that ``parts``
    does not divide, or so large that squared distances exceed 64 bits are errors; so are more than 256 entries.
    """
    if not 0 < entries <= 256 or rounds > 250:
        raise ValueError("Codes have 1 to 256 entries and at most 250 rounds")
    spark = vectors.sparkSession
    kept = _quantised(vectors, id_col, vector_col, label_col, scale)
    shape = _shape(kept, parts)
    if shape is None:
        empty = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")).limit(0)
        return empty, np.zeros((1, parts, 0, 0), np.int64)
    # entries rows at most
    start = kept.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    start = np.array([row["v"] for row in start], np.int64).reshape(len(start), parts, shape.width)
    books = start.transpose(1, 0, 2)[None]
    folder = f"{shared_folder(spark).rstrip('/')}/codes-{uuid.uuid4().hex}"
    rows = _packed(kept, shape)
    for number in range(rounds):
        _round(rows, books, shape).write.parquet(f"{folder}/{number}")
        written = spark.read.parquet(f"{folder}/{number}")
        if number:
            removed(spark, f"{folder}/{number - 1}")
        rows = written.filter("q IS NOT NULL")
        # parts x entries x (1 + width) rows, whatever the table
        added = (written.filter("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos")
                 .agg(F.sum("col").alias("n")).collect())
        sums = np.zeros(parts * books.shape[2] * (1 + shape.width), np.int64)
        sums[[row["pos"] for row in added]] = [row["n"] for row in added]
        sums = sums.reshape(parts, books.shape[2], 1 + shape.width)
        made = [next_book(books[-1, part], sums[part, :, 0], sums[part, :, 1:]) for part in range(parts)]
        books = np.concatenate([books, np.stack(made)[None]])
    coded = settled(_coded(rows, books, shape))
    removed(spark, folder)
    return coded, books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, the sum of ``error`` over equal labels; NULL labels are one.

    Sums are made per task first. Labels with more than ``HOT_SHARE`` of the rows are few and joined by broadcast; the
    rows of all others are brought together only if there are too many labels to broadcast.
    """
    sums = settled(coded.groupBy(F.col("label").alias("sum_label"))
                   .agg(F.sum("error").alias("label_error"), F.count("*").alias("n")))
    side = measured(sums)
    if side is not sums:
        return coded.join(side, coded["label"].eqNullSafe(F.col("sum_label"))).drop("sum_label", "n")
    most = coded.count() * HOT_SHARE
    hot = F.broadcast(sums.filter(F.col("n") > most).withColumnRenamed("label_error", "hot_error").drop("n"))
    marked = coded.join(hot, coded["label"].eqNullSafe(F.col("sum_label")), "left").drop("sum_label")
    done = marked.filter("hot_error IS NOT NULL").withColumnRenamed("hot_error", "label_error")
    rest = marked.filter("hot_error IS NULL").drop("hot_error")
    cold = sums.filter(F.col("n") <= most).drop("n")
    rest = rest.join(cold, rest["label"].eqNullSafe(F.col("sum_label"))).drop("sum_label")
    return done.unionByName(rest)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every kept row; see ``encode``."""
    coded, books = encode(vectors, id_col, vector_col, label_col, parts, entries, rounds, scale)
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return with_label_error(coded).withColumn("codebooks_sha256", F.lit(digest))
