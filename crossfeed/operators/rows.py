"""Row access by order: first and last rows, positions, skipping, prior rows, NULL fallbacks.

Orders are ascending and NULL is the lowest value, as in Spark's own sort.

Global positions never sort the whole input in one task. Rows are range-partitioned by all order columns, so a hot
value of the first column is cut by the following ones; each partition numbers its own rows, and one row per
partition carries the offsets. The numbered rows are checkpointed, because sampled range bounds may differ when they
are computed again.

Single positions need no numbering: the key at a position is found by counting the rows below a few sampled keys, again
and again in the range that holds the position. Only counts and keys come to the driver, nothing is shuffled, and what
is left for a sort is ``SORTED_ROWS`` keys at most. Such passes read the frame several times, so it has to give the same
rows each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crossfeed.functions.types import column_of
from crossfeed.operators.checkpoints import checkpointed

_PART, _PLACE = "cf_part", "cf_place"
_PART_BITS = 33
#: Rows that all tasks together may keep while the first ones are sought.
KEPT_ROWS = 100_000
#: Keys that a pass counts the rows below of, how many are sampled to choose them from, and how many rows are sorted.
PIVOTS, SAMPLED_KEYS, SORTED_ROWS = 48, 1_000, 20_000


def first_row(frame: DataFrame, order: list[str]) -> DataFrame:
    """The first row in an order; only one row per task leaves it."""
    return frame.orderBy(*[column_of(name).asc() for name in order]).limit(1)


def last_row(frame: DataFrame, order: list[str]) -> DataFrame:
    return frame.orderBy(*[column_of(name).desc() for name in order]).limit(1)


def first_last_per_group(frame: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """First and last values per group, as ``first_<column>`` and ``last_<column>``; partial results are combined
    before the shuffle, so a group that holds most rows costs no more than another."""
    by = F.struct(*[column_of(name) for name in order])
    value = F.struct(*[column_of(name) for name in columns])
    ends = frame.groupBy(*[column_of(key) for key in keys]).agg(
        F.min_by(value, by).alias("cf_first"), F.max_by(value, by).alias("cf_last"))
    return ends.select(*[column_of(key) for key in keys],
                       *[F.col("cf_first")[name].alias(f"first_{name}") for name in columns],
                       *[F.col("cf_last")[name].alias(f"last_{name}") for name in columns])


def with_position(frame: DataFrame, order: list[str], name: str = "position",
                  num_partitions: int | None = None) -> DataFrame:
    """Every row with its one-based position. Rows the order does not tell apart are placed by their content."""
    numbered = _numbered(frame, order, num_partitions)
    return (numbered.join(F.broadcast(_offsets(numbered)), _PART)
            .withColumn(name, F.col("cf_before") + F.col(_PLACE) + 1)
            .drop(_PART, _PLACE, "cf_before"))


def row_at(frame: DataFrame, order: list[str], position: int) -> DataFrame:
    """The row at a one-based position, with that position; rows that the order does not tell apart go by their content.

    A few counting passes over the order columns find its key; the frame returned is a filter on that key. No row if the
    position is not in the frame.
    """
    placed = F.lit(position).cast("bigint").alias("position")
    if 1 <= position and _is_kept(frame, position):
        return _first_rows(frame, order, position - 1, 1).select("*", placed)
    found = _place(frame, order, position)
    if found is None:
        return frame.filter(F.lit(False)).select("*", placed)
    return frame.filter(found.compared(frame, "==")).limit(1).select("*", placed)


def skip_rows(frame: DataFrame, order: list[str], skip: int, take: int | None = None) -> DataFrame:
    """Rows after the first ``skip``, at most ``take`` of them. Up to ``SORTED_ROWS`` taken are sorted, more are in no order.

    The keys at both ends are found by counting; the frame returned is a filter between them. Only of rows that are equal
    in every column and lie across an end some are numbered.
    """
    skip = max(skip, 0)
    if take is not None and take <= 0:
        return frame.filter(F.lit(False))
    if take is not None and _is_kept(frame, skip + take):
        return _first_rows(frame, order, skip, take)
    first = _place(frame, order, skip + 1) if skip else None
    if skip and first is None:
        return frame.filter(F.lit(False))
    last = _place(frame, order, skip + take) if take is not None else None
    if first is not None and last is not None and first.values == last.values:
        return _some(frame.filter(first.compared(frame, "==")), take)
    parts, inside = [], F.lit(True)
    for end, strict, wide, kept in ((first, ">", ">=", lambda: first.before + first.ties - skip),
                                    (last, "<", "<=", lambda: skip + take - last.before)):
        if end is None:
            continue
        if kept() == end.ties:
            inside = inside & end.compared(frame, wide)
        else:
            inside = inside & end.compared(frame, strict)
            parts.append(_some(frame.filter(end.compared(frame, "==")), kept()))
    found = reduce(DataFrame.unionByName, parts, frame.filter(inside))
    if take is None or take > SORTED_ROWS:
        return found
    return found.orderBy(*[column_of(name) for name in order], _row_hash(found))


def _is_kept(frame: DataFrame, rows: int) -> bool:
    """Whether every task may keep so many rows; a top-k then needs no pass to find its ends."""
    return rows <= KEPT_ROWS and rows * frame.rdd.getNumPartitions() <= KEPT_ROWS


def _first_rows(frame: DataFrame, order: list[str], skip: int, take: int) -> DataFrame:
    return frame.orderBy(*[column_of(name) for name in order], _row_hash(frame)).offset(skip).limit(take)


def _some(rows: DataFrame, count: int) -> DataFrame:
    """So many of rows that are all alike, each partition giving its share."""
    row_id = F.monotonically_increasing_id()
    numbered = checkpointed(rows.withColumn("cf_id", row_id).withColumn(_PART, F.shiftright("cf_id", _PART_BITS))
                            .withColumn(_PLACE, F.col("cf_id").bitwiseAND(F.lit((1 << _PART_BITS) - 1))).drop("cf_id"))
    return (numbered.join(F.broadcast(_offsets(numbered)), _PART).filter(F.col("cf_before") + F.col(_PLACE) < count)
            .drop(_PART, _PLACE, "cf_before"))


@dataclass(frozen=True)
class _Place:
    """The key at a position: values of the order columns and, where these are not unique there, of the row's hash."""

    order: tuple[str, ...]
    values: tuple
    kinds: tuple[T.DataType, ...]
    before: int
    ties: int

    def compared(self, frame: DataFrame, how: str) -> Column:
        """Whether rows of the frame are before, at or behind the key."""
        return _compared(_keys(frame, self.order, len(self.values) > len(self.order)), self.kinds, self.values, how)


def _keys(frame: DataFrame, order: tuple[str, ...], hashed: bool) -> list[Column]:
    """Order columns whose values can go through the driver: instants as microseconds, dates as days."""
    whole = {T.TimestampType: F.unix_micros, T.DateType: F.unix_date}
    keys = [whole.get(type(frame.schema[name].dataType), lambda key: key)(column_of(name)) for name in order]
    return keys + ([_row_hash(frame)] if hashed else [])


def _compared(keys: list[Column], kinds, values: tuple, how: str) -> Column:
    """Keys against values, NULL lowest, as the sort has it."""
    names = [f"cf_key_{n}" for n in range(len(keys))]
    left = F.struct(*[key.alias(name) for key, name in zip(keys, names)])
    right = F.struct(*[F.lit(value).cast(kind).alias(name) for value, kind, name in zip(values, kinds, names)])
    return {"<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right, "==": left == right}[how]


def _place(frame: DataFrame, order: list[str], position: int) -> _Place | None:
    """The key at a position, first by the order columns alone, then, among equal ones, by the hash of the rows."""
    order = tuple(order)
    found = _selected(frame, _keys(frame, order, False), position)
    if found is None:
        return None
    values, before, ties, kinds = found
    if ties > 1:
        alike = frame.filter(_Place(order, values, kinds, before, ties).compared(frame, "=="))
        (mark,), more, ties, (kind,) = _selected(alike, [_row_hash(frame)], position - before)
        values, kinds, before = (*values, mark), (*kinds, kind), before + more
    return _Place(order, values, kinds, before, ties)


def _selected(frame: DataFrame, keys: list[Column], position: int) -> tuple[tuple, int, int, tuple] | None:
    """(values, rows before, rows equal, types) of the key at a position; None outside the frame."""
    names = [f"cf_key_{n}" for n in range(len(keys))]
    inside = frame.select(*[key.alias(name) for key, name in zip(keys, names)])
    kinds = tuple(field.dataType for field in inside.schema)
    columns = [F.col(name) for name in names]
    before, rows, seed = 0, inside.count(), 0
    if not 1 <= position <= rows:
        return None

    def counted(values: tuple, how: str) -> Column:
        return F.count_if(_compared(columns, kinds, values, how))

    while rows > SORTED_ROWS:
        seed += 1
        drawn = inside.sample(fraction=min(1.0, SAMPLED_KEYS / rows), seed=seed).orderBy(*columns).collect()
        drawn = drawn or inside.limit(1).collect()
        step = max(1, len(drawn) // PIVOTS)
        pivots = list(dict.fromkeys(tuple(row) for row in drawn[step // 2::step]))
        sides = [counted(pivot, how) for pivot in pivots for how in ("<", "<=")]
        # two numbers per pivot
        counts = inside.agg(*[side.alias(f"n{n}") for n, side in enumerate(sides)]).first()
        low, high, below, upto = None, None, 0, rows
        for number, pivot in enumerate(pivots):
            less, most = counts[2 * number], counts[2 * number + 1]
            if before + less < position <= before + most:
                return pivot, before + less, most - less, kinds
            if before + most < position and most >= below:
                low, below = pivot, most
            elif position <= before + less and less < upto:
                high, upto = pivot, less
        for pivot, how in ((low, ">"), (high, "<")):
            if pivot is not None:
                inside = inside.filter(_compared(columns, kinds, pivot, how))
        before, rows = before + below, upto - below
    row = tuple(inside.orderBy(*columns).offset(position - before - 1).limit(1).first())
    less, same = inside.agg(counted(row, "<").alias("less"), counted(row, "==").alias("same")).first()
    return row, before + less, same, kinds


def _row_hash(frame: DataFrame) -> Column:
    return F.xxhash64(*[column_of(name) for name in frame.columns])


def prior_row(frame: DataFrame, order: list[str], columns: list[str], prefix: str = "prior_",
              num_partitions: int | None = None) -> DataFrame:
    """Every row with values of the row before it. Only the first row of a partition looks at another partition.

    Inside a sorted partition the values move on by one row in a single pass over its Arrow batches.
    """
    priors = [T.StructField(f"cf_prior_{n}", frame.schema[name].dataType) for n, name in enumerate(columns)]

    def shifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            own = [batch.column(batch.schema.get_field_index(name)) for name in columns]
            before = held or [pa.nulls(1, column.type) for column in own]
            moved = [pa.concat_arrays([first, column.slice(0, batch.num_rows - 1)]) for first, column in zip(before, own)]
            held = [column.slice(batch.num_rows - 1) for column in own]
            yield pa.RecordBatch.from_arrays(batch.columns + moved, batch.schema.names + [f.name for f in priors])

    schema = T.StructType([T.StructField(f.name, f.dataType) for f in frame.schema.fields] + priors)
    numbered = _numbered(frame, order, num_partitions, lambda ordered: ordered.mapInArrow(shifted, schema))
    values = F.struct(*[column_of(name) for name in columns])
    # One row per non-empty partition: its last values, handed to the next non-empty partition.
    edges = numbered.groupBy(_PART).agg(F.max_by(values, _PLACE).alias("cf_edge"))
    handed = edges.select(_PART, F.lag("cf_edge").over(Window.orderBy(_PART)).alias("cf_handed"))
    joined = numbered.join(F.broadcast(handed), _PART)
    return joined.select(*[column_of(name) for name in frame.columns],
                         *[F.when(F.col(_PLACE) == 0, F.col("cf_handed")[name]).otherwise(F.col(f"cf_prior_{n}"))
                           .alias(prefix + name) for n, name in enumerate(columns)])


def _numbered(frame: DataFrame, order: list[str], num_partitions: int | None, also=lambda ordered: ordered) -> DataFrame:
    """Sorted range partitions with partition number and place; both come with the generated row id.

    ``also`` is done to the sorted partitions before they are numbered, and keeps their rows in order.
    """
    spark = frame.sparkSession
    parts = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                                  spark.sparkContext.defaultParallelism)
    # Rows that the order does not tell apart are cut by their content, so that they too fill several partitions.
    by = [*[column_of(name) for name in order], _row_hash(frame)]
    ordered = also(frame.repartitionByRange(parts, *by).sortWithinPartitions(*by))
    row_id = F.monotonically_increasing_id()
    return checkpointed(ordered.withColumn("cf_id", row_id)
                        .withColumn(_PART, F.shiftright("cf_id", _PART_BITS))
                        .withColumn(_PLACE, F.col("cf_id").bitwiseAND(F.lit((1 << _PART_BITS) - 1)))
                        .drop("cf_id"))


def _offsets(numbered: DataFrame) -> DataFrame:
    """Rows before each partition. One row per partition, so the window over all of them stays small."""
    sizes = numbered.groupBy(_PART).agg(F.count(F.lit(1)).alias("cf_size"))
    before = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(_PART, F.coalesce(F.sum("cf_size").over(before), F.lit(0)).alias("cf_before"))


def with_fallback(column: Column, value) -> Column:
    """The value, or a fallback where it is NULL."""
    return F.coalesce(column, F.lit(value))


def null_test(frame: DataFrame, columns: list[str], suffix: str = "_is_null") -> DataFrame:
    return frame.select("*", *[column_of(name).isNull().alias(name + suffix) for name in columns])
