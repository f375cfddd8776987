"""How a remote table is cut into Spark partitions.

Every cut is a list of predicates that are disjoint and together cover every row, NULL keys included, so the union
of the partitions is the whole table whatever the bounds are. All ranges are half open: one ends where the next begins,
so no key lies between two of them, whatever its type.

Ranges are equal steps between two bounds, or hold equal numbers of rows by a histogram that the database makes of the
key: one statement, which goes once through the key's index and returns a cut per partition.
"""

from __future__ import annotations

import datetime as dt
import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal
from itertools import groupby

from crossfeed.errors import ExternalError

#: Rows of a partition nobody asked a number for, and below how many more than one is not worth a connection.
ROWS_PER_PARTITION, FEWEST_ROWS = 500_000, 10_000
#: Steps between two bounds that are no whole numbers.
FLOAT_STEPS = 1 << 40

#: A cut behind all rows of a key.
AFTER = object()

_EPOCH = dt.datetime(1970, 1, 1)
_MICROSECOND = dt.timedelta(microseconds=1)
_DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class Axis:
    """Keys as whole numbers between two bounds, and the SQL literal of any number between them.

    ``is_integer`` tells whether the bounds are integers of Python; keys of such a column can still be other numbers.
    """

    low: int
    high: int
    literal: Callable[[int], str]
    is_integer: bool


def key_bounds(admin, relation: str, column: str, counted: bool = True) -> tuple:
    """Smallest and largest key and the number of rows, by one remote aggregate; two look-ups in an index if not counted."""
    return (*admin.ends(relation, admin.quote(column), counted), None)[:3]


def axis_of(low, high, time_literal: Callable[[dt.date], str]) -> Axis | None:
    """The axis of two bounds that are numbers, dates or timestamps; None for any other key, text for instance."""
    whole = isinstance(low, int) and isinstance(high, int)
    low, high = _known(low), _known(high)
    if isinstance(low, int) and isinstance(high, int):
        return Axis(low, high, str, whole)
    if isinstance(low, (int, float)) and isinstance(high, (int, float)):
        return _float_axis(float(low), float(high)) if math.isfinite(high - low) else None
    if low is None or type(low) is not type(high):
        return None
    if isinstance(low, dt.datetime):
        return Axis((low - _EPOCH) // _MICROSECOND, (high - _EPOCH) // _MICROSECOND,
                    lambda number: time_literal(_EPOCH + number * _MICROSECOND), False)
    return Axis((low - _EPOCH.date()).days, (high - _EPOCH.date()).days,
                lambda number: time_literal(_EPOCH.date() + number * _DAY), False)


def _float_axis(low: float, high: float) -> Axis:
    if low == high:
        return Axis(0, 0, lambda number: repr(low), False)
    return Axis(0, FLOAT_STEPS - 1, lambda number: repr(low + (high - low) * (number / FLOAT_STEPS)), False)


def _known(value):
    if isinstance(value, Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, str):
        for kind in (dt.date, dt.datetime):
            try:
                return kind.fromisoformat(value)
            except ValueError:
                continue
        return None
    return value if isinstance(value, (int, float, dt.date)) else None


def partition_count(rows: int, cores: int) -> int:
    """Partitions nobody asked a number for: ``ROWS_PER_PARTITION`` rows each, but one per core where that is fewer.

    How many of them read at a time is up to the cores, so large tables have no cap on their number.
    """
    return max(1, -(-int(rows) // ROWS_PER_PARTITION), min(cores, int(rows) // FEWEST_ROWS))


def range_predicates(column: str, axis: Axis, count: int) -> list[str]:
    """Equal ranges of the key; ``column`` is already quoted. NULL keys join the first range."""
    low, high = axis.low, axis.high
    count = max(1, min(count, high - low + 1))
    if count == 1:
        return ["1 = 1"]
    cuts = list(dict.fromkeys(axis.literal(low + (high - low + 1) * n // count) for n in range(1, count)))
    first = [f"{column} < {cuts[0]} OR {column} IS NULL"]
    middle = [f"{column} >= {left} AND {column} < {right}" for left, right in zip(cuts, cuts[1:])]
    return first + middle + [f"{column} >= {cuts[-1]}"]


def balanced_predicates(admin, relation: str, column: str, count: int, tie_column: str | None = None,
                        rows: int | None = None) -> list[str]:
    """Ranges of a key with about the same number of rows each, however the keys are spread and whatever their type.

    The database numbers the rows in the order of the key and returns every n-th key, ``count - 1`` at most. It sorts
    and compares the cuts itself, so they hold under any collation. A key that several cuts fall on is hot: its rows are
    one range, or several along ``tie_column``, whose NULLs come first. NULL keys join the first range. ``rows`` saves
    the counting where the number is known.
    """
    if count < 1:
        raise ExternalError("Parameter 'num_partitions' must be at least 1")
    name = admin.quote(column)
    if rows is None:
        rows = admin.filled(relation, name)
    names = [name] + ([admin.quote(tie_column)] if tie_column and tie_column != column else [])
    step = max(1, -(-int(rows) // count))
    if step >= rows:
        return ["1 = 1"]
    return _between(names, _cuts_of(admin, admin.nth_rows(relation, names, step)))


def _cuts_of(admin, found: list[tuple]) -> list[tuple[str, object]]:
    """Places of cuts in the database's order: (key, None) before all rows of a key, (key, ``AFTER``) behind them, or
    (key, tie) inside a hot one. Keys and ties that have no literal make no cut; the ranges beside it are one.
    """
    known = [(text, *tie) for key, *tie in found if (text := literal(admin, key)) is not None]
    cuts: list[tuple[str, object]] = []
    for key, group in groupby(known, lambda row: row[0]):
        rows = list(group)
        if len(rows[0]) == 1:
            cuts += [(key, None)] + [(key, AFTER)] * (len(rows) > 1)
            continue
        ties = dict.fromkeys(literal(admin, tie) for _, tie in rows)
        cuts += [(key, None)] * (None in ties) + [(key, tie) for tie in ties if tie is not None]
    return cuts


def _between(names: list[str], cuts: list[tuple[str, object]]) -> list[str]:
    """The predicates of the ranges before, between and after cuts."""
    if not cuts:
        return ["1 = 1"]
    key, tie = names[0], names[-1]

    def from_(cut):
        value, mark = cut
        if mark is AFTER:
            return f"{key} > {value}"
        return f"{key} >= {value}" if mark is None else f"{key} >= {value} AND ({key} > {value} OR {tie} >= {mark})"

    def before(cut):
        value, mark = cut
        if mark is AFTER:
            return f"{key} <= {value}"
        return (f"{key} < {value}" if mark is None
                else f"{key} <= {value} AND ({key} < {value} OR {tie} < {mark} OR {tie} IS NULL)")

    return [f"({before(cuts[0])}) OR {key} IS NULL",
            *[f"{from_(left)} AND {before(right)}" for left, right in zip(cuts, cuts[1:])], from_(cuts[-1])]


def literal(admin, value) -> str | None:
    """The SQL literal of a key as the database returned it; None for a kind that has none."""
    if isinstance(value, bool) or value is None:
        return None
    if isinstance(value, int):
        return str(value)
    if isinstance(value, Decimal):
        return f"{value:f}" if value.is_finite() else None
    if isinstance(value, float):
        return repr(value) if math.isfinite(value) else None
    if isinstance(value, dt.date):
        return admin.time_literal(value)
    if isinstance(value, (bytes, bytearray, memoryview)):
        return admin.bytes_literal(bytes(value))
    if isinstance(value, uuid.UUID):
        return f"'{value}'"
    return admin.text_literal(value) if isinstance(value, str) else None
