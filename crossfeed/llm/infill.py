"""Fill-in-middle transformation by displacement scatter.

A text is cut into prefix, middle and suffix at line ends and written as ``<P>prefix<S>suffix<M>middle`` (psm) or
``<S>suffix<P>prefix<M>middle`` (spm). All texts of an Arrow batch lie in one byte buffer, and so do all outputs. A scan
of the line ends gives the cuts; at the start of each piece a difference array holds by how much the piece moves further
than the one before it; its cumulative sum is the shift of every byte, and one numpy scatter puts the bytes in place. The
inverse finds the marks in the outputs, makes the shifts of the same pieces from them, and gathers.

Both go through the buffer in blocks of ``BLOCK`` bytes that hand the running shift on, so beside the two buffers the
memory is bounded whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import in_small_batches

#: Percent of the texts that are transformed, and percent of those that are written as spm.
RATE, SPM_RATE = 100, 50
SEED = "7"
#: Marks in front of the pieces; a text that holds one stays plain.
MARKS = ("<P>", "<S>", "<M>")
#: Order of prefix (0), suffix (1) and middle (2) in the output.
ORDERS = {"psm": (0, 1, 2), "spm": (1, 0, 2)}
#: Bytes that are moved at a time.
BLOCK = 1 << 20

_PREFIX, _SUFFIX, _MIDDLE = (np.frombuffer(mark.encode(), np.uint8) for mark in MARKS)
_MARK = np.stack([_PREFIX, _SUFFIX, _MIDDLE])
_SIZE = _MARK.shape[1]


def draws(key: Column, seed: str = SEED) -> list[Column]:
    """Four numbers below 2^32 that depend on the key and the seed only; a NULL key counts as the empty text."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * n, 8), 16, 10).cast("long") for n in range(4)]


def _shifts(starts: np.ndarray, shifts: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, target of each byte) of the blocks of a buffer whose pieces begin at ``starts`` and move by ``shifts``.

    Pieces are in order and start at byte 0; of those that start at the same byte the last one counts, the others are empty.
    """
    steps = np.diff(shifts, prepend=0)
    carried = 0
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        difference = np.zeros(high - low, np.int64)
        first, last = np.searchsorted(starts, [low, high])
        np.add.at(difference, starts[first:last] - low, steps[first:last])
        moved = np.cumsum(difference) + carried
        carried = int(moved[-1])
        yield low, moved + np.arange(low, high)


def scatter(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray) -> None:
    """Put every byte of ``data`` where its piece goes in ``out``."""
    for low, targets in _shifts(starts, shifts, len(data)):
        out[targets] = data[low:low + len(targets)]


def gather(data: np.ndarray, starts: np.ndarray, shifts: np.ndarray, out: np.ndarray) -> None:
    """Fetch every byte of ``out``, whose pieces begin at ``starts``, from where it lies in ``data``."""
    for low, sources in _shifts(starts, shifts, len(out)):
        out[low:low + len(sources)] = data[sources]


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; NULL is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, 8 * column.offset)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _texts(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(offsets.astype(np.int64))
    return pa.LargeStringArray.from_buffers(offsets.size // 8 - 1, offsets, pa.py_buffer(data)).cast(pa.string())


def _marked(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, mark, byte) of every mark inside a row, in the order of the bytes."""
    opened = np.flatnonzero(data[:max(len(data) - 2, 0)] == _PREFIX[0])
    opened = opened[data[opened + 2] == _PREFIX[2]]
    kinds = data[opened + 1][:, None] == _MARK[:, 1]
    opened, kinds = opened[kinds.any(1)], kinds[kinds.any(1)].argmax(1)
    rows = np.searchsorted(offsets, opened, "right") - 1
    inside = opened + _SIZE <= offsets[rows + 1]
    return rows[inside], kinds[inside], opened[inside]


def cut(data: np.ndarray, offsets: np.ndarray, numbers: np.ndarray, rate: int, spm_rate: int) -> dict[str, np.ndarray]:
    """Number of lines, form (0 plain, 1 psm, 2 spm) and the ends of prefix and middle (bytes) of every row."""
    rows = len(offsets) - 1
    ends = np.flatnonzero(data == 10) + 1
    first = np.searchsorted(ends, offsets[:-1], "right")
    closed = np.searchsorted(ends, offsets[1:], "right") - first
    filled = offsets[1:] > offsets[:-1]
    last = np.where(filled, data[np.maximum(offsets[1:] - 1, 0)], 10) if len(data) else np.full(rows, 10)
    lines = closed + (last != 10)
    chosen = np.sort(numbers[:, :2] % (lines + 1)[:, None], axis=1)

    def place(unit: np.ndarray) -> np.ndarray:
        """The byte behind so many lines of each row."""
        at = np.clip(first + unit - 1, 0, max(len(ends) - 1, 0))
        behind = ends[at] if len(ends) else np.zeros(rows, np.int64)
        return np.where(unit == 0, offsets[:-1], np.where(unit > closed, offsets[1:], behind))

    form = np.where(numbers[:, 3] % 100 < spm_rate, 2, 1)
    form[(numbers[:, 2] % 100 >= rate) | ~filled] = 0
    form[_marked(data, offsets)[0]] = 0
    return {"lines": lines, "form": form, "a": place(chosen[:, 0]), "b": place(chosen[:, 1])}


def _pieces(starts: np.ndarray, a: np.ndarray, b: np.ndarray, ends: np.ndarray, form: np.ndarray,
            out_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts of the pieces in the texts, their shifts into the outputs, bytes of the marks in the outputs).

    Every row has three pieces in the order of its text: prefix, middle, suffix. Those of a plain row all move alike.
    """
    prefix, middle, suffix = a - starts, b - a, ends - b
    psm, moved = form == 1, form > 0
    to_prefix = out_starts + _SIZE * moved + np.where(form == 2, _SIZE + suffix, 0)
    to_suffix = np.where(moved, out_starts + _SIZE + np.where(psm, prefix + _SIZE, 0), out_starts + b - starts)
    to_middle = np.where(moved, out_starts + 3 * _SIZE + prefix + suffix, out_starts + a - starts)
    places = np.stack([starts, a, b], 1).ravel()
    shifts = (np.stack([to_prefix, to_middle, to_suffix], 1) - np.stack([starts, a, b], 1)).ravel()
    marks = np.stack([to_prefix, to_suffix, to_middle], 1)[moved] - _SIZE
    return places, shifts, marks


def rearranged(data: np.ndarray, offsets: np.ndarray, cuts: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs."""
    sizes = np.diff(offsets) + np.where(cuts["form"] > 0, 3 * _SIZE, 0)
    out_offsets = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(int(out_offsets[-1]), np.uint8)
    starts, shifts, marks = _pieces(offsets[:-1], cuts["a"], cuts["b"], offsets[1:], cuts["form"], out_offsets[:-1])
    scatter(data, starts, shifts, out)
    for kind in range(3):
        out[marks[:, kind][:, None] + np.arange(_SIZE)] = _MARK[kind]
    return out, out_offsets


def put_back(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that the outputs were made of."""
    moved = form > 0
    rows, kinds, places = _marked(data, offsets)
    at = np.repeat(offsets[:-1][:, None], 3, axis=1)
    wanted = moved[rows]
    at[rows[wanted], kinds[wanted]] = places[wanted]
    sizes = np.diff(offsets) - np.where(moved, 3 * _SIZE, 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # a piece ends where the next mark begins, or with the output
    suffix_end = np.where(form == 1, at[:, 2], at[:, 0])
    prefix_end = np.where(form == 1, at[:, 1], at[:, 2])
    prefix = np.where(moved, prefix_end - at[:, 0] - _SIZE, sizes)
    suffix = np.where(moved, suffix_end - at[:, 1] - _SIZE, 0)
    a, b = starts[:-1] + prefix, starts[1:] - suffix
    out = np.empty(int(starts[-1]), np.uint8)
    places, shifts, _ = _pieces(starts[:-1], a, b, starts[1:], form, offsets[:-1])
    gather(data, places, shifts, out)
    return out, starts


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: int = RATE,
              spm_rate: int = SPM_RATE, seed: str = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    ``n`` is the number of lines. ``form`` is ``plain`` where the text is NULL or empty, holds a mark, or is not among the
    ``rate`` percent to transform; ``output`` then is the text (empty for NULL), and the lengths (code points) are NULL.
    Cuts depend on the id and the seed only, so rows that share an id are cut by the same numbers; a NULL id counts as
    the empty text. Repeated rows stay; other columns are not looked at. An empty table gives an empty result.
    """
    names = ["h1", "h2", "h3", "h4"]
    rows = in_small_batches(docs).select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
        *[number.alias(name) for number, name in zip(draws(F.col(id_col), seed), names)])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, offsets = _bytes(batch.column("text"))
            numbers = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in names], 1)
            cuts = cut(data, offsets, numbers, rate, spm_rate)
            # code points up to each byte that matters
            ends = [offsets[:-1], cuts["a"], cuts["b"]]
            counted = _points_before(data, ends)
            plain = cuts["form"] == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(cuts["lines"], pa.int64()),
                 pa.array(np.array(["plain", "psm", "spm"])[cuts["form"]], pa.string()),
                 pa.array(counted[1] - counted[0], pa.int64(), mask=plain),
                 pa.array(counted[2] - counted[1], pa.int64(), mask=plain),
                 _texts(*rearranged(data, offsets, cuts))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(moved, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def _points_before(data: np.ndarray, places: list[np.ndarray]) -> list[np.ndarray]:
    """Code points that begin before each byte, block by block."""
    everywhere = np.unique(np.concatenate(places))
    found, done = np.zeros(len(everywhere), np.int64), 0
    for low in range(0, max(len(data), 1), BLOCK):
        counts = np.concatenate([[0], np.cumsum((data[low:low + BLOCK] & 0xC0) != 0x80)])
        first, last = np.searchsorted(everywhere, low), np.searchsorted(everywhere, low + len(counts) - 1, "right")
        found[first:last] = done + counts[everywhere[first:last] - low]
        done += int(counts[-1])
    return [found[np.searchsorted(everywhere, place)] for place in places]


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of; the empty text for a plain NULL."""
    def back(outputs: pd.Series, forms: pd.Series) -> pd.Series:
        data, offsets = _bytes(pa.array(outputs, pa.large_string()))
        numbers = forms.map({"plain": 0, "psm": 1, "spm": 2}).to_numpy(np.int64)
        return _texts(*put_back(data, offsets, numbers)).to_pandas()
    return F.pandas_udf(back, "string")(output, form)
