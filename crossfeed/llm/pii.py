"""Personal data by fixed patterns and a character-level bidirectional LSTM with CRF transitions.

The patterns find e-mail and IP addresses, card and phone numbers that keep their checks. The network is trained in numpy
on labelled spans: those the patterns find in a bounded sample of documents, as they are and rewritten in ways that no
pattern matches (``name [at] host``, numbers without their plus sign). Whole texts are cut into overlapping windows;
windows in which no label can win are passed over exactly, the others are decoded by Viterbi, and of each stretch the
window in whose core it lies decides. A span that the network adds never overlaps one that a pattern found or whose
checks failed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import drawn, in_small_batches, settled

KINDS = ("email", "ip", "card", "phone")
#: Documents, about, whose spans the network is trained on: so many with something that looks like personal data, and
#: others besides.
SAMPLE_ROWS, OTHER_ROWS = 6_000, 2_000
#: What a text with a span of the patterns has; it lets more texts through than hold one.
LOOKS_PERSONAL = r"(?=[@0-9+])(?:@[A-Za-z0-9-]+\.|[0-9]\.[0-9]+\.[0-9]+\.[0-9]|[0-9]([ -]?[0-9]){12}|\+[0-9][ ().0-9-]+[0-9])"
#: Windows at most that one sampled document gives, and all of them.
WINDOWS_PER_ROW, TRAINING_WINDOWS = 6, 4_000
HIDDEN, TRAINING_WIDTH, BATCH, EPOCHS, RATE = 12, 96, 64, 14, 0.02
#: Gates are straight lines of this slope between shut and open (the usual hard form of the logistic function).
SLOPE = np.float32(0.2)
#: Width of the windows of whole texts, and how much of each end is left to the neighbour.
WIDTH, MARGIN, LANES = 512, 32, 384
#: Windows are computed in multiples of so many, so that a window's numbers do not depend on how many there are.
LANE_BLOCK = 16
#: Score of a label behind the end of a text.
NEVER = np.float32(1e6)
#: Mean lead of a label over none, per character, and length that an added span needs.
LEAD, SHORTEST = 2.0, 7

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Every run of digits, with three more if they follow: a search that starts with a set of characters skips the rest fast.
_IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# characters: 0 outside the text, 1-26 letters, 27 digits, 28 other letters, 29 blanks, 30 line ends, then ASCII marks
_MARKS = [c for c in range(33, 127) if not chr(c).isalnum()]
_CLASSES = 31 + len(_MARKS) + 1
_CLASS = np.full(257, 28, np.uint8)
for _c in range(256):
    _CLASS[_c] = (1 + ord(chr(_c).lower()) - 97 if chr(_c).isascii() and chr(_c).isalpha() else 27 if 48 <= _c <= 57
                  else 28 if chr(_c).isalpha() else 30 if _c in (10, 13) else 29 if _c in (9, 11, 12, 32, 160)
                  else 31 + _MARKS.index(_c) if _c in _MARKS else _CLASSES - 1)


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[int, int]]]:
    """(spans, failed): what the patterns find and what matched but failed its check. Linear in the text."""
    spans, failed = [], []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            spans.append(("email", start, domain.end()))
            done = domain.end()
        at = text.find("@", max(at + 1, done))
    for m in _IP.finditer(text):
        if m.group(1) is None:
            continue
        good = all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split("."))
        spans.append(("ip", *m.span())) if good else failed.append(m.span())
    for m in _CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() <= 64 else ""
        if 13 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", *m.span()))
        elif len(digits) >= 13 or not digits:
            failed.append(m.span())
    for m in _PHONE.finditer(text):
        good = 9 <= sum(c.isdigit() for c in m.group()) <= 15
        spans.append(("phone", *m.span())) if good else failed.append(m.span())
    return spans, failed


def classes(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return _CLASS[np.minimum(points, 256)]


# The network. Arrays are (time, features, lanes); gates are input, forget, output, candidate.

def new_model(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    k = len(KINDS) + 1
    model = {}
    for way in ("f", "b"):
        model["x" + way] = rng.normal(0, 0.3, (4 * HIDDEN, _CLASSES)).astype(np.float32)
        model["x" + way][HIDDEN:2 * HIDDEN] += 1.0
        model["u" + way] = rng.normal(0, 0.2, (4 * HIDDEN, HIDDEN)).astype(np.float32)
    model["w"] = rng.normal(0, 0.2, (k, 2 * HIDDEN)).astype(np.float32)
    model["bias"] = np.zeros((k, 1), np.float32)
    model["t"] = np.zeros((k, k), np.float32)
    return model


def _run(x: np.ndarray, table: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states of one direction over x (time, lanes), and, for training, what the way back needs."""
    steps, lanes = x.shape
    n = HIDDEN
    scaled_u, scaled = u.copy(), table.copy()
    scaled_u[:3 * n] *= SLOPE
    scaled[:3 * n] = scaled[:3 * n] * SLOPE + np.float32(0.5)
    scaled[:3 * n, 0] = -60.0  # outside the text all gates are shut
    by_class = np.ascontiguousarray(scaled.T)
    shut, full = np.float32(0), np.float32(1)
    h, c = np.zeros((n, lanes), np.float32), np.zeros((n, lanes), np.float32)
    out, kept = np.empty((steps, n, lanes), np.float32), []
    g, z, tmp = (np.empty((4 * n, lanes), np.float32), np.empty((lanes, 4 * n), np.float32), np.empty((n, lanes), np.float32))
    gates, opened, forget, shown, cand = g[:3 * n], g[:n], g[n:2 * n], g[2 * n:3 * n], g[3 * n:]
    for t in range(steps):
        before = (h, c.copy()) if keep else None
        by_class.take(x[t], axis=0, out=z, mode="wrap")
        np.matmul(scaled_u, h, out=g)
        g += z.T
        gates.clip(shut, full, out=gates)
        np.tanh(cand, out=cand)
        c *= forget
        np.multiply(opened, cand, out=tmp)
        c += tmp
        np.tanh(c, out=tmp)
        if keep:
            kept.append((before[0], before[1], g.copy(), tmp.copy()))
        h = np.multiply(tmp, shown, out=out[t])
    return out, kept


def _back(x: np.ndarray, u: np.ndarray, kept: list, slope: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the table and the recurrent weights of one direction."""
    n = HIDDEN
    d_table, d_u = np.zeros((4 * n, _CLASSES), np.float32), np.zeros_like(u)
    dh, dc = np.zeros_like(slope[0]), np.zeros_like(slope[0])
    for t in range(len(x) - 1, -1, -1):
        h, c, g, tc = kept[t]
        i, f, o, cand = g[:n], g[n:2 * n], g[2 * n:3 * n], g[3 * n:]
        dh = dh + slope[t]
        dc = dc + dh * o * (1 - tc * tc)
        moves = SLOPE * ((g[:3 * n] > 0) & (g[:3 * n] < 1))
        dz = np.concatenate([dc * cand * moves[:n], dc * c * moves[n:2 * n], dh * tc * moves[2 * n:], dc * i * (1 - cand * cand)])
        one = np.zeros((x.shape[1], _CLASSES), np.float32)
        one[np.arange(x.shape[1]), x[t]] = 1
        d_table += dz @ one
        d_u += dz @ h.T
        dh, dc = u.T @ dz, dc * f
    return d_table, d_u


def emissions(model: dict, x: np.ndarray, keep: bool = False) -> tuple:
    """Label scores (time, labels, lanes) of x (time, lanes)."""
    f, kept_f = _run(x, model["xf"], model["uf"], keep)
    b, kept_b = _run(x[::-1], model["xb"], model["ub"], keep)
    b = b[::-1]
    e = np.matmul(model["w"][:, :HIDDEN], f) + np.matmul(model["w"][:, HIDDEN:], b) + model["bias"]
    return e, f, b, kept_f, kept_b


def _crf(e: np.ndarray, t: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the negative log likelihood of labels y (time, lanes) by emissions and transitions."""
    steps, k, lanes = e.shape
    a, b = np.empty_like(e), np.zeros_like(e)

    def fold(scores: np.ndarray, axis: int) -> np.ndarray:
        top = scores.max(axis)
        return top + np.log(np.exp(scores - np.expand_dims(top, axis)).sum(axis))

    a[0] = e[0]
    for s in range(1, steps):
        a[s] = e[s] + fold(a[s - 1][:, None, :] + t[:, :, None], 0)
    for s in range(steps - 2, -1, -1):
        b[s] = fold(t[:, :, None] + (e[s + 1] + b[s + 1])[None], 1)
    total = fold(a[-1], 0)
    slope = np.exp(a + b - total)
    pairs = np.exp(a[:-1, :, None, :] + t[None, :, :, None] + (e[1:] + b[1:])[:, None] - total)
    d_t = pairs.sum((0, 3))
    for i in range(k):
        slope[:, i] -= y == i
        for j in range(k):
            d_t[i, j] -= ((y[:-1] == i) & (y[1:] == j)).sum()
    return slope / lanes, d_t / lanes


def viterbi(e: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Best labels (time, lanes)."""
    steps, k, lanes = e.shape
    best, scores, moves = np.empty_like(e), np.empty((k, k, lanes), e.dtype), t[:, :, None]
    best[0] = e[0]
    for s in range(1, steps):
        np.add(best[s - 1][:, None, :], moves, out=scores)
        scores.max(0, out=best[s])
        best[s] += e[s]
    y = np.empty((steps, lanes), np.int8)
    y[-1] = best[-1].argmax(0)
    for s in range(steps - 1, 0, -1):
        y[s - 1] = (best[s - 1] + t.take(y[s], axis=1)).argmax(0)
    return y


def fit(texts: list[str], spans: list[list[tuple[str, int, int]]], seed: int = 5) -> dict[str, np.ndarray]:
    """A network for windows of ``TRAINING_WIDTH`` characters with their labelled spans, by Adam."""
    model = new_model(seed)
    x, y = np.zeros((len(texts), TRAINING_WIDTH), np.intp), np.zeros((len(texts), TRAINING_WIDTH), np.int8)
    for row, (text, found) in enumerate(zip(texts, spans)):
        coded = classes(text)[:TRAINING_WIDTH]
        x[row, :len(coded)] = coded
        for kind, start, end in found:
            y[row, start:min(end, TRAINING_WIDTH)] = 1 + KINDS.index(kind)
    rng = np.random.default_rng(seed)
    first, second = ({n: np.zeros_like(v) for n, v in model.items()} for _ in range(2))
    step, steps = 0, EPOCHS * max(1, len(x) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            if at and len(rows) < BATCH:
                continue
            xs, ys = np.ascontiguousarray(x[rows].T), y[rows].T
            e, f, b, kept_f, kept_b = emissions(model, xs, True)
            slope, d_t = _crf(e, model["t"], ys)
            back = np.einsum("kn,skl->snl", model["w"], slope)
            d = {"w": np.einsum("skl,snl->kn", slope, np.concatenate([f, b], 1)),
                 "bias": slope.sum((0, 2))[:, None], "t": d_t}
            d["xf"], d["uf"] = _back(xs, model["uf"], kept_f, back[:, :HIDDEN])
            d["xb"], d["ub"] = _back(xs[::-1], model["ub"], kept_b, back[::-1, HIDDEN:])
            step += 1
            size = np.sqrt(sum(float((v * v).sum()) for v in d.values()))
            rate = RATE * (1 - 0.9 * step / (steps + 1)) * min(1.0, 5.0 / max(size, 1e-9))
            for name, v in d.items():
                v = v.astype(np.float32)
                first[name] = 0.9 * first[name] + 0.1 * v
                second[name] = 0.99 * second[name] + 0.01 * v * v
                model[name] -= (rate * (first[name] / (1 - 0.9**step))
                                / (np.sqrt(second[name] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)
    return model


# Labelled windows.

def rewritten(kind: str, value: str, rng: np.random.Generator) -> str:
    """The same datum in a form that no pattern matches."""
    if kind == "email":
        at = (" [at] ", " (at) ", "[at]", " AT ")[rng.integers(4)]
        dot = (".", " [dot] ", "[.]")[rng.integers(3)]
        local, _, domain = value.partition("@")
        return local + at + domain.replace(".", dot)
    if kind == "ip":
        return value.replace(".", ("[.]", " . ", "(.)")[rng.integers(3)])
    if kind == "card":
        digits = re.sub("[^0-9]", "", value)
        return ("." if rng.integers(2) else "/").join(digits[i:i + 4] for i in range(0, len(digits), 4))
    digits = re.sub("[^0-9]", "", value)[-10:]
    form = ("({}) {}-{}", "{}-{}-{}", "tel {}.{}.{}", "{} {} {}")[rng.integers(4)]
    return form.format(digits[:3], digits[3:6], digits[6:])


def windows(text: str, seed: int) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Windows of one document with their spans: around its data, as they are and rewritten, and elsewhere."""
    rng = np.random.default_rng(seed)
    spans, _ = base_spans(text)
    chosen = [spans[i] for i in rng.permutation(len(spans))[:WINDOWS_PER_ROW // 2]]
    out = []
    for kind, start, end in chosen:
        others = [s for s in spans if s[1] < end and s[2] > start and s != (kind, start, end)]
        if others or end - start > TRAINING_WIDTH // 2:
            continue
        for value in (text[start:end], rewritten(kind, text[start:end], rng)):
            left = int(rng.integers(0, TRAINING_WIDTH - len(value))) if len(value) < TRAINING_WIDTH else 0
            head = text[max(0, start - left):start]
            near = [(k, s - start + len(head), e - start + len(head)) for k, s, e in spans if e <= start and s >= start - len(head)]
            piece = (head + value + text[end:end + TRAINING_WIDTH])[:TRAINING_WIDTH]
            stop = len(head) + len(value)
            after = [(k, s - end + stop, e - end + stop) for k, s, e in spans if s >= end and s - end + stop < TRAINING_WIDTH]
            out.append((piece, near + [(kind, len(head), stop)] + after))
    numbers = [m.start() for m in re.finditer(r"[0-9@]", text)]
    for _ in range(2):
        at = int(rng.integers(0, max(1, len(text) - TRAINING_WIDTH)))
        if numbers and rng.integers(2):
            at = max(0, numbers[rng.integers(len(numbers))] - int(rng.integers(1, TRAINING_WIDTH)))
        inside = [(k, s - at, e - at) for k, s, e in spans if s < at + TRAINING_WIDTH and e > at]
        out.append((text[at:at + TRAINING_WIDTH], [(k, max(s, 0), e) for k, s, e in inside]))
    return out


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
          other_rows: int = OTHER_ROWS) -> dict | None:
    """A network from a sample by a hash of the id; None if no text has personal data that the patterns find.

    About ``sample_rows`` ids are drawn from the texts that look as if they held some, so rare data is learned too, and
    ``other_rows`` from all. NULL ids and texts teach nothing.
    """
    rows = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .filter("doc_id IS NOT NULL AND text IS NOT NULL")
    looks = F.col("text").rlike(LOOKS_PERSONAL)
    total = rows.agg(F.count_if(looks).alias("looking"), F.count(F.lit(1)).alias("all")).first()
    some, other = drawn("doc_id", sample_rows, total["looking"]), drawn("doc_id", other_rows, total["all"])
    # the hash first: beyond the count, the pattern goes over the texts of few rows
    sample = rows.filter(some | other).filter((some & looks) | (other & ~looks)).select("text", F.xxhash64("doc_id").alias("seed"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(seed, n, w, ",".join(f"{k}:{s}:{e}" for k, s, e in spans))
                     for text, seed in zip(batch["text"], batch["seed"]) if text
                     for n, (w, spans) in enumerate(windows(text, abs(int(seed))))]
            yield pd.DataFrame(found, columns=["seed", "n", "text", "spans"])

    # at most sample_rows x (WINDOWS_PER_ROW + 2) windows of fixed width, of which as many as are used are fetched
    cutting = settled(sample.mapInPandas(cut, "seed long, n int, text string, spans string"))
    with_data = cutting.filter("spans <> ''").orderBy(F.xxhash64("seed", "n"), "text").limit(TRAINING_WINDOWS * 3 // 4).toPandas()
    without = cutting.filter("spans = ''").orderBy(F.xxhash64("seed", "n"), "text").limit(TRAINING_WINDOWS // 4).toPandas()
    if with_data.empty:
        return None
    both = pd.concat([with_data, without])
    spans = [[(k, int(s), int(e)) for k, s, e in (x.split(":") for x in row.split(",") if x)] for row in both["spans"]]
    return fit(list(both["text"]), spans)


# Whole texts.

def added_spans(texts: list[str], known: list[list[tuple[int, int]]], model: dict) -> list[list[tuple[str, int, int]]]:
    """Spans that the network finds in whole texts and that overlap none of the known ones."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    coded = [classes(t) for t in texts]
    step = WIDTH - 2 * MARGIN
    places = [(d, at) for d, c in enumerate(coded) for at in range(0, max(len(c) - 2 * MARGIN, 1), step) if len(c)]
    # windows of like lengths together, so that few steps are made behind the end of a text
    places.sort(key=lambda place: min(WIDTH, len(coded[place[0]]) - place[1]))
    reach = max(0.0, float((model["t"] - model["t"][0, 0]).max()))
    for group in range(0, len(places), LANES):
        part = places[group:group + LANES]
        ends = np.array([min(WIDTH, len(coded[d]) - at) for d, at in part])
        # a text that ends inside its window is followed by "no label" at least once, whatever else shares the group
        width = min(WIDTH, int(ends.max()) + 1)
        x = np.zeros((width, -(-len(part) // LANE_BLOCK) * LANE_BLOCK), np.intp)
        for lane, (d, at) in enumerate(part):
            x[:ends[lane], lane] = coded[d][at:at + ends[lane]]
        e = emissions(model, x)[0][:, :, :len(part)]
        shortest = int(ends.min())
        behind = np.arange(shortest, width)[:, None] >= ends
        e[shortest:, 1:] = np.where(behind[:, None], -NEVER, e[shortest:, 1:])
        e[shortest:, 0] = np.where(behind, 0, e[shortest:, 0])
        # a path that leaves "no label" gains at most its leads and two transitions per character
        lanes = np.flatnonzero((e[:, 1:].max(1) - e[:, 0]).max(0) + 2 * reach > 0)
        if not len(lanes):
            continue
        e = e.take(lanes, axis=2)
        labels = viterbi(e, model["t"])
        for column, lane in enumerate(lanes):
            y = labels[:, column]
            if not y.any():
                continue
            d, at = part[lane]
            edges = np.flatnonzero(np.diff(y)) + 1
            for start, end in zip(np.append(0, edges), np.append(edges, len(y))):
                kind = int(y[start])
                middle = (start + end) // 2
                core = (middle >= MARGIN or at == 0) and (middle < WIDTH - MARGIN or at + WIDTH >= len(coded[d]))
                if kind and core and (e[start:end, kind, column] - e[start:end, 0, column]).mean() >= LEAD:
                    found[d].append((KINDS[kind - 1], int(at + start), int(at + end)))
    return [_reconciled(text, spans, taken) for text, spans, taken in zip(texts, found, known)]


def _reconciled(text: str, spans: list[tuple[str, int, int]], taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    out: list[tuple[str, int, int]] = []
    taken = sorted(taken)
    for kind, start, end in sorted(spans, key=lambda s: s[1:]):
        while start < end and (text[start].isspace() or text[start] in ",;:!?*#$%&|"):
            start += 1
        while start < end and (text[end - 1].isspace() or text[end - 1] in ".,;:!?*#$%&|"):
            end -= 1
        while 0 < start < end and text[start].isalnum() and text[start - 1].isalnum():
            start -= 1
        while start < end < len(text) and text[end - 1].isalnum() and text[end].isalnum():
            end += 1
        if end - start < SHORTEST or any(s < end and e > start for s, e in taken):
            continue
        if out and out[-1][2] > start:
            continue
        out.append((kind, start, end))
    return out


def all_spans(texts: list[str], model: dict | None) -> list[tuple[list, list]]:
    """(base spans, added spans) of each text."""
    base = [base_spans(t) for t in texts]
    known = [[(s, e) for _, s, e in spans] + failed for spans, failed in base]
    added = added_spans(texts, known, model) if model else [[] for _ in texts]
    return [(b[0], a) for b, a in zip(base, added)]


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1])))


def find(docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) of every row.

    Counts and ``base`` are of the patterns; ``spans`` also has what the network adds. Both list ``kind:start:end`` in
    code points, end exclusive, by kind and start. NULL texts count as empty and have none. Repeated rows stay.
    """
    named = in_small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = batch.iloc[at:at + 1024]
                found = all_spans([t or "" for t in part["text"]], model)
                counts = {f"n_{k}": [sum(s[0] == k for s in base) for base, _ in found] for k in KINDS}
                yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), **counts,
                                    "base": [_listed(base) for base, _ in found],
                                    "spans": [_listed(base + added) for base, added in found]})
    kind = named.schema["doc_id"].dataType.simpleString()
    counted = ", ".join(f"n_{k} long" for k in KINDS)
    return named.mapInPandas(rows, f"doc_id {kind}, {counted}, base string, spans string")


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with a mark such as [EMAIL] in place of each span; of overlapping spans one mark, of the first, remains."""
    out, done = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = max(done, end)
    return "".join(out) + text[done:]


def mask(docs: DataFrame, model: dict | None, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The rows of ``docs``, with all their columns, personal data in the text replaced by marks.

    NULL texts stay NULL. A column ``length_col``, if there is one, follows the new text.
    """
    def cleaned(texts: pd.Series) -> pd.Series:
        out: list[str | None] = []
        for at in range(0, len(texts), 1024):
            part = list(texts.iloc[at:at + 1024])
            found = all_spans([t or "" for t in part], model)
            out += [None if t is None else masked(t, base + added) for t, (base, added) in zip(part, found)]
        return pd.Series(out, dtype=object)
    out = in_small_batches(docs).withColumn(text_col, F.pandas_udf(cleaned, "string")(F.col(text_col)))
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out
