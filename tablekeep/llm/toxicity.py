"""Toxicity classifier: a convolutional network over hashed words.

Words are runs of letters and digits (A-Z lower-cased, every byte from 0x80 up
counts as a letter). A word's embedding is the sum of three hashed rows: the
whole word, its first four bytes and its first six, so that unseen endings of a
known stem keep its meaning. Filters of widths 1, 2 and 3 slide over a text's
words, each filter keeps its largest response, and a logistic layer scores
these maxima. The network is trained in numpy with Adam; gradients flow through
the positions that won the pooling.

Rows seen in fewer than ``MIN_DOCS`` training documents share one row, so a
word of a single document cannot explain its label. The first embedding number
of the others starts at the shrunken log odds of the row between the classes.

A part of the training rows is set aside for calibration: a logistic fit puts
the best threshold of all languages at 0.5, and each language gets its own
threshold on that scale (``threshold``, ``flagged``). The language is never an
input of a score, and ``predicted`` is the score against 0.5.

Training uses every labelled document outside the held-out fold. Up to
``LOCAL_DOCS`` documents train on the driver. More are dealt over groups by the
hash of their id, with the epochs, batches and rates of the others: the counts
of the rows are a Spark aggregate, and the epochs are dealt over ``ROUNDS``. In
each round every group trains from the same network on the executors, through
all its documents once an epoch, after which the networks are averaged (each
row of the table over the groups that hold it, weighted by documents). The
thresholds come from counts of all calibration documents by language and logit,
to 1/``CELLS``. Scoring covers whole texts of all rows.

Defined results: null and empty texts have no word and get the score of an
empty text; a null id is never held out nor a training row; repeated rows are
scored each; several labels of one id count as the smallest; without labels of
both classes every score is the share of label 1 (0 without any label). A null
or unseen language takes threshold 0.5. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, pick, spooled, text_bytes, written
from .quality import training_rows

BITS = 18  # buckets of the hash, as a power of two; in the table row 0 pads and row 1 is every rare bucket
WIDTH = 8
FILTERS = 8
SPANS = (1, 2, 3)
PAD = max(SPANS) - 1
MIN_DOCS = 5
#: Bytes of a word that make each of its rows.
PARTS = (None, 4, 6)
SLICE_BYTES = 1 << 19
#: Times that the network sees each training document, and documents of a step.
EPOCHS = 10
BATCH = 64
#: Rows of the table that a step moves at a time.
STEP_ROWS = 8192
#: Labelled documents, and bytes of their texts, that train on the driver.
LOCAL_DOCS = 5000
LOCAL_BYTES = 1 << 25
#: About the documents and the bytes of a group of a larger training set.
GROUP_DOCS = 10_000
GROUP_BYTES = 24 << 20
#: Times that the networks of the groups are averaged; the epochs are dealt over them.
ROUNDS = 4
#: Rows of the table that are averaged together.
BLOCK = 1024
#: Cells of one unit of the logit in which calibration documents are counted.
CELLS = 256
#: Words at a time in a step and in calibration.
SLICE_WORDS = 1 << 16

#: (width, place) of every block of filters in a product with the table; the first places come first.
_TAPS = sorted(((k, j) for k in SPANS for j in range(k)), key=lambda x: x[1])

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_WORD = np.zeros(256, bool)
_WORD[ord("0") : ord("9") + 1] = _WORD[ord("a") : ord("z") + 1] = _WORD[128:] = True
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(32, 0x9E3779B97F4A7C15, np.uint64))


def word_ids(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """((words, 3) rows of every word, number of words of every text)."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    if not len(raw):
        return np.zeros((0, len(PARTS)), np.int64), np.zeros(n, np.int64)
    low = _LOWER[raw]
    inside = _WORD[low]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[first] = inside[first]
    at = np.flatnonzero(start)
    counts = np.searchsorted(at, offsets[1:]) - np.searchsorted(at, offsets[:-1])
    if not len(at):
        return np.zeros((0, len(PARTS)), np.int64), counts
    where = np.flatnonzero(inside)
    begin = np.searchsorted(where, at)
    place = np.arange(len(where)) - np.repeat(begin, np.diff(np.append(begin, len(where))))
    ids = np.empty((len(at), len(PARTS)), np.int64)
    with np.errstate(over="ignore"):
        value = (low[where].astype(np.uint64) + np.uint64(1)) * _POWERS[place & 31]
        for i, part in enumerate(PARTS):
            key = np.add.reduceat(value if part is None else np.where(place < part, value, 0), begin)
            ids[:, i] = (key + np.uint64(i)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(64 - BITS)
    return ids, counts


def padded(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts with ``PAD`` empty rows after each (one word at least); the texts' starts."""
    starts = np.concatenate([[0], np.cumsum(np.maximum(counts, 1) + PAD)])
    out = np.zeros((starts[-1], len(PARTS)), np.int64)
    if len(ids):
        out[np.repeat(starts[:-1] - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
    return out, starts


def largest(y: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The maximum over the positions of each text's words, without the padding after them."""
    bounds = np.stack([starts[:-1], starts[1:] - PAD], 1).ravel()
    return np.maximum.reduceat(y, bounds, axis=0)[::2]


def responses(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Sum of the rows of each word."""
    out = table.take(ids[:, 0], 0)
    for i in range(1, ids.shape[1]):
        out += table.take(ids[:, i], 0)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class ConvModel:
    p: dict[str, np.ndarray]
    prior: float = 0.0
    scale: tuple[float, float] = (1.0, 0.0)  # calibration of the logit
    thresholds: dict[str, float] = field(default_factory=dict)

    def tables(self) -> dict[tuple[int, int], np.ndarray]:
        """Response of each filter to each row at each place, so that a convolution is a sum of look-ups."""
        return {(k, j): self.p["E"] @ self.p[f"W{k}"][j] for k in SPANS for j in range(k)}

    def pooled(self, ids: np.ndarray, starts: np.ndarray, tables: dict) -> np.ndarray:
        """(texts, filters) largest responses of the windows that start at a word; past the last word they see padding."""
        parts = []
        for k in SPANS:
            y = responses(tables[k, 0], ids)
            for j in range(1, k):
                y[:-j] += responses(tables[k, j], ids[j:])
            parts.append(largest(y, starts) + self.p[f"b{k}"])
        return np.maximum(np.concatenate(parts, 1), 0)

    def logits(self, ids: np.ndarray, counts: np.ndarray, tables: dict) -> np.ndarray:
        words, starts = padded(self.p["known"][ids], counts)
        return self.pooled(words, starts, tables) @ self.p["c"] + self.p["d"]

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.p:
            return np.full(len(texts), self.prior)
        tables, out = self.tables(), []
        for lo, hi in batches_of(texts, SLICE_BYTES):
            logit = self.logits(*word_ids(texts.slice(lo, hi - lo)), tables)
            out.append(_sigmoid(self.scale[0] * logit + self.scale[1]))
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def initial(seen: np.ndarray, n_positive: int, n_negative: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """Parameters before training; ``seen``: documents of either class by bucket."""
    frequent = np.flatnonzero(seen.sum(0) >= MIN_DOCS)
    known = np.ones(seen.shape[1], np.int64)
    known[frequent] = np.arange(2, len(frequent) + 2)
    odds = np.log((seen[1] + 0.5) / (n_positive + 1)) - np.log((seen[0] + 0.5) / (n_negative + 1))
    odds *= seen.sum(0) / (seen.sum(0) + 10) / len(PARTS)
    p = {"E": (rng.standard_normal((len(frequent) + 2, WIDTH)) * 0.05).astype(np.float32), "known": known}
    p["E"][2:, 0] = odds[frequent]
    p["E"][0], p["E"][1, 0] = 0, 0
    for k in SPANS:
        p[f"W{k}"] = (rng.standard_normal((k, WIDTH, FILTERS)) * 0.2).astype(np.float32)
        p[f"W{k}"][:, 0, : FILTERS // 2] = 0.5
        p[f"b{k}"] = np.zeros(FILTERS, np.float32)
    p["c"] = (rng.standard_normal(FILTERS * len(SPANS)) * 0.1).astype(np.float32)
    for i in range(len(SPANS)):
        p["c"][i * FILTERS : i * FILTERS + FILTERS // 2] = 0.3
    p["d"] = np.full(1, -2.0, np.float32)
    return p


def positive_weight(n_positive: int, n_negative: int) -> float:
    return min(4.0, n_negative / n_positive)


def epoch_rate(epoch: int, epochs: int) -> float:
    return 0.01 * (1 - epoch / epochs) + 0.001


class Adam:
    """Moments of every parameter."""

    def __init__(self, p: dict[str, np.ndarray]):
        self.m, self.v = ({k: np.zeros_like(x) for k, x in p.items() if k != "known"} for _ in range(2))
        self.step = 0

    def move(self, p: dict[str, np.ndarray], key: str, g: np.ndarray, rate: float, part: slice = slice(None)) -> None:
        """Moves a parameter, or these rows of it, in place."""
        x, m, v = p[key][part], self.m[key][part], self.v[key][part]
        m *= 0.9
        m += 0.1 * g
        square = 0.01 * g
        square *= g
        v *= 0.99
        v += square
        root = np.divide(v, 1 - 0.99**self.step, out=square)
        np.sqrt(root, out=root)
        root += 1e-6
        step = m / (1 - 0.9**self.step)
        step *= rate
        step /= root
        x -= step


def firsts(product: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts, filters) first positions that reach the largest response, and these responses; ``product``: the rows of
    the table times the filters of ``_TAPS``."""
    filters = np.arange(FILTERS * len(SPANS))
    at = np.zeros((len(starts) - 1, len(filters)), np.int64)
    best = np.full(at.shape, -np.inf, product.dtype)
    for lo in range(0, len(ids), SLICE_WORDS):
        hi = lo + SLICE_WORDS
        near = ids[lo : hi + PAD]
        y = responses(product, near)
        for i, (k, j) in enumerate(_TAPS):
            if j:
                to = SPANS.index(k) * FILTERS
                y[:-j, to : to + FILTERS] += y[j:, i * FILTERS : (i + 1) * FILTERS]
        for text in range(np.searchsorted(starts[1:], lo, "right"), np.searchsorted(starts[:-1], hi)):
            begin, end = max(starts[text], lo), min(starts[text + 1] - PAD, hi)
            if begin < end:
                top = y[begin - lo : end - lo, : len(filters)].argmax(0) + begin
                value = y[top - lo, filters]
                higher = value > best[text]
                at[text, higher], best[text, higher] = top[higher], value[higher]
    return at, best


def descend(p: dict[str, np.ndarray], opt: Adam, rows: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, rng: np.random.Generator, *, rate: float, batch: int) -> None:
    """One epoch over the documents (``rows``: their rows of the table); ``p`` gets new arrays. A step multiplies just
    the rows of its documents with the filters, and moves all rows."""
    p |= {k: x.copy() for k, x in p.items() if k != "known"}
    order, place = rng.permutation(len(labels)), np.zeros(len(p["E"]), np.int64)
    for lo in range(0, len(order), batch):
        chosen = order[lo : lo + batch]
        counts = np.array([len(rows[i]) for i in chosen])
        ids, starts = padded(np.concatenate([rows[i] for i in chosen]) if counts.sum() else np.zeros((0, len(PARTS)), np.int64), counts)
        used = np.zeros(len(place), bool)
        used[ids] = True
        used = np.flatnonzero(used)
        place[used] = np.arange(len(used))
        ids, own = place[ids], p["E"][used]
        at, best = firsts(own @ np.concatenate([p[f"W{k}"][j] for k, j in _TAPS], 1), ids, starts)
        z = best + np.concatenate([p[f"b{k}"] for k in SPANS])
        pooled = np.maximum(z, 0)
        d_logit = weight[chosen] * (_sigmoid(pooled @ p["c"] + p["d"]) - labels[chosen]) / len(chosen)
        grad = {"c": pooled.T @ d_logit + 1e-4 * p["c"], "d": d_logit.sum(keepdims=True)}
        dz = d_logit[:, None] * p["c"][None] * (z > 0)
        grad_own = np.zeros(own.size, np.float32)
        for i, k in enumerate(SPANS):
            part, winners = dz[:, i * FILTERS : (i + 1) * FILTERS], at[:, i * FILTERS : (i + 1) * FILTERS]
            grad[f"b{k}"], grad[f"W{k}"] = part.sum(0), np.zeros_like(p[f"W{k}"])
            for j in range(k):
                word = ids[np.minimum(winners + j, len(ids) - 1)]  # (texts, filters, parts)
                grad[f"W{k}"][j] = np.einsum("nf,nfw->wf", part, own[word].sum(2))
                slope = np.repeat((part[:, :, None] * p[f"W{k}"][j].T[None])[:, :, None], len(PARTS), 2)
                np.add.at(grad_own, (word[..., None] * WIDTH + np.arange(WIDTH)).ravel(), slope.ravel())
        grad_own = grad_own.reshape(own.shape)
        opt.step += 1
        for key, g in grad.items():
            opt.move(p, key, g, rate)
        for lo_row in range(0, len(p["E"]), STEP_ROWS):
            part = slice(lo_row, lo_row + STEP_ROWS)
            mine = slice(*np.searchsorted(used, [part.start, part.stop]))
            g = 2e-5 * p["E"][part]
            g[used[mine] - lo_row] += grad_own[mine]
            if lo_row == 0:
                g[0] = 0
            opt.move(p, "E", g, rate, part)


def fit(bags: list[np.ndarray], labels: np.ndarray, *, epochs: int = EPOCHS, batch: int = BATCH, seed: int = 11) -> ConvModel:
    """``bags``: the word rows of each document."""
    labels = np.asarray(labels, np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return ConvModel({}, float(labels.mean()) if len(labels) else 0.0)
    rng = np.random.default_rng(seed)
    positive = labels == 1
    seen = np.zeros((2, 1 << BITS))
    for ids, y in zip(bags, positive):
        seen[int(y), np.unique(ids)] += 1
    model = ConvModel(initial(seen, positive.sum(), (~positive).sum(), rng))
    weight = np.where(positive, positive_weight(positive.sum(), (~positive).sum()), 1.0).astype(np.float32)
    opt, rows = Adam(model.p), [model.p["known"][ids] for ids in bags]
    for epoch in range(epochs):
        descend(model.p, opt, rows, labels, weight, rng, rate=epoch_rate(epoch, epochs), batch=batch)
    return model


def best_threshold(score: np.ndarray, positive: np.ndarray, total: np.ndarray) -> float:
    """The middle between neighbouring scores that gives the best F1; ``positive`` of ``total`` documents have each."""
    cut, cell = np.unique(score, return_inverse=True)
    hits, flagged = (np.bincount(cell, n)[::-1].cumsum()[::-1] for n in (positive, total))
    f1 = 2 * hits / np.maximum(1, flagged + hits[0])
    cut = np.concatenate([[cut[0]], (cut[1:] + cut[:-1]) / 2])
    good = np.flatnonzero(f1 >= f1.max() - 1e-12)
    return float(cut[good[len(good) // 2]])


def set_thresholds(model: ConvModel, logit: np.ndarray, spread: float, positive: np.ndarray, total: np.ndarray, langs: list[str | None], least: int = 20) -> ConvModel:
    """Logit shift that puts the best threshold of all rows at 0.5; then a threshold for each
    language with at least ``least`` rows of both classes together and five positive ones."""
    cut = best_threshold(logit, positive, total)
    steep = 1.0 if spread < 10 else 10 / spread
    model.scale = (steep, -steep * cut)
    score = _sigmoid(steep * (logit - cut))
    names = np.array([x if x is not None else "" for x in langs], object)
    for name in sorted(set(names)):
        own = names == name
        if name and total[own].sum() >= least and 5 <= positive[own].sum() < total[own].sum():
            model.thresholds[str(name)] = best_threshold(score[own], positive[own], total[own])
    return model


def calibrate(model: ConvModel, bags: list[np.ndarray], labels: np.ndarray, langs: list[str | None], *, least: int = 20) -> ConvModel:
    """``set_thresholds`` from these documents."""
    if not model.p or not len(labels) or labels.min() == labels.max():
        return model
    counts = np.array([len(x) for x in bags])
    logit = model.logits(np.concatenate(bags).astype(np.int64), counts, model.tables())
    return set_thresholds(model, logit, max(1e-3, float(logit.std())), (labels == 1).astype(np.int64), np.ones(len(labels), np.int64), langs, least)


def documents(frame: pa.RecordBatch) -> tuple[list[np.ndarray], np.ndarray]:
    """Word rows and labels of described documents."""
    return [np.frombuffer(x, np.uint32).reshape(-1, len(PARTS)) for x in frame.column("x").to_pylist()], frame.column("y").to_numpy()


def count_rows(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either class by bucket: (bucket, negative, positive)."""
    seen = np.zeros((2, 1 << BITS), np.int64)
    for frame in frames:
        for ids, y in zip(*documents(frame)):
            seen[int(y == 1), np.unique(ids)] += 1
    at = np.flatnonzero(seen.any(0))
    yield pa.RecordBatch.from_arrays([pa.array(at), *[pa.array(x[at]) for x in seen]], ["bucket", "negative", "positive"])


def groups_of(frames: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """The documents of each group, of which a file holds all rows one after the other."""
    at, bags, labels = None, [], []
    for frame in frames:
        group = frame.column("g").to_numpy()
        own, y = documents(frame)
        cuts = np.flatnonzero(np.diff(group, prepend=-1))
        for lo, hi in zip(cuts, [*cuts[1:], len(group)]):
            if bags and group[lo] != at:
                yield at, bags, np.array(labels)
                bags, labels = [], []
            at = int(group[lo])
            bags += own[lo:hi]
            labels += y[lo:hi].tolist()
    if bags:
        yield at, bags, np.array(labels)


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    """All parameters but the table, one after the other."""
    return np.concatenate([p[k].ravel() for k in sorted(p) if k not in ("E", "known")])


def trained_parts(model: ConvModel, weight: float, *, rates: list[float], batch: int, seed: tuple[int, ...]):
    """Trains every group of a task from ``model``, for an epoch at each rate, with the rows of the table that it holds;
    gives for each block of the table (block, group, documents, rows in the block, their steps in half precision), and the other
    parameters as block -1."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group, bags, labels in groups_of(frames):
            held = np.zeros(len(model.p["E"]), bool)
            held[:2] = True
            for ids in bags:
                held[model.p["known"][ids]] = True
            place, held = (np.cumsum(held, dtype=np.int32) - 1)[model.p["known"]], np.flatnonzero(held)
            rows, labels = [place[ids] for ids in bags], labels.astype(np.float32)
            p = model.p | {"E": model.p["E"][held]}
            opt, rng, weights = Adam(p), np.random.default_rng((*seed, group)), np.where(labels == 1, weight, 1.0).astype(np.float32)
            for rate in rates:
                descend(p, opt, rows, labels, weights, rng, rate=rate, batch=batch)
            steps = (p["E"] - model.p["E"][held]).astype(np.float16)
            cuts = np.searchsorted(held, np.arange(0, len(model.p["E"]) + BLOCK, BLOCK))
            out = [dict(block=-1, g=group, n=len(rows), at=b"", x=flat(p).tobytes())]
            for i, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                if hi > lo:
                    out.append(dict(block=i, g=group, n=len(rows), at=(held[lo:hi] - i * BLOCK).astype(np.uint16).tobytes(), x=steps[lo:hi].tobytes()))
            yield pa.RecordBatch.from_pylist(out, pa.schema([("block", pa.int32()), ("g", pa.int32()), ("n", pa.int64()), ("at", pa.binary()), ("x", pa.binary())]))

    return run


def mean_block(parts: pa.Table) -> pa.Table:
    """One block averaged over the groups, by their documents: (block, documents, rows in the block, their steps)."""
    parts, block = parts.sort_by("g"), parts.column("block")[0].as_py()
    width = 1 if block < 0 else WIDTH
    size = max(len(x) for x in parts.column("x").to_pylist()) // 4 if block < 0 else BLOCK
    total, weight = np.zeros((size, width)), np.zeros(size)
    for n, at, x in zip(*(parts.column(c).to_pylist() for c in ("n", "at", "x"))):
        at = np.arange(size) if block < 0 else np.frombuffer(at, np.uint16)
        total[at] += n * np.frombuffer(x, np.float32 if block < 0 else np.float16).reshape(-1, width).astype(np.float64)
        weight[at] += n
    at = np.flatnonzero(weight)
    mean = (total[at] / weight[at, None]).astype(np.float32)
    return pa.table({"block": pa.array([block], pa.int32()), "n": pa.array([int(weight.max())], pa.int64()), "at": pa.array([at.astype(np.uint16).tobytes()], pa.binary()), "x": pa.array([mean.tobytes()], pa.binary())})


def averaged(p: dict[str, np.ndarray], blocks: list) -> dict[str, np.ndarray]:
    """The network of the averaged blocks; rows that no group holds stay."""
    p = p | {"E": p["E"].copy()}
    for block, _, at, x in blocks:
        x = np.frombuffer(x, np.float32)
        if block >= 0:
            p["E"][block * BLOCK + np.frombuffer(at, np.uint16).astype(np.int64)] += x.reshape(-1, WIDTH)
            continue
        start = 0
        for k in sorted(p):
            if k not in ("E", "known"):
                p[k] = x[start : start + p[k].size].reshape(p[k].shape)
                start += p[k].size
    return p


def cell_counts(model: ConvModel):
    """Calibration documents by language and cell of their logit: (lang, cell, positive, total)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.tables()
        for frame in frames:
            bags, y = documents(frame)
            counts = np.array([len(b) for b in bags], np.int64)
            cuts = [0, *np.flatnonzero(np.diff(np.cumsum(counts) // SLICE_WORDS)) + 1, len(bags)]
            logit = [np.zeros(0)]
            for lo, hi in zip(cuts, cuts[1:]):
                if hi > lo:
                    logit.append(model.logits(np.concatenate(bags[lo:hi]).astype(np.int64), counts[lo:hi], tables))
            cell = np.rint(np.concatenate(logit) * CELLS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([frame.column("lang"), pa.array(cell), pa.array((y == 1).astype(np.int64))], ["lang", "cell", "positive"])

    return run


def train_in_groups(rows: DataFrame, groups: int, *, calibration: int = 5, epochs: int = EPOCHS, batch: int = BATCH, seed: int = 11) -> ConvModel:
    """The network of any number of documents (doc_id, text, lang, y); the driver gets counts by bucket, by cell and by
    language, and in each round one network."""
    spark = rows.sparkSession

    def describe(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["g", "later", "y", "lang"]
        for frame in frames:
            yield pa.RecordBatch.from_arrays([*[frame.column(n) for n in names], pa.array(word_blobs(frame.column("text")), pa.binary())], [*names, "x"])

    dealt = rows.withColumns({
        "g": F.pmod(F.xxhash64("doc_id"), F.lit(groups)).cast("int"),
        "later": F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(calibration)) == calibration - 1,
    })
    dealt = dealt.repartitionById(groups, "g").sortWithinPartitions("g", "doc_id", "y", F.xxhash64("text"))
    saved = written(spark, dealt.mapInArrow(describe, "g int, later boolean, y int, lang string, x binary"), "toxicity-groups")
    totals = {r.later: r for r in saved.groupBy("later").agg(F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") != 1).alias("neg"), F.sum("y").alias("y")).collect()}
    apart = all(later in totals for later in (True, False)) and totals[False].pos > 0 and totals[True].pos >= 5
    train = saved.filter("NOT later") if apart else saved
    used = [totals[False]] if apart else list(totals.values())
    n_pos, n_neg = sum(r.pos for r in used), sum(r.neg for r in used)
    if not n_pos or not n_neg:
        return ConvModel({}, sum(r.y for r in used) / (n_pos + n_neg) if used else 0.0)
    seen = np.zeros((2, 1 << BITS))
    buckets = train.mapInArrow(count_rows, "bucket long, negative long, positive long").groupBy("bucket").agg(F.sum("negative").alias("n"), F.sum("positive").alias("p")).toArrow()
    seen[:, buckets.column("bucket").to_numpy()] = [buckets.column("n").to_numpy(), buckets.column("p").to_numpy()]
    model = ConvModel(initial(seen, n_pos, n_neg, np.random.default_rng(seed)))
    for turn, own in enumerate(np.array_split(np.arange(epochs), ROUNDS)):
        one = trained_parts(model, positive_weight(n_pos, n_neg), rates=[epoch_rate(e, epochs) for e in own.tolist()], batch=batch, seed=(seed, turn))
        parts = train.mapInArrow(one, "block int, g int, n long, at binary, x binary")
        blocks = parts.groupBy("block").applyInArrow(mean_block, "block int, n long, at binary, x binary")
        model = ConvModel(averaged(model.p, blocks.collect()))
    if not apart or not totals[True].neg:
        return model
    counted = saved.filter("later").mapInArrow(cell_counts(model), "lang string, cell long, positive long")
    cells = counted.groupBy("lang", "cell").agg(F.sum("positive").alias("positive"), F.count(F.lit(1)).alias("total")).toArrow()
    logit, positive, total = cells.column("cell").to_numpy() / CELLS, cells.column("positive").to_numpy(), cells.column("total").to_numpy()
    mean = np.average(logit, weights=total)
    spread = max(1e-3, float(np.sqrt(np.average((logit - mean) ** 2, weights=total))))
    return set_thresholds(model, logit, spread, positive, total, cells.column("lang").to_pylist())


def word_blobs(texts: pa.Array) -> list[bytes]:
    """The word rows of every text."""
    blobs = []
    for lo, hi in batches_of(texts, SLICE_BYTES):
        ids, counts = word_ids(texts.slice(lo, hi - lo))
        blobs += [part.astype(np.uint32).tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]
    return blobs


def train_toxicity(docs: DataFrame, labels: DataFrame, *, calibration: int = 5) -> ConvModel:
    """All labelled documents outside the held-out fold train. Where they are few, their word rows are made on the
    executors and come to the driver part by part, into a file; every ``calibration``-th document (in id order)
    calibrates, the others train. More go to ``train_in_groups``, which sets as large a share aside by the id's hash."""

    def describe(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), frame.column("y"), frame.column("lang"), pa.array(word_blobs(frame.column("text")), pa.binary())], ["doc_id", "y", "lang", "x"])

    rows = training_rows(docs, labels, "toxic", parts=5, held=0, max_train=None, extra={"lang": "lang"})
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string"), F.col("y").cast("int"))
    size = rows.agg(F.count(F.lit(1)).alias("docs"), F.sum(F.octet_length("text").cast("long")).alias("bytes")).first()
    if size.docs > LOCAL_DOCS or (size.bytes or 0) > LOCAL_BYTES:
        return train_in_groups(rows, max(2, -(-size.docs // GROUP_DOCS), -(-(size.bytes or 0) // GROUP_BYTES)), calibration=calibration)
    got = spooled(docs.sparkSession, rows.mapInArrow(describe, "doc_id long, y int, lang string, x binary"), "toxicity-train")
    bags, y, langs = [np.frombuffer(x, np.uint32).reshape(-1, len(PARTS)) for x in got["x"]], got["y"].to_numpy(), list(got["lang"])
    later = np.arange(len(y)) % calibration == calibration - 1
    if (y[~later] == 1).sum() == 0 or (y[later] == 1).sum() < 5:  # too few to set any aside
        later[:] = False
    model = fit([bags[i] for i in np.flatnonzero(~later)], y[~later])
    pick_rows = np.flatnonzero(later)
    return calibrate(model, [bags[i] for i in pick_rows], y[later], [langs[i] for i in pick_rows])


def score_toxicity(docs: DataFrame, model: ConvModel) -> DataFrame:
    """(doc_id, lang, score) of every document."""

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), frame.column("lang"), pa.array(model.score(frame.column("text")), pa.float64())], ["doc_id", "lang", "score"])

    rows = pick(docs, doc_id="doc_id", lang="lang", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, lang string, score double")


def flag_toxicity(scored: DataFrame, model: ConvModel) -> DataFrame:
    """Adds the language's ``threshold`` and ``flagged`` (score at or above it)."""
    threshold = F.lit(0.5)
    for lang, value in model.thresholds.items():  # one for each language seen in training
        threshold = F.when(F.col("lang") == lang, F.lit(value)).otherwise(threshold)
    return scored.withColumn("threshold", threshold).withColumn("flagged", F.col("score") >= F.col("threshold"))
