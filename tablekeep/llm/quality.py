"""Quality classifier: gated-attention multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE_WORDS`` words. Each passage is
described by hashed byte pairs and by triples of byte classes, and encoded by a
learned dense layer; only documents carry labels. A gated attention network
learns one weight for each passage from those labels, and the score is a
logistic layer over the weighted sum of the encoded passages. Forward and
backward passes are numpy; scoring runs in ``mapInArrow`` over whole texts.

Training uses at most ``max_train`` labelled documents, those with the smallest
hash of their id; everything else covers all rows.

Defined results: null and empty texts are one passage without content, scored
like any other; a null id is never held out and never a training row (its label
cannot be known); repeated rows are scored each; several labels of one id count
as the smallest; without labels of both classes every score is the share of
label 1 (0.5 without any label). Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .common import batches_of, fold, packed, pick, spooled, text_bytes

PASSAGE_WORDS = 128
PAIRS = 512  # hashed byte pairs
CLASSES = 8  # byte classes; their triples are the other features
DIMS = PAIRS + CLASSES**3
HIDDEN = 32
GATE = 16
SLICE_BYTES = 1 << 20
#: Labelled documents used for training at most.
MAX_TRAIN = 3000
#: Labels (two numbers each) that are sent to every executor at most.
BROADCAST_LABELS = 500_000

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _byte_classes() -> np.ndarray:
    kind = np.full(256, 6, np.int64)  # any other sign
    kind[ord("a") : ord("z") + 1] = 0
    kind[128:] = 1
    kind[ord("A") : ord("Z") + 1] = 2
    kind[ord("0") : ord("9") + 1] = 3
    kind[_SPACE] = 4
    kind[10] = 7
    kind[[ord(x) for x in ".,;:'"]] = 5
    return kind


_CLASS = _byte_classes()


def passage_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(features of every passage, number of passages of every text); each text has one at least."""
    raw, offsets = text_bytes(texts)
    n = len(offsets) - 1
    size = len(raw)
    if not size:
        return np.zeros((n, DIMS), np.float32), np.ones(n, np.int64)
    space = _SPACE[raw]
    start = ~space
    start[1:] &= space[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]  # a text's first byte starts a word unless it is white space
    start[first] = ~space[first]
    words = np.concatenate([[0], np.cumsum(start)])
    n_words = words[offsets[1:]] - words[offsets[:-1]]
    n_passages = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    base = np.concatenate([[0], np.cumsum(n_passages)])
    lengths = np.diff(offsets)
    ordinal = words[1:] - np.repeat(words[offsets[:-1]], lengths)
    passage = np.repeat(base[:-1], lengths) + np.maximum(ordinal - 1, 0) // PASSAGE_WORDS
    total = int(base[-1])
    features = np.zeros((total, DIMS), np.float32)
    same = passage[1:] == passage[:-1]
    wide = raw.astype(np.int64)
    pair = ((wide[:-1] * 256 + wide[1:]) * 40503 >> 7) % PAIRS
    kind = _CLASS[raw]
    at = passage[1:][same] * PAIRS + pair[same]
    features[:, :PAIRS] = np.bincount(at, minlength=total * PAIRS).reshape(total, PAIRS)
    if size > 2:
        same3 = passage[2:] == passage[:-2]
        triple = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
        at = passage[2:][same3] * CLASSES**3 + triple[same3]
        features[:, PAIRS:] = np.bincount(at, minlength=total * CLASSES**3).reshape(total, CLASSES**3)
    np.log1p(features, out=features)
    for part in (features[:, :PAIRS], features[:, PAIRS:]):
        part /= np.sqrt((part * part).sum(1, keepdims=True)) + 1e-6
    return features, n_passages


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class AttentionModel:
    """Parameters by name; ``prior`` is the score where nothing could be learned."""

    p: dict[str, np.ndarray]
    prior: float = 0.5

    def encode(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(x @ self.p["W"] + self.p["b"])

    def bags(self, h: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        """Attention and score of each bag; ``counts`` rows of ``h`` belong to each."""
        starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
        t, g = np.tanh(h @ self.p["V"]), _sigmoid(h @ self.p["U"])
        logit = (t * g) @ self.p["a"]
        e = np.exp(logit - np.repeat(np.maximum.reduceat(logit, starts), counts))
        weight = e / np.repeat(np.add.reduceat(e, starts), counts)
        z = np.add.reduceat(h * weight[:, None], starts)
        return {"t": t, "g": g, "weight": weight, "z": z, "score": _sigmoid(z @ self.p["c"] + self.p["d"])}

    def score(self, texts: pa.Array) -> np.ndarray:
        if not self.p:
            return np.full(len(texts), self.prior)
        out = []
        for lo, hi in batches_of(texts, SLICE_BYTES):
            x, counts = passage_features(texts.slice(lo, hi - lo))
            out.append(self.bags(self.encode(x), counts)["score"])
        return np.concatenate(out).astype(np.float64) if out else np.zeros(0)


def fit(features: list[np.ndarray], labels: np.ndarray, *, epochs: int = 14, batch: int = 32, seed: int = 5) -> AttentionModel:
    """Adam on the log loss of the bags (``features``: one array of passages for each document)."""
    labels = np.asarray(labels, np.float32)
    if len(labels) == 0 or labels.min() == labels.max():
        return AttentionModel({}, float(labels.mean()) if len(labels) else 0.5)
    rng = np.random.default_rng(seed)
    scale = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    p = {"W": scale(DIMS, HIDDEN) * 2, "b": np.zeros(HIDDEN, np.float32), "V": scale(HIDDEN, GATE), "U": scale(HIDDEN, GATE), "a": scale(GATE), "c": scale(HIDDEN), "d": np.zeros(1, np.float32)}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    model, step = AttentionModel(p), 0
    for epoch in range(epochs):
        order = rng.permutation(len(labels))
        rate = 0.004 * (1 - epoch / epochs) + 0.0004
        for lo in range(0, len(order), batch):
            chosen = order[lo : lo + batch]
            x = np.concatenate([features[i] for i in chosen]).astype(np.float32)
            counts = np.array([len(features[i]) for i in chosen])
            h = model.encode(x)
            r = model.bags(h, counts)
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            d_logit = (r["score"] - labels[chosen]) / len(chosen)
            grad = {"c": r["z"].T @ d_logit, "d": d_logit.sum(keepdims=True)}
            dz = np.repeat(d_logit[:, None] * p["c"][None], counts, 0)
            dw = (dz * h).sum(1)
            mean = np.add.reduceat(dw * r["weight"], starts)
            d_att = r["weight"] * (dw - np.repeat(mean, counts))
            gated = r["t"] * r["g"]
            grad["a"] = gated.T @ d_att
            d_gated = d_att[:, None] * p["a"][None]
            dt, dg = d_gated * r["g"] * (1 - r["t"] ** 2), d_gated * gated * (1 - r["g"])
            grad["V"], grad["U"] = h.T @ dt, h.T @ dg
            dh = (dz * r["weight"][:, None] + dt @ p["V"].T + dg @ p["U"].T) * (1 - h * h)
            grad["W"], grad["b"] = x.T @ dh + 1e-4 * p["W"], dh.sum(0)
            step += 1
            for k, g in grad.items():
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def training_rows(docs: DataFrame, labels: DataFrame, label: str, *, parts: int, held: int, max_train: int | None, extra: dict[str, str] | None = None) -> DataFrame:
    """(doc_id, text, y) of the labelled documents outside the held-out fold; of at most ``max_train``, unless it is None."""
    y = pick(labels, doc_id="doc_id", y=label).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    y = y.filter(fold("doc_id", parts) != held).groupBy("doc_id").agg(F.min("y").alias("y"))
    docs = pick(docs, doc_id="doc_id", text="text", **(extra or {}))
    if max_train is None:  # never the texts: a broadcast of few labels, or a hash table of a part of them beside each part of the texts
        few = y.count() <= BROADCAST_LABELS
        return docs.join(y.hint("broadcast" if few else "shuffle_hash"), "doc_id")
    chosen = y.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    # at most max_train rows of two numbers
    return docs.join(F.broadcast(chosen), "doc_id")


def train_quality(docs: DataFrame, labels: DataFrame, *, max_train: int = MAX_TRAIN) -> AttentionModel:
    """Features of the training documents are made on the executors (2 KB a passage); the driver gets
    at most ``max_train`` arrays of whole texts, part by part into a file, and fits the model."""

    def describe(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            text = frame.column("text")
            blobs = []
            for lo, hi in batches_of(text, SLICE_BYTES):
                x, counts = passage_features(text.slice(lo, hi - lo))
                blobs += [part.astype(np.float16).tobytes() for part in np.split(x, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), frame.column("y").cast(pa.int32()), pa.array(blobs, pa.binary())], ["doc_id", "y", "x"])

    rows = training_rows(docs, labels, "quality", parts=3, held=1, max_train=max_train)
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.col("y").cast("int"))
    got = spooled(docs.sparkSession, rows.mapInArrow(describe, "doc_id long, y int, x binary"), "quality-train")
    features = [np.frombuffer(x, np.float16).reshape(-1, DIMS) for x in got["x"]]
    return fit(features, got["y"].to_numpy())


def score_quality(docs: DataFrame, model: AttentionModel, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, score) of every document."""

    def score(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(model.score(frame.column("text")), pa.float64())], ["doc_id", "score"])

    rows = pick(docs, doc_id=id_column, text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, score double")


def keep_quality(docs: DataFrame, model: AttentionModel, threshold: float = 0.5) -> DataFrame:
    """The documents (all columns) that score at least ``threshold``."""
    flat, names = packed(docs)
    text = f"c{names.index('text')}"

    def mark(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            keep = pa.array(model.score(frame.column(text)) >= threshold, pa.bool_())
            yield frame.filter(keep)

    return flat.mapInArrow(mark, StructType([StructField(f.name, f.dataType, True) for f in flat.schema.fields])).toDF(*names)
