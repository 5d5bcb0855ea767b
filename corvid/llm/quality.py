"""Quality: a factorisation machine over hashed words, structure statistics and metadata.

Every feature has a weight and a vector of ``RANK`` numbers; the pairwise part
of a score is half the sum over the vector's places of (sum v x)^2 - sum (v x)^2,
which takes time linear in the features.  The fitted table is bounded by
``SLOTS`` rows whatever the corpus; scoring reads every whole text once and
shuffles nothing.  Metadata are the text's lengths; labels, language, source
and id are never inputs.

The sample is bounded by ``bound`` labelled ids, half of each class, and by the
bytes of their features; the intercept is then moved to the classes' true sizes.

Defined results: an empty or null text is scored from its statistics (all
zero); without labels, or with one class only, every score is that class's
share (0 without labels); null ids are scored and not held out; repeated rows
are scored each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import by_bytes, table
from corvid.llm.hashing import bounded, hashes, held_out, labelled_sample, scored, sigmoid, words

SLOTS = 1 << 16
RANK = 8
PARTS, PART = 4, 2
#: Byte classes: what a statistic counts.
CLASSES = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",", "!", "?", "|", "*&%$#@~^", "-_=+/\\", "()[]{}<>", "\"'`", ":;"]
_CLASS = np.full(256, len(CLASSES), np.uint8)
for _k, _letters in enumerate(CLASSES):
    _CLASS[list(_letters.encode())] = _k
_CLASS[128:] = len(CLASSES) + 1
N_STATS = len(CLASSES) + 2 + 8


def statistics(text: str) -> np.ndarray:
    """Shares of byte classes, then lengths, line and word statistics, all scaled to a few units at most."""
    data = text.encode()
    out = np.zeros(N_STATS, np.float32)
    if not data:
        return out
    codes = _CLASS[np.frombuffer(data, np.uint8)]
    share = np.bincount(codes, minlength=len(CLASSES) + 2) / len(data)
    out[: len(share)] = np.sqrt(share)
    lines = text.split("\n")
    pieces = text.split()
    n = len(pieces)
    caps = sum(map(str.isupper, pieces))
    odd = sum(not p[-1].isalnum() and not p[-1] in ".,;:!?\"')" for p in pieces)
    out[len(share) :] = (
        math.log1p(len(data)) / 8, math.log1p(n) / 8, math.log1p(len(lines)) / 5, len(set(lines)) / len(lines),
        len(set(pieces)) / max(n, 1), min(len(data) / max(n, 1), 40) / 10, caps / max(n, 1), odd / max(n, 1),
    )
    return out


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, slot, value) of the word features, by text, values of unit length in a text; and the statistics, a row a text."""
    index, sizes, distinct = words(texts)
    slot = (hashes(distinct) & np.uint64(SLOTS - 1)).astype(np.int64)
    key, count = np.unique(np.repeat(np.arange(len(sizes)), sizes) * SLOTS + (slot[index] if len(index) else index.astype(np.int64)), return_counts=True)
    text, slot = key // SLOTS, key % SLOTS
    value = np.log1p(count).astype(np.float32)
    norm = np.sqrt(np.bincount(text, value * value, minlength=len(sizes)))
    stats = np.stack([statistics(t) for t in texts.to_pylist()]) if len(texts) else np.zeros((0, N_STATS), np.float32)
    return text, slot, value / norm[text].astype(np.float32), stats


class Model:
    """Weights and vectors of the word slots (first) and the statistics (last)."""

    def __init__(self, bias: float, weights: np.ndarray, vectors: np.ndarray):
        self.bias, self.weights, self.vectors = bias, weights, vectors

    def logits(self, text: np.ndarray, slot: np.ndarray, value: np.ndarray, stats: np.ndarray) -> np.ndarray:
        n = len(stats)
        vs, ws = self.vectors[SLOTS:], self.weights[SLOTS:]
        sums, squares = stats @ vs, (stats * stats) @ (vs * vs)
        linear = self.bias + stats @ ws + np.bincount(text, self.weights[slot] * value, minlength=n)
        for k in range(RANK):
            part = self.vectors[slot, k] * value
            sums[:, k] += np.bincount(text, part, minlength=n)
            squares[:, k] += np.bincount(text, part * part, minlength=n)
        return linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        return sigmoid(self.logits(*features(texts))) if len(texts) else np.empty(0)


def fit(rows: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], sizes: list[int], rate: float = 0.1, l2: float = 1e-4, epochs: int = 8, batch: int = 50, seed: int = 42) -> Model:
    """AdaGrad on the logistic loss, in small batches; rows are (slots, values, statistics, y)."""
    total = sum(sizes)
    order = np.random.default_rng(seed)
    size = SLOTS + N_STATS
    if not rows or min(sizes) == 0:
        share = sizes[1] / total if total else 0.0
        return Model(math.log(share / (1 - share)) if 0 < share < 1 else (35.0 if share else -35.0), np.zeros(size, np.float32), np.zeros((size, RANK), np.float32))
    model = Model(0.0, np.zeros(size, np.float32), order.normal(0, 0.05, (size, RANK)).astype(np.float32))
    gw, gv, gb = np.full(size, 1e-6, np.float32), np.full((size, RANK), 1e-6, np.float32), 1e-6
    y = np.array([r[3] for r in rows], np.float32)
    for _ in range(epochs):
        mixed = order.permutation(len(rows))
        for at in range(0, len(rows), batch):
            mine = [rows[k] for k in mixed[at : at + batch]]
            n = len(mine)
            text = np.concatenate([np.repeat(np.arange(n), [len(r[0]) + N_STATS for r in mine])])
            place = np.concatenate([np.concatenate([r[0], np.arange(SLOTS, size)]) for r in mine])
            value = np.concatenate([np.concatenate([r[1], r[2]]) for r in mine]).astype(np.float32)
            used, where = np.unique(place, return_inverse=True)
            v = model.vectors[used]
            vx = v[where] * value[:, None]
            starts = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            sums = np.add.reduceat(vx, starts, axis=0)
            logit = model.bias + np.add.reduceat(model.weights[place] * value, starts) + 0.5 * (sums * sums - np.add.reduceat(vx * vx, starts, axis=0)).sum(axis=1)
            g = ((sigmoid(logit) - y[mixed[at : at + batch]]) / n).astype(np.float32)
            gx = g[text] * value
            dw = np.bincount(where, gx, minlength=len(used)).astype(np.float32) + l2 * model.weights[used]
            dv = np.stack([np.bincount(where, gx * (sums[text, k] - vx[:, k]), minlength=len(used)) for k in range(RANK)], axis=1).astype(np.float32) + l2 * v
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += float(g.sum()) ** 2
            model.weights[used] -= rate * dw / np.sqrt(gw[used])
            model.vectors[used] -= rate * dv / np.sqrt(gv[used])
            model.bias -= rate * float(g.sum()) / math.sqrt(gb)
    seen = [int((y == c).sum()) for c in (0, 1)]
    model.bias += math.log(sizes[1] / sizes[0]) - math.log(seen[1] / seen[0]) if min(seen) else 0.0
    return model


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches):
        text, slot, value, stats = features(batch.column("text"))
        cuts = np.searchsorted(text, np.arange(1, batch.num_rows))
        kinds = (np.split(slot.astype("<u4"), cuts), np.split(value.astype("<f4"), cuts), list(stats.astype("<f4")))
        yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array([r.tobytes() for r in kind], pa.binary()) for kind in kinds], batch.column("y").cast(pa.int32())], names=["id", "slots", "vals", "stats", "y"])


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", bound: int = 4000, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fitted on at most ``bound`` labelled ids, and ``max_bytes`` of their features."""
    sample, sizes = labelled_sample(docs, labels, label, bound, PARTS, PART, id_col, text_col)
    rows = sample.mapInArrow(_rows, f"id {sample.schema['id'].dataType.simpleString()}, slots binary, vals binary, stats binary, y int")
    got = bounded(rows, ["slots", "vals", "stats"], max_bytes)
    return fit([(np.frombuffer(r["slots"], "<u4").astype(np.int64), np.frombuffer(r["vals"], "<f4"), np.frombuffer(r["stats"], "<f4"), r["y"]) for r in got], sizes)


def _scorer(shared) -> Callable[[pa.Array], np.ndarray]:
    return lambda texts: shared.value.score(texts)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every document."""
    return scored(docs, _scorer(docs.sparkSession.sparkContext.broadcast(model)), id_col, text_col)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), held_out("id", PARTS, PART).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
