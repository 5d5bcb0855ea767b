"""Toxicity: logistic regression by FTRL-proximal over hashed word n-grams and skip-grams.

A text's features are its distinct words, word prefixes, pairs of neighbours
and pairs one word apart, hashed to ``SLOTS`` places.  Per-coordinate learning
rates and L1 sparsity leave few weights, which go to the executors as two small
arrays (at most SLOTS entries whatever the corpus).  Scoring reads every whole
text once and shuffles nothing.

The sample is bounded by ``bound`` labelled ids, half of each class, and by the
bytes of their features, so a score of one half weighs a missed toxic text like
a clean one that is rejected.

Defined results: a null or empty text gets the intercept's score; without
labels, or with one class only, every score is that class's share (0 without
labels); null ids are scored and not held out; repeated rows are scored each;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvid.llm.common import by_bytes, fresh, table, trim
from corvid.llm.hashing import SLICE, bounded, hashes, held_out, labelled_sample, scored, sigmoid, with_scores, words

SLOTS = 1 << 20
PREFIX = 4
PARTS, PART = 5, 0


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, slot) of every feature of every text, with repeats."""
    index, sizes, distinct = words(texts)
    text = np.repeat(np.arange(len(sizes)), sizes)
    some = np.fromiter(map(bool, distinct), bool, len(distinct))[index] if len(index) else np.zeros(0, bool)
    index, text = index[some], text[some]
    one, head = hashes(distinct), hashes([w[:PREFIX] for w in distinct], "\0")
    mask = np.uint64(SLOTS - 1)
    word = one[index]
    out = [(text, word & mask), (text, head[index] & mask)]
    for gap, by in ((1, 0x9E3779B97F4A7C15), (2, 0xC2B2AE3D27D4EB4F)):
        if len(word) > gap:
            same = text[gap:] == text[:-gap]
            pair = (word[:-gap] * np.uint64(by)) ^ (word[gap:] >> np.uint64(7)) ^ word[gap:]
            out.append((text[gap:][same], ((pair >> np.uint64(20)) & mask)[same]))
    return np.concatenate([t for t, _ in out]), np.concatenate([s for _, s in out]).astype(np.int64)


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_bytes(batches, most=SLICE):
        text, slot = features(batch.column("text"))
        key = np.unique(text * SLOTS + slot)
        rows = np.split((key % SLOTS).astype("<u4"), np.searchsorted(key // SLOTS, np.arange(1, batch.num_rows)))
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([r.tobytes() for r in rows], pa.binary()), batch.column("y").cast(pa.int32())], names=["id", "slots", "y"])
    trim()


class Model:
    """The intercept and the nonzero weights."""

    def __init__(self, bias: float, slots: np.ndarray, weights: np.ndarray):
        self.bias, self.slots, self.weights, self._dense = bias, slots, weights, None

    def __getstate__(self):
        return {"bias": self.bias, "slots": self.slots, "weights": self.weights, "_dense": None}

    def score(self, texts: pa.Array) -> np.ndarray:
        if self._dense is None:
            self._dense = np.zeros(SLOTS, np.float32)
            self._dense[self.slots] = self.weights
        text, slot = features(texts)
        some = self._dense[slot] != 0
        key = np.unique(text[some] * SLOTS + slot[some])
        return sigmoid(self.bias + np.bincount(key // SLOTS, self._dense[key % SLOTS], minlength=len(texts)))


def fit(rows: list[tuple[np.ndarray, int]], sizes: list[int], alpha: float = 1.0, beta: float = 1.0, l1: float = 4.0, l2: float = 0.5, epochs: int = 4, seed: int = 42) -> Model:
    """FTRL-proximal: z and n per coordinate; a weight is nonzero once |z| passes l1.

    The rate, l1 and epochs are those of fourteen settings with the fewest errors in ``cross_validated`` over training ids.
    """
    total = sum(sizes)
    if not rows or min(sizes) == 0:
        share = sizes[1] / total if total else 0.0
        return Model(math.log(share / (1 - share)) if 0 < share < 1 else (35.0 if share else -35.0), np.empty(0, np.int64), np.empty(0, np.float32))
    z, n = np.zeros(SLOTS), np.zeros(SLOTS)
    zb = nb = 0.0
    order = np.random.default_rng(seed)

    def weight(zs: np.ndarray, ns: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zs) > l1, -(zs - np.sign(zs) * l1) / ((beta + np.sqrt(ns)) / alpha + l2), 0)

    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            at, y = rows[k]
            zs, ns = z[at], n[at]
            w = weight(zs, ns)
            bias = -zb / ((beta + math.sqrt(nb)) / alpha)
            g = float(sigmoid(np.float64(bias + w.sum()))) - y
            z[at] = zs + g - (np.sqrt(ns + g * g) - np.sqrt(ns)) / alpha * w
            n[at] = ns + g * g
            zb += g - (math.sqrt(nb + g * g) - math.sqrt(nb)) / alpha * bias
            nb += g * g
    w = weight(z, n)
    slots = np.flatnonzero(w)
    return Model(-zb / ((beta + math.sqrt(nb)) / alpha), slots, w[slots].astype(np.float32))


def sampled(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 6000, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[tuple[np.ndarray, int]], list[int]]:
    """The rows a model is fitted on, and the class sizes: at most ``bound`` labelled ids, and ``max_bytes`` of their features."""
    sample, sizes = labelled_sample(docs, labels, label, bound, PARTS, PART, id_col, text_col)
    rows = sample.mapInArrow(_slots, f"id {sample.schema['id'].dataType.simpleString()}, slots binary, y int")
    return [(np.frombuffer(r["slots"], "<u4"), r["y"]) for r in bounded(rows, ["slots"], max_bytes)], sizes


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = 6000, max_bytes: int = 64 << 20, id_col: str = "doc_id", text_col: str = "text") -> Model:
    return fit(*sampled(docs, labels, label, bound, max_bytes, id_col, text_col))


def cross_validated(rows: list[tuple[np.ndarray, int]], sizes: list[int], settings: list[dict], folds: int = 4, seed: int = 7) -> list[tuple[int, int]]:
    """(missed, rejected) of each setting, summed over folds of the sample, so that settings are chosen without a look at held-out ids."""
    place = np.random.default_rng(seed).permutation(len(rows)) % folds
    out = []
    for setting in settings:
        missed = rejected = 0
        for fold in range(folds):
            model = fit([r for r, k in zip(rows, place, strict=True) if k != fold], sizes, **setting)
            dense = np.zeros(SLOTS, np.float32)
            dense[model.slots] = model.weights
            for (slots, y), k in zip(rows, place, strict=True):
                if k == fold:
                    toxic = model.bias + dense[slots].sum() >= 0
                    missed += bool(y and not toxic)
                    rejected += bool(toxic and not y)
        out.append((missed, rejected))
    return out


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return scored(docs, _scorer(shared), id_col, text_col)


def _scorer(shared) -> Callable[[pa.Array], np.ndarray]:
    return lambda texts: shared.value.score(texts)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score at or above ``threshold``."""
    (score,) = fresh(docs, "_score")
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col))
    return with_scores(docs, _scorer(shared), text_col, score).where(F.col(score) < threshold).drop(score)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scores(docs, train(docs, table(spark, sf_dir, "labels")))
    return found.select(F.col("id").alias("doc_id"), held_out("id", PARTS, PART).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
