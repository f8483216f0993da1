"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

A text is a sparse vector of hashed words and hashed word shapes; all grades share its weights, and ordered thresholds
cut the score into grades: P(grade <= k) = sigmoid(threshold_k - score). The model is fitted on at most
``max_labelled`` labelled documents, those with the smallest hash of their key; it scores every document, whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chunks as C
from .shared import numbered

DIMENSIONS = 1 << 20
_EDGES = ".,;:!?()[]{}\"'“”«»…"


def _buckets(chunk: str) -> tuple[int, int]:
    """Of a chunk: the bucket of its word, without case and edge punctuation, and the bucket of its shape or -1."""
    c = chunk.strip()
    word = c.lower().strip(_EDGES)
    odd = "".join(sorted({x for x in c if not x.isalnum() and x not in ".,"}))
    shape = f"{odd}{'U' if len(c) > 1 and c.isupper() else ''}{'9' if any(x.isdigit() for x in c) else ''}"
    return zlib.crc32(word.encode()) % DIMENSIONS, zlib.crc32(b"\0" + shape.encode()) % DIMENSIONS if shape else -1


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row offsets, buckets and values: 1 + log(count) for words, four times their share of the words for shapes."""
    pieces, off = C.chunked(texts)
    index, distinct = C.coded(pieces)
    if not len(index):
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64), np.zeros(0)
    table = np.array([_buckets(c) for c in distinct.to_pylist()], dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(off))
    shapes = table[index, 1] >= 0
    keys = np.concatenate([(row << 21) | table[index, 0], (row[shapes] << 21) | DIMENSIONS | table[index[shapes], 1]])
    keys, n = np.unique(keys, return_counts=True)
    own, shape = keys >> 21, (keys & DIMENSIONS) > 0
    values = np.where(shape, 4.0 * n / np.maximum(np.diff(off), 1)[own], 1.0 + np.log(n))
    return np.searchsorted(own, np.arange(len(texts) + 1)), keys & (DIMENSIONS - 1), values


@dataclass(frozen=True)
class Model:
    """Weights by bucket and the ordered thresholds."""

    buckets: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def dense(self) -> np.ndarray:
        w = np.zeros(DIMENSIONS)
        w[self.buckets] = self.weights
        return w

    def tails(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold k, one column each."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -60, 60)))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def _sums(v: np.ndarray, off: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate(([0.0], np.cumsum(v)))[off])


@dataclass(frozen=True)
class Sample:
    """Rated texts as sparse rows over ``width`` columns: row offsets, columns, values, grades and the weight of each row."""

    off: np.ndarray
    column: np.ndarray
    x: np.ndarray
    grades: np.ndarray
    weight: np.ndarray
    width: int
    n_grades: int


def unpack(free: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and ordered thresholds of the free parameters: the first threshold and the logarithms of the steps to the next ones."""
    return free[:width], free[width] + np.concatenate(([0.0], np.cumsum(np.exp(free[width + 1 :]))))


def objective(free: np.ndarray, d: Sample, ridge: float) -> tuple[float, np.ndarray]:
    """Mean weighted negative log likelihood with a ridge penalty on the weights, and its gradient."""
    w, cuts = unpack(free, d.width)
    grades, last, m = d.grades, d.n_grades - 1, len(d.grades)
    s = _sums(w[d.column] * d.x, d.off)
    lo_k, hi_k = np.maximum(grades - 1, 0), np.minimum(grades, last - 1)
    hi = np.where(grades < last, _sigmoid(cuts[hi_k] - s), 1.0)
    lo = np.where(grades > 0, _sigmoid(cuts[lo_k] - s), 0.0)
    p = (hi - lo).clip(1e-9)
    g_s = d.weight * (1 - hi - lo)  # d(-log likelihood) / d score
    row = np.repeat(np.arange(m), np.diff(d.off))
    g_w = np.bincount(d.column, g_s[row] * d.x, d.width) / m + ridge * w
    by_cut = np.bincount(hi_k, np.where(grades < last, -d.weight * hi * (1 - hi) / p, 0), last) + np.bincount(lo_k, np.where(grades > 0, d.weight * lo * (1 - lo) / p, 0), last)
    later = np.cumsum(by_cut[::-1])[::-1] / m
    return float(-(d.weight * np.log(p)).sum() / m + ridge * (w * w).sum() / 2), np.concatenate([g_w, later[:1], later[1:] * np.diff(cuts)])


def fit(off: np.ndarray, buckets: np.ndarray, values: np.ndarray, grades: np.ndarray, least_documents: int = 5, ridge: float = 1e-3, rounds: int = 250, rate: float = 0.08) -> Model:
    """Maximum likelihood with a ridge penalty, by Adam over the whole sample; grades weigh by the root of their rarity."""
    n_grades = int(grades.max()) + 1
    used, column, seen = np.unique(buckets, return_inverse=True, return_counts=True)
    keep = seen >= least_documents
    mask = keep[column]
    to = np.cumsum(keep) - 1
    row = np.repeat(np.arange(len(grades)), np.diff(off))[mask]
    weight = 1 / np.sqrt(np.bincount(grades, minlength=n_grades).clip(1))[grades]
    weight *= len(grades) / weight.sum()
    used = used[keep]
    d = Sample(np.searchsorted(row, np.arange(len(grades) + 1)), to[column[mask]], values[mask], grades, weight, len(used), n_grades)
    cuts = np.log(np.arange(1, n_grades) / (n_grades - np.arange(1, n_grades)))
    free = np.concatenate([np.zeros(len(used)), cuts[:1], np.log(np.diff(cuts).clip(1e-3))])
    m1, m2 = np.zeros_like(free), np.zeros_like(free)
    for t in range(1, rounds + 1):
        g = objective(free, d, ridge)[1]
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        free = free - rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
    w, cuts = unpack(free, len(used))
    return Model(used, w, cuts)


def train(docs: DataFrame, ratings: DataFrame, key: str = "doc_id", text: str = "text", grade: str = "grade", max_labelled: int = 6000) -> Model | None:
    """Fits on the rated documents; None if fewer than two grades are found. A key rated twice counts with its lowest grade.

    Null keys and grades are left out. The sample is bounded by ``max_labelled`` rows, whatever the tables' sizes.
    """
    rated = ratings.where(F.col(key).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(grade).cast("int").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("key"), "key").limit(max_labelled)
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text").join(F.broadcast(chosen), "key")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in C.slices(batch, "text"):
                off, b, v = features(texts)
                lists = [pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(a, k)) for a, k in ((b, pa.int32()), (v, pa.float32()))]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("grade"), *lists], ["key", "grade", "buckets", "values"])

    kind = docs.schema[key].dataType.simpleString()
    found = rows.mapInArrow(vectors, f"key {kind}, grade int, buckets array<int>, values array<float>").toArrow().combine_chunks().sort_by("key")
    if len(found) == 0:
        return None
    grades = found.column("grade").combine_chunks().to_numpy().astype(np.int64)
    if len(np.unique(grades)) < 2:
        return None
    b, v = found.column("buckets").combine_chunks(), found.column("values").combine_chunks()
    off = np.concatenate(([0], np.cumsum([len(x) for x in b])))
    return fit(off, b.flatten().to_numpy().astype(np.int64), v.flatten().to_numpy().astype(float), grades)


def score(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text", least_grade: int = 2, least_tail: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: key, expected_grade, tail_probability (of ``least_grade`` or more), kept.

    Null and empty texts have score 0, as a text of unknown words has. Without a model the two figures are null and
    all rows are kept. Repeated rows and null keys stay; other columns are not read, whatever their names; texts of any
    length are read whole; an empty table gives no rows.
    """
    rows = numbered(docs, text).select(F.col(key).alias("key"), "text")
    if model is None:
        return rows.select(F.col("key").alias(key), F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail_probability"), F.lit(True).alias("kept"))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shipped.value.dense()
        for batch in batches:
            for part, texts in C.slices(batch, "text"):
                off, b, v = features(texts)
                tails = shipped.value.tails(_sums(weights[b] * v, off))
                tail = tails[:, min(least_grade, tails.shape[1]) - 1]
                yield pa.RecordBatch.from_arrays([part.column("key"), pa.array(tails.sum(axis=1)), pa.array(tail), pa.array(tail >= least_tail)], [key, "expected_grade", "tail_probability", "kept"])

    kind = docs.schema[key].dataType.simpleString()
    return rows.mapInArrow(run, f"`{key}` {kind}, expected_grade double, tail_probability double, kept boolean")


def select(docs: DataFrame, model: Model | None, text: str = "text", least_grade: int = 2, least_tail: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score`` would keep; nothing is shuffled.

    Repeated rows and null keys are judged by their texts like all others.
    """
    if model is None:
        return docs
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shipped.value.dense()
        for batch in batches:
            for part, texts in C.slices(batch, text):
                off, b, v = features(texts)
                tails = shipped.value.tails(_sums(weights[b] * v, off))
                yield part.filter(pa.array(tails[:, min(least_grade, tails.shape[1]) - 1] >= least_tail))

    return docs.mapInArrow(run, docs.schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades of the labels table: 0 junk, 1 fluent but toxic, 2 clean. Null labels are left out."""
    return labels.select("doc_id", F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2).alias("grade"))
