"""Quality by ordinal cumulative-link regression on graded ratings.

Texts are bags of hashed tokens (words, and runs of other signs) with damped, length-normalised counts. One weight vector
serves all grades; ordered thresholds cut the score into grades:

    P(grade <= k) = sigmoid(threshold_k - w . x),   threshold_1 < threshold_2 < ...

Tasks make the features. The fit runs over a bounded sample of rated rows; scoring runs over everything, with a weight
vector of fixed size.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import cut, measured_broadcast

BUCKETS = 1 << 16
_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+|[^0-9A-Za-z\x80-\xff\x00-\x20]+")


@dataclass(frozen=True)
class QualityModel:
    """Grades in ascending order, len(grades) - 1 ascending thresholds, and the weights."""

    grades: tuple[float, ...]
    thresholds: np.ndarray
    weights: np.ndarray

    def below(self, score: np.ndarray) -> np.ndarray:
        """P(grade <= k) of each score, one column for each threshold."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.thresholds[None, :] - score[:, None], -35.0, 35.0)))


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, values) of a text; values have unit length together, an empty text has none."""
    counts = Counter(_TOKEN.findall(text.encode().lower())) if text else {}
    if not counts:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    at = np.fromiter((zlib.crc32(t) % BUCKETS for t in counts), np.int32, len(counts))
    value = np.log1p(np.fromiter(counts.values(), np.float64, len(counts)))
    return at, (value / np.sqrt(value @ value)).astype(np.float32)


def _fit(rows: list[tuple[int, np.ndarray, np.ndarray]], grades: tuple[float, ...], epochs: int, rate: float, decay: float) -> QualityModel:
    """Stochastic gradient descent with per-weight steps, in an order fixed by a seed."""
    k = len(grades) - 1
    share = np.cumsum(np.bincount([y for y, _, _ in rows], minlength=k + 1))[:k] / len(rows)
    share = np.clip(share, 1e-3, 1 - 1e-3)
    thresholds = np.maximum.accumulate(np.log(share / (1 - share)) + np.arange(k) * 1e-6)
    weights, past = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    past_t = np.full(k, 1.0)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            y, at, value = rows[i]
            score = float(weights[at] @ value) if len(at) else 0.0
            below = 1.0 / (1.0 + np.exp(-np.clip(thresholds - score, -35.0, 35.0)))
            # edges of the grade's interval; the slope of log(upper - lower)
            upper = below[y] if y < k else 1.0
            lower = below[y - 1] if y > 0 else 0.0
            mass = max(upper - lower, 1e-9)
            up, low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
            if len(at):
                step = (up - low) * value + decay * weights[at]
                past[at] += step * step
                weights[at] -= rate * step / np.sqrt(past[at])
            slope = np.zeros(k)
            if y < k:
                slope[y] += up
            if y > 0:
                slope[y - 1] -= low
            past_t += slope * slope
            thresholds = np.maximum.accumulate(thresholds + rate * slope / np.sqrt(past_t))
    return QualityModel(grades, thresholds, weights)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    train: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    max_labelled: int = 8_000,
    epochs: int = 6,
    rate: float = 0.5,
    decay: float = 1e-5,
) -> QualityModel:
    """A model from at most `max_labelled` rated rows, chosen by hash, for which `train` (on the id) holds.

    A document with several ratings counts with the largest. With no rating the one grade is 0; with equal ratings every
    text gets that grade.
    """
    rated = labels.filter(train) if train is not None else labels
    rated = rated.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("grade")).dropna()
    rated = rated.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    rated = cut(rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = texts.join(measured_broadcast(rated, max_labelled), "doc_id")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t) for t in batch.column("text").to_pylist()]
            blobs = [[m[k].tobytes() for m in made] for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("grade"), *[pa.array(b, pa.binary()) for b in blobs]],
                ["doc_id", "grade", "at", "value"],
            )

    kind = texts.schema["doc_id"].dataType.simpleString()
    made = texts.select("doc_id", "grade", "text").mapInArrow(run, f"doc_id {kind}, grade double, at binary, value binary")
    # ordered, so that a rerun takes the same steps; a repeated document counts once
    got = made.dropDuplicates(["doc_id"]).orderBy("doc_id").toLocalIterator()
    rows = [(r.grade, np.frombuffer(r["at"], np.int32), np.frombuffer(r.value, np.float32)) for r in got]
    grades = tuple(sorted({g for g, _, _ in rows}))
    if len(grades) < 2:
        return QualityModel(grades or (0.0,), np.zeros(0), np.zeros(BUCKETS))
    number = {g: i for i, g in enumerate(grades)}
    return _fit([(number[g], a, v) for g, a, v in rows], grades, epochs, rate, decay)


def score_quality(docs: DataFrame, model: QualityModel, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, expected_grade, tail_probability (of the highest grade).

    Whole texts count; null and empty ones get what the thresholds say of a score of 0. Repeated rows repeat; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        grades = np.array(model.grades)
        for batch in batches:
            made = [features(t) for t in batch.column("text").to_pylist()]
            score = np.array([float(model.weights[at] @ value) if len(at) else 0.0 for at, value in made])
            below = model.below(score)
            mass = np.diff(np.c_[np.zeros(len(score)), below, np.ones(len(score))], axis=1)
            tail = mass[:, -1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(mass @ grades), pa.array(tail)], ["doc_id", "expected_grade", "tail_probability"]
            )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, expected_grade double, tail_probability double")
