"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= g) = sigmoid(threshold_g - w . x): one weight vector over hashed text features for all
grades, and ordered thresholds between them. Features are shares of a document, so long and short
texts compare: its words, the shapes of its words (case, digits, punctuation, length), pairs of
neighbouring shapes, repeats, and buckets of its length and variety. Nothing but the text enters.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.hashing import mix, runs, span_hashes, spans
from orderlens.llm.scoring import descend, lists, sample, sigmoid, sparse

#: Labelled documents the fit uses at most; scoring reads every document.
SAMPLE = 3000
BUCKETS = 1 << 16
STEPS, RATE, DECAY = 120, 0.05, 1e-4
#: Documents are kept whose probability of a grade of at least ``GOOD`` reaches this.
CUT = 0.5
GOOD = 1

_KIND = np.zeros(256, np.int8)  # of a byte: 0 lower case and letters beyond ASCII, 1 upper, 2 digit, 3 other
_KIND[33:128] = 3
_KIND[ord("a") : ord("z") + 1] = 0
_KIND[ord("A") : ord("Z") + 1] = 1
_KIND[ord("0") : ord("9") + 1] = 2


def _tag(values: np.ndarray, kind: int) -> np.ndarray:
    """Buckets of a kind of feature."""
    return (mix(values.astype(np.uint64) + np.uint64(kind << 56)) % np.uint64(BUCKETS)).astype(np.int64)


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    kind = _KIND[data]
    code = np.minimum(np.log2(ends - starts).astype(np.int64), 7)
    for k in (1, 2, 3):
        count = np.concatenate([[0], np.cumsum(kind == k)])
        code = code * 4 + np.minimum(count[ends] - count[starts], 3)
    return (code * 4 + kind[starts]) * 4 + kind[ends - 1]


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, values) per row."""
    for first, end, data, offsets in runs(column):
        starts, ends, rows = spans(data, offsets)
        words = span_hashes(data, starts, ends)
        shapes = _shapes(data, starts, ends) if len(starts) else np.zeros(0, np.int64)
        word_at, shape_at = _tag(words, 1), _tag(shapes, 2)
        pair_at = _tag(shapes[1:] * 65536 + shapes[:-1], 3)
        again = np.concatenate([[False], words[1:] == words[:-1]])
        for k in range(end - first):
            lo, hi = rows[k], rows[k + 1]
            n = hi - lo
            size = int(np.log2(n + 1))
            if not n:
                yield _tag(np.array([size]), 4), np.ones(1)
                continue
            at, counts = np.unique(np.concatenate([word_at[lo:hi], shape_at[lo:hi], pair_at[lo : hi - 1]]), return_counts=True)
            variety = int(10 * len(np.unique(words[lo:hi])) / n)
            repeats = int(10 * again[lo + 1 : hi].mean()) if n > 1 else 0
            extra = [_tag(np.array([v]), kind) for v, kind in ((size, 4), (variety * 16 + min(size, 15), 5), (repeats, 6))]
            yield np.concatenate([at, *extra]), np.concatenate([np.sqrt(counts / n), np.ones(3)])


class Model(NamedTuple):
    """Weights over BUCKETS and the thresholds between successive grades."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray

    def tails(self, column: pa.Array) -> np.ndarray:
        """P(grade >= g) per row, for every grade but the lowest."""
        scores = np.array([self.weights[at] @ value for at, value in features(column)])
        return sigmoid(scores[:, None] - self.thresholds[None, :])


def fit_rows(indexes: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray) -> Model:
    """Maximum likelihood with weight decay; thresholds are a first one plus positive steps."""
    grades, y = np.unique(labels, return_inverse=True)
    rows, cuts = sparse(indexes, values), len(grades) - 1
    if cuts < 1:  # nothing to tell apart: everything has the one grade
        return Model(np.zeros(BUCKETS), np.full(max(cuts, 0), -40.0), grades)

    def thresholds(tail: np.ndarray) -> np.ndarray:
        return tail[0] + np.concatenate([[0.0], np.cumsum(np.exp(tail[1:]))])

    def slope(at: np.ndarray) -> np.ndarray:
        weights, tail = at[:BUCKETS], at[BUCKETS:]
        theta = thresholds(tail)
        score = rows.dot(weights)
        above = np.where(y < cuts, sigmoid(theta[np.minimum(y, cuts - 1)] - score), 1.0)
        below = np.where(y > 0, sigmoid(theta[np.maximum(y, 1) - 1] - score), 0.0)
        chance = np.maximum(above - below, 1e-9)
        up, down = above * (1 - above) / chance, below * (1 - below) / chance  # of -log P by the two thresholds
        by_score = (up - down) / len(y)
        by_theta = np.bincount(np.maximum(y, 1) - 1, np.where(y > 0, down, 0.0), cuts)
        by_theta -= np.bincount(np.minimum(y, cuts - 1), np.where(y < cuts, up, 0.0), cuts)
        by_theta /= len(y)
        later = np.cumsum(by_theta[::-1])[::-1]
        by_tail = np.concatenate([later[:1], later[1:] * np.exp(tail[1:])])
        return np.concatenate([rows.back(by_score, BUCKETS) + DECAY * weights, by_tail])

    at = descend(np.zeros(BUCKETS + cuts), slope, STEPS, RATE)
    return Model(at[:BUCKETS], thresholds(at[BUCKETS:]), grades)


def fit(docs: DataFrame, ratings: DataFrame, rating: str = "quality", most: int = SAMPLE) -> Model:
    """Fit on at most ``most`` rated documents, a bound that makes collecting their features safe.

    Ratings are integers of any number of grades. Without any rated document every text is rejected.
    """
    chosen = F.broadcast(sample(ratings, rating, most))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(features(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"),
                 pa.array([at.astype(np.int32) for at, _ in found], pa.list_(pa.int32())),
                 pa.array([value.astype(np.float32) for _, value in found], pa.list_(pa.float32()))],
                ["doc_id", "label", "at", "value"],
            )

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rated = plain.where("text is not null").join(chosen, "doc_id").select("doc_id", "text", "label")
    rows = rated.mapInArrow(featurise, "doc_id bigint, label int, at array<int>, value array<float>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])
    return fit_rows(lists(rows["at"]), lists(rows["value"]), rows["label"].to_numpy())


def score(docs: DataFrame, model: Model, good: int = GOOD, cut: float = CUT) -> DataFrame:
    """``docs`` with expected_grade, good_probability (of a grade of at least ``good``) and selected.

    Null and empty texts, and texts of white space, have the lowest grade and are not selected. All
    columns and rows of ``docs`` are passed on, whatever they are called; the three come last.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        step = np.diff(model.grades)
        at_least = int(np.searchsorted(model.grades, good)) - 1
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            lowest = float(model.grades[0]) if len(model.grades) else 0.0
            if len(step) and len(text):
                tails = model.tails(text)
                written = np.array([bool(t.as_py() and t.as_py().strip(" \t\n\v\f\r")) for t in text])
                tails[~written] = 0
                expected = lowest + tails @ step
                chance = tails[:, at_least] if 0 <= at_least < len(step) else np.full(len(text), float(at_least < 0))
            else:
                expected, chance = np.full(len(text), lowest), np.zeros(len(text))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(expected), pa.array(chance)], [str(k) for k in range(batch.num_columns + 1)]
            )

    n = len(docs.columns)
    numbered = docs.toDF(*[str(k) for k in range(n)])
    text_at = docs.columns.index("text")
    kinds = ", ".join(f"`{k}` {f.dataType.simpleString()}" for k, f in enumerate(docs.schema))
    graded = numbered.withColumn("t", F.col(f"`{text_at}`").cast("string")).mapInArrow(grade, f"{kinds}, `{n}` double, `{n + 1}` double")
    graded = graded.withColumn("s", F.col(f"`{n + 1}`") >= F.lit(cut))
    return graded.toDF(*docs.columns, "expected_grade", "good_probability", "selected")
