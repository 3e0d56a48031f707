"""What the two text classifiers share: bounded labelled samples, sparse rows and their optimiser."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Rows(NamedTuple):
    """Sparse rows: row k has weights ``index[start[k]:start[k + 1]]`` times ``value``."""

    index: np.ndarray
    value: np.ndarray
    start: np.ndarray

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0.0], np.cumsum(weights[self.index] * self.value)])
        return sums[self.start[1:]] - sums[self.start[:-1]]

    def back(self, slopes: np.ndarray, size: int) -> np.ndarray:
        """Gradient of the weights from the rows' slopes."""
        return np.bincount(self.index, np.repeat(slopes, np.diff(self.start)) * self.value, size)


def sparse(indexes: list[np.ndarray], values: list[np.ndarray] | None = None) -> Rows:
    start = np.concatenate([[0], np.cumsum([len(x) for x in indexes])]).astype(np.int64)
    index = np.concatenate([np.zeros(0, np.int64), *indexes]).astype(np.int64)
    value = np.ones(len(index)) if values is None else np.concatenate([np.zeros(0), *values])
    return Rows(index, value, start)


def lists(column: pa.ChunkedArray) -> list[np.ndarray | None]:
    """Rows of a list column as arrays, None where null."""
    out: list[np.ndarray | None] = []
    for chunk in column.chunks:
        values, offsets = chunk.values.to_numpy(zero_copy_only=False), chunk.offsets.to_numpy()
        valid = chunk.is_valid().to_numpy(zero_copy_only=False)
        out += [values[a:b] if ok else None for a, b, ok in zip(offsets[:-1], offsets[1:], valid)]
    return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def descend(start: np.ndarray, slope: Callable[[np.ndarray], np.ndarray], steps: int, rate: float) -> np.ndarray:
    """Adam with full gradients: no randomness, so reruns agree."""
    at, mean, square = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for step in range(1, steps + 1):
        g = slope(at)
        mean = 0.9 * mean + 0.1 * g
        square = 0.999 * square + 0.001 * g * g
        at -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return at


def sample(labels: DataFrame, label: str, most: int, where: Column | None = None) -> DataFrame:
    """(doc_id, label) of at most ``most`` labelled rows, chosen by a hash of doc_id.

    A doc_id with several labels counts with the largest, null labels and ids not at all.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        one = one.where(where)
    one = one.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    return one.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(most)
