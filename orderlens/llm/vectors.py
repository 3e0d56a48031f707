"""Vectors packed into bounded matrices, one row of Spark per tile."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(name: str) -> Column:
    """Whether an array column is there, not empty and holds finite numbers only."""
    finite = F.forall(name, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(name) > 0) & finite, F.lit(False))


def matrix(packed: bytes, dim: int, dtype: str) -> np.ndarray:
    return np.frombuffer(packed, dtype).reshape(-1, dim)


def tiles(rows: DataFrame, tile: str, dtype: str) -> DataFrame:
    """(tile, ids array<bigint>, packed binary, dim) of ``rows`` (tile, id, vector); a tile must be bounded.

    Rows of a tile come in order of id. Vectors of one tile have the same length.
    """
    kind = dict(rows.dtypes)[tile]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        order = np.argsort(table["id"].to_numpy(), kind="stable")
        flat = table["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        packed = flat.reshape(len(order), -1)[order].astype(dtype)
        ids = table["id"].to_numpy()[order]
        yield pa.RecordBatch.from_arrays(
            [table[tile].combine_chunks()[:1], pa.array([ids], pa.list_(pa.int64())), pa.array([packed.tobytes()], pa.binary()),
             pa.array([packed.shape[1]], pa.int32())],
            [tile, "ids", "packed", "dim"],
        )

    return rows.select(tile, "id", "vector").groupBy(tile).applyInArrow(_tables(pack), f"{tile} {kind}, ids array<bigint>, packed binary, dim int")


def _tables(pack: Callable) -> Callable[[pa.Table], pa.Table]:
    return lambda table: pa.Table.from_batches(pack(iter(table.to_batches())))
