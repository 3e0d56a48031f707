"""Rows numbered within their key, and bounded groups of sorted rows inside tasks.

Any key may hold most of the rows, so a key is never one task: its rows are dealt by range of the whole
order, and what is done with them goes by blocks of successive places.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialize

#: monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def tagged(col: Column) -> Column:
    """A value as a text that is never null; null is first, then texts by their bytes."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit("-"))


def placed(rows: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """``rows`` with ``at``, a row's place among those of its ``key`` from 0, and ``held``, how many those are.

    ``key`` is never null. Rows equal in key and order columns may change places with each other. The sorted
    rows are written, so that counts and places come from one evaluation. The window sees a row for every
    partition that a key reaches, never the rows of a key.
    """
    spread = rows.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    written = materialize(spread.withColumn("_row", F.monotonically_increasing_id()), label)
    part = F.shiftright("_row", _ROW_BITS).alias("_part")
    runs = written.groupBy(part, key).agg(F.min("_row").alias("_first"), F.count("*").alias("_n"))
    of_key = Window.partitionBy(key)
    runs = runs.select(
        "_part", key, "_first", (F.sum("_n").over(of_key.orderBy("_part")) - F.col("_n")).alias("_before"),
        F.sum("_n").over(of_key).alias("held"),
    )
    at = (F.col("_row") - F.col("_first") + F.col("_before")).alias("at")
    return written.withColumn("_part", part).join(runs, ["_part", key]).select(*rows.columns, at, "held")


def by_block(rows: DataFrame, key: str, size: int, *order: str) -> DataFrame:
    """``rows`` with the ``block`` of ``size`` successive places that they are in; a block's rows come together and in order."""
    blocks = rows.withColumn("block", F.expr(f"at div {size}"))
    return blocks.repartition(key, "block").sortWithinPartitions(key, "block", *(order or ("at",)))


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Successive rows that agree in their first ``keys`` columns, as lists of tuples."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if held and held[0][:keys] != row[:keys]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


#: Rows of a batch, more or less.
SEND = 2048


def sent(rows: Iterator[list[tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Lists of rows as record batches."""
    ready: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = list(zip(*ready)) or [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    for more in rows:
        ready += more
        if len(ready) >= SEND:
            yield batch()
            ready = []
    if ready:
        yield batch()
