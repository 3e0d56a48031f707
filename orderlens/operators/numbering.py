"""Dense surrogate ids over a total order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialize

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def dense_ids(df: DataFrame, order_by: list[str], name: str, after: int = 0, keep: Sequence[str] | None = None) -> DataFrame:
    """Add ``name`` = after+1..after+n in the order of ``order_by``; ``keep`` names the columns that stay, if not all.

    They are range-partitioned and sorted, so any run of rows, a hot leading key
    included, is spread as far as ``order_by`` tells its rows apart. Finding the ranges
    runs the last stage of ``df`` once more, on shuffled rows that are there by then.
    The sorted rows are written to the shared folder, once: partition sizes and row
    positions must come from one evaluation. The offsets table has one row per partition,
    which bounds both its window and its broadcast.
    """
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    columns = df.columns if keep is None else list(keep)
    placed = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()).select(*columns, "_at"), "ids")
    part = F.shiftright("_at", _ROW_BITS)
    row = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))

    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    too_many = F.raise_error(F.lit("a partition has more rows than its row bits count")).cast("bigint")
    sizes = sizes.withColumn("_n", F.when(F.col("_n") < 1 << _ROW_BITS, F.col("_n")).otherwise(too_many))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    offsets = F.broadcast(sizes.select("_part", before.alias("_before")))
    return (
        placed.withColumn("_part", part)
        .join(offsets, "_part")
        .select((F.col("_before") + row + 1 + after).alias(name), *columns)
    )
