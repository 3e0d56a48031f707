"""Mean day differences over equi-joins, computed from per-key sums.

For one key, the pairs of an equi-join have (rows x rows) members and their summed
day difference is n_start * sum(end) - n_end * sum(start). So both sides are
aggregated before they are shuffled to the join: a key that holds a third of the rows
reaches the join as one row, and the joined pairs are never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_mass(df: DataFrame, date: str, keys: list[str]) -> DataFrame:
    """Per key: ``rows``, how many are ``dated``, and their summed ``days`` since 1970."""
    return df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count(date).alias("dated"),
        F.coalesce(F.sum(F.unix_date(date).cast("bigint")), F.lit(0)).alias("days"),
    )


def gap_mass(start: DataFrame, end: DataFrame, on: str) -> DataFrame:
    """Join two date masses: per joined key the pair count ``pairs``, how many have both
    dates (``gaps``) and the summed day difference (``gap_days``)."""
    s, e = start.alias("s"), end.alias("e")
    extra = [F.col(f"s.{c}") for c in start.columns if c not in {on, "rows", "dated", "days"}]
    extra += [F.col(f"e.{c}") for c in end.columns if c not in {on, "rows", "dated", "days"}]
    return s.join(e, on).select(
        on,
        *extra,
        (F.col("s.rows") * F.col("e.rows")).alias("pairs"),
        (F.col("s.dated") * F.col("e.dated")).alias("gaps"),
        (F.col("s.dated") * F.col("e.days") - F.col("e.dated") * F.col("s.days")).alias("gap_days"),
    )
