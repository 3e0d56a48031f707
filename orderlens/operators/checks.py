"""Data-quality measures. Each yields rows ``(table, check, issue_count)``."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import any_null, lenient_date, looks_corrupted, named
from orderlens.operators.joins import orphan_values, repeated_keys
from orderlens.session import materialize


def stack_rows(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _as_rows(table: str, measures: DataFrame) -> DataFrame:
    """One wide row of counts to one report row per count."""
    return measures.unpivot([], [named(c) for c in measures.columns], "check", "issue_count").select(
        F.lit(table).alias("table"), "check", F.col("issue_count").cast("bigint").alias("issue_count")
    )


def _count_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def profile(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Row count, rows with a null key part and nulls per column, in one scan."""
    measures = df.agg(
        F.count("*").alias("row_count"),
        _count_if(any_null(keys), "missing_primary_key"),
        *[_count_if(named(c).isNull(), f"missing_{c}") for c in df.columns],
    )
    return _as_rows(table, measures)


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows in duplicate-key groups; nulls count as equal. Shuffles keys only."""
    repeated = repeated_keys(df, keys)
    return _as_rows(table, repeated.agg(_total("n").alias("duplicate_primary_key")))


def duplicates(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Rows in duplicate-key groups, and extra copies of whole rows; nulls count as equal.

    Copies of a row share its key. So the repeated keys are found first, from the key
    columns alone, and only their rows are compared whole: clean data never shuffles a
    row. The repeated keys are written once, as two results read them; Spark chooses
    the join from the size of what was written.
    """
    repeated = materialize(repeated_keys(df, keys), "repeated")
    same_key = reduce(and_, [df[f"`{k}`"].eqNullSafe(repeated[f"`{k}`"]) for k in keys])
    suspects = df.join(repeated, same_key, "left_semi")
    rows = suspects.groupBy(*[named(c) for c in df.columns]).agg(F.count("*").alias("_n"))
    return stack_rows([
        _as_rows(table, repeated.agg(_total("n").alias("duplicate_primary_key"))),
        _as_rows(table, rows.agg((_total("_n") - F.count("*")).alias("full_row_duplicate"))),
    ])


def _total(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0))


def orphans(child: DataFrame, child_name: str, column: str, parent: DataFrame, parent_name: str,
            parent_column: str) -> DataFrame:
    """Distinct child values that the parent lacks."""
    missing = orphan_values(child, column, parent, parent_column)
    return _as_rows(child_name, missing.agg(F.count("*").alias(f"orphan_{column}_to_{parent_name}")))


def unparseable_dates(df: DataFrame, table: str, column: str) -> DataFrame:
    """Values that are no date; missing ones count, as they cannot be used either."""
    col = named(column)
    if df.schema[column].dataType.simpleString() == "string":
        col = lenient_date(col)
    return _as_rows(table, df.agg(_count_if(col.isNull(), f"unparseable_date_{column}")))


def corrupted_numbers(df: DataFrame, table: str, column: str) -> DataFrame:
    name = f"corrupted_{column.replace(' ', '_')}"
    return _as_rows(table, df.agg(_count_if(looks_corrupted(named(column)), name)))


def negative_values(df: DataFrame, table: str, column: str) -> DataFrame:
    """Negative quantities; nulls are not negative."""
    return _as_rows(table, df.agg(_count_if(named(column) < 0, f"negative_{column.replace(' ', '_')}")))
