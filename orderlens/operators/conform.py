"""Rename, type and reorder source columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame

from orderlens.functions import lenient_date, named
from orderlens.schema import SHEETS
from orderlens.schema import Column as SheetColumn


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def _typed(df: DataFrame, column: SheetColumn) -> Column:
    """The column under its declared type; a number that does not fit fails, a date that is none is null."""
    have, want = df.schema[column.header].dataType.simpleString(), column.spark_type
    source = named(column.header)
    if have == want:
        return source
    if want == "date" and have == "string":
        return lenient_date(source)
    return source.cast(want)


def to_mart(df: DataFrame, sheet: str) -> DataFrame:
    """Sheet columns under the analysis names, headers kept distinct from items."""
    return df.select(*[_typed(df, c).alias(c.mart_name) for c in SHEETS[sheet].columns])


def to_table(df: DataFrame, sheet: str) -> DataFrame:
    """Sheet columns under the warehouse names, in table order."""
    by_name = {c.warehouse: c for c in SHEETS[sheet].columns}
    return df.select(*[_typed(df, by_name[n]).alias(n) for n in SHEETS[sheet].table_order])


def to_untyped_table(df: DataFrame, sheet: str) -> DataFrame:
    """Sheet columns under the warehouse names with their values as they came, for checks before a load."""
    by_name = {c.warehouse: c for c in SHEETS[sheet].columns}
    return df.select(*[named(by_name[n].header).alias(n) for n in SHEETS[sheet].table_order])
