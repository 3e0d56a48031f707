"""File sources and sinks: sheets in, landed tables and CSV out."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import named
from orderlens.operators.checks import stack_rows
from orderlens.operators.conform import trim_headers
from orderlens.schema import SHEETS
from orderlens.session import run_together
from orderlens.sources.tables import WrittenTables, session_of, write_tables

log = logging.getLogger(__name__)

# Upper bound on rows per exported CSV part, so that no single file grows with the table.
EXPORT_ROWS_PER_FILE = 5_000_000


# Quotes inside a quoted value are doubled, as BI tools and spreadsheets write and read them.
QUOTING = {"quote": '"', "escape": '"'}


def guard_line_breaks(df: DataFrame, path: str) -> DataFrame:
    """``df``, read line by line from CSV files, failing at run time if a value goes on over a line break.

    The line on which such a value begins has an odd number of quotes, and so has one with a stray quote. The check
    rides along as a union branch that yields no row or raises, so that no projection or filter leaves it out;
    it reads lines without parsing them, in splits like the read itself.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTING["quote"])))
    error = F.raise_error(F.concat(
        F.lit("a quoted value holds a line break, or a quote has no partner, in "), F.col("file"),
        F.lit("; read such files with multi_line=True. The line begins: "), F.substring("value", 1, 200),
    ))
    lines = df.sparkSession.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    empty = lines.where(quotes % 2 == 1).where(error.cast("boolean"))
    return df.unionByName(empty.select(*[error.cast(f.dataType).alias(f.name) for f in df.schema]))


def _read(spark: SparkSession, path: str, fmt: str, multi_line: bool = False) -> DataFrame:
    reader = spark.read
    if fmt == "csv":
        reader = reader.options(header=True, multiLine=multi_line, **QUOTING)
    try:
        df = trim_headers(reader.format(fmt).load(path))
        return guard_line_breaks(df, path) if fmt == "csv" and not multi_line else df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"source not found: {path}") from error
        raise


def read_sheet(spark: SparkSession, path: str, name: str, fmt: str = "csv", multi_line: bool = False,
               typed: bool = True) -> DataFrame:
    """One source sheet with declared types, matched by trimmed header name.

    Text files are read as text, so that codes such as a postal ``00100`` or a country
    ``NA`` survive; dates stay text for the parse check. A number that does not fit its
    declared type fails the query; ``typed=False`` leaves all columns of a text file as text, for
    ``quality.type_violations`` to count such values first. Spark splits large CSV files; one with a line break in a
    quoted value fails the query, and is read with ``multi_line=True``, one task a file.
    """
    df = _read(spark, path, fmt, multi_line)
    missing = [h for h in SHEETS[name].headers if h not in df.columns]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    if fmt != "csv" or not typed:
        return df.select(*[named(h) for h in SHEETS[name].headers])
    return df.select(*[
        named(c.header) if c.spark_type in ("string", "date") else named(c.header).cast(c.spark_type).alias(c.header)
        for c in SHEETS[name].columns
    ])


def read_sheets(spark: SparkSession, root: str, fmt: str = "csv", typed: bool = True, multi_line: bool = False) -> dict[str, DataFrame]:
    """All eight sheets from ``root/<name>`` (``root/<name>.csv`` for CSV files), read as by ``read_sheet``."""
    suffix = ".csv" if fmt == "csv" else ""
    return {name: read_sheet(spark, f"{root}/{name}{suffix}", name, fmt, multi_line, typed) for name in SHEETS}


def read_optional(spark: SparkSession, path: str, fmt: str = "parquet", multi_line: bool = False) -> DataFrame | None:
    """A table that may not have been produced yet; absent means a warning, not an error."""
    try:
        return _read(spark, path, fmt, multi_line)
    except FileNotFoundError:
        log.warning("%s not found, its target stays empty", path)
        return None


def land(sheets: Mapping[str, DataFrame], root: str) -> WrittenTables:
    """Write every sheet to ``root/<name>`` as Parquet and return the landed tables."""
    return write_tables({name: trim_headers(df) for name, df in sheets.items()}, root)


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table; tables that were written by this library are not read for it."""
    if isinstance(tables, WrittenTables):
        rows = [(name, tables.row_counts[name], len(df.columns)) for name, df in tables.items()]
        return session_of(tables).createDataFrame(rows, "table string, row_count bigint, column_count int")
    return stack_rows([
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table"), "row_count", F.lit(len(df.columns)).alias("column_count")
        )
        for name, df in tables.items()
    ])


def write_csv(df: DataFrame, path: str, line_sep: str = "\n", order_by: Sequence[str] = ()) -> None:
    """CSV with a header, as a folder of parts; every part carries the header.

    ``order_by`` deals the rows over the parts by range and sorts each, so that the parts in the order
    of their names are sorted as a whole. Give it a written table, which is read twice.
    """
    if order_by:
        df = df.repartitionByRange(*[named(c) for c in order_by]).sortWithinPartitions(*[named(c) for c in order_by])
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("lineSep", line_sep)
        .options(**QUOTING)
        .option("maxRecordsPerFile", EXPORT_ROWS_PER_FILE)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """What ``write_csv`` wrote, all columns as text; ``multi_line`` as in ``read_sheet``."""
    return _read(spark, path, "csv", multi_line)


def null_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows and nulls per column, in one scan."""
    held = [F.struct(F.lit(c).alias("column"), F.count_if(named(c).isNull()).alias("null_count")) for c in df.columns]
    counts = df.agg(F.count("*").alias("row_count"), F.array(*held).alias("held"))
    return counts.select(F.lit(name).alias("table"), "row_count", F.inline("held"))


def export_for_bi(tables: Mapping[str, DataFrame], root: str) -> None:
    """CRLF CSV per warehouse table, flags as 0/1 as the BI tool expects."""

    def write(name: str, df: DataFrame) -> None:
        flat = [
            named(f.name).cast("int").alias(f.name) if f.dataType.simpleString() == "boolean" else named(f.name)
            for f in df.schema
        ]
        write_csv(df.select(*flat), f"{root}/{name}", "\r\n")

    run_together([lambda n=n, df=df: write(n, df) for n, df in tables.items()])


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Append to a relational table; needs the database's JDBC driver on the classpath."""
    df.write.jdbc(url, table, mode="append", properties=properties)


# -- folders, wherever Spark's paths lead --------------------------------------
def _folder(spark: SparkSession, path: str):
    """The path's file system and the path, as Spark's own readers resolve them."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    system, at = _folder(spark, path)
    return system.exists(at)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of the files in a folder; 0 if there is none."""
    fs, at = _folder(spark, path)
    return fs.getContentSummary(at).getLength() if fs.exists(at) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    system, at = _folder(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def rename(spark: SparkSession, old: str, new: str) -> None:
    system, at = _folder(spark, old)
    if not system.rename(at, _folder(spark, new)[1]):
        raise OSError(f"could not rename {old} to {new}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made, if it is there."""
    system, at = _folder(spark, path)
    system.delete(at, True)
