"""Loads that are seen whole or not at all.

The rows of a load are first written to folders of its own, which no table shows. Once all are written and
checked, the tables are moved to them one after the other: a replacing load points a table to its new folder,
an appending one renames a folder inside the table's from a hidden name to a plain one. Both are quick steps on
names that touch no rows. Before the first of them the load writes down what each table showed, so that a
failure between two steps is undone at once, and a driver that dies there is undone by the next load. One load
may run on a database at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import named
from orderlens.schema import table_columns
from orderlens.session import run_together
from orderlens.sources import files

_STEP = "table string, append boolean, before string, staged string, row_count bigint"


def _detail(spark: SparkSession, statement: str, key: str, name: str, value: str) -> str:
    return spark.sql(statement).where(F.col(key) == name).select(value).first()[0]


def table_location(spark: SparkSession, table: str) -> str:
    return _detail(spark, f"DESCRIBE EXTENDED {table}", "col_name", "Location", "data_type")


def database_location(spark: SparkSession, database: str) -> str:
    return _detail(spark, f"DESCRIBE DATABASE {database}", "info_name", "Location", "info_value")


def _columns(name: str) -> str:
    return ", ".join(f"{c} {t}" for c, t in table_columns(name))


@dataclass(frozen=True)
class Step:
    """What publishing does to one table: ``before`` is the folder that it showed, ``staged`` the load's own."""

    table: str
    append: bool
    before: str
    staged: str
    row_count: int = 0

    @property
    def shown(self) -> str:
        """Where an appended folder is seen."""
        folder, _, hidden = self.staged.rpartition("/")
        return f"{folder}/{hidden.removeprefix('_')}"

    def publish(self, spark: SparkSession) -> None:
        if self.append:
            files.rename(spark, self.staged, self.shown)
        else:
            spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{self.staged}'")
        spark.catalog.refreshTable(self.table)

    def undo(self, spark: SparkSession) -> None:
        """Back to what the table showed, whether this step was done or not."""
        if not self.append:
            spark.sql(f"ALTER TABLE {self.table} SET LOCATION '{self.before}'")
        elif files.exists(spark, self.shown):
            files.rename(spark, self.shown, self.staged)
        spark.catalog.refreshTable(self.table)


@dataclass
class StagedLoad:
    """One load: ``stage`` its rows, look at ``rows``, then ``publish`` or ``discard``."""

    spark: SparkSession
    database: str
    append: bool
    id: str = field(default_factory=lambda: uuid.uuid4().hex)
    steps: list[Step] = field(default_factory=list)
    rows: dict[str, DataFrame] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.log = f"{database_location(self.spark, self.database)}/loads/{self.id}"

    def _target(self, name: str) -> Step:
        before = table_location(self.spark, f"{self.database}.{name}")
        folder = f"{before}/_{self.id}" if self.append else f"{before.rpartition('/')[0]}/{name}-{self.id}"
        return Step(f"{self.database}.{name}", self.append, before, folder)

    def _staging_table(self, name: str) -> str:
        return f"{self.database}.staged_{self.id}_{name}"

    def stage(self, coming: Mapping[str, DataFrame]) -> None:
        """Write the tables' rows under their declared types and lengths; each is counted as it is written."""
        targets = {name: self._target(name) for name in coming}
        self.steps = list(targets.values())

        def write(name: str, df: DataFrame) -> Step:
            step, counted = targets[name], Observation()
            self.spark.sql(f"CREATE TABLE {self._staging_table(name)} ({_columns(name)}) USING parquet "
                           f"OPTIONS (compression 'zstd') LOCATION '{step.staged}'")
            chosen = df.select(*[named(c) for c, _ in table_columns(name)])
            chosen.observe(counted, F.count("*").alias("n")).write.insertInto(self._staging_table(name))
            return Step(step.table, step.append, step.before, step.staged, counted.get["n"])

        self.steps = run_together([lambda n=n, df=df: write(n, df) for n, df in coming.items()])
        self.rows = {name: self.spark.table(self._staging_table(name)) for name in coming}

    def publish(self) -> None:
        """Show the staged rows in all tables; if one cannot be moved, all show what they did."""
        _write_down(self.spark, self.steps, f"{self.log}/planned")
        done: list[Step] = []
        try:
            for step in self.steps:
                done.append(step)
                step.publish(self.spark)
        except Exception:
            for step in reversed(done):
                step.undo(self.spark)
            _write_down(self.spark, self.steps, f"{self.log}/undone")
            raise
        _write_down(self.spark, self.steps, f"{self.log}/published")
        self._forget()

    def discard(self) -> None:
        """Remove what was staged; no table ever showed it."""
        self._forget()
        for step in self.steps:
            files.remove(self.spark, step.staged)

    def _forget(self) -> None:
        for step in self.steps:
            name = step.table.rpartition(".")[2]
            self.spark.sql(f"DROP TABLE IF EXISTS {self._staging_table(name)}")  # its folder is not its own, so it stays


def _write_down(spark: SparkSession, steps: list[Step], path: str) -> None:
    rows = [(s.table, s.append, s.before, s.staged, s.row_count) for s in steps]
    spark.createDataFrame(rows, _STEP).coalesce(1).write.json(path)


def _loads(spark: SparkSession, database: str) -> list[str]:
    root = f"{database_location(spark, database)}/loads"
    return [f"{root}/{name}" for name in files.children(spark, root)]


def recover(spark: SparkSession, database: str) -> list[str]:
    """Undo loads that were neither published nor undone, such as those whose driver died; returns their ids."""
    broken = []
    for log in _loads(spark, database):
        states = set(files.children(spark, log))
        # A record is whole once Spark has marked it so; before that no table was touched.
        if "planned" not in states or states & {"published", "undone"} or not files.exists(spark, f"{log}/planned/_SUCCESS"):
            continue
        steps = [Step(*row) for row in spark.read.schema(_STEP).json(f"{log}/planned").collect()]
        for step in steps:
            step.undo(spark)
        _write_down(spark, steps, f"{log}/undone")
        broken.append(log.rpartition("/")[2])
    return broken


def published_rows(spark: SparkSession, database: str) -> DataFrame:
    """(table, row_count, load_id) of every published load, as counted when the rows were written."""
    logs = [log for log in _loads(spark, database) if files.exists(spark, f"{log}/published/_SUCCESS")]
    frames = [
        spark.read.schema(_STEP).json(f"{log}/published").select(
            F.substring_index("table", ".", -1).alias("table"), "row_count", F.lit(log.rpartition("/")[2]).alias("load_id")
        )
        for log in logs
    ]
    return reduce(DataFrame.unionByName, frames, spark.createDataFrame([], "table string, row_count bigint, load_id string"))
