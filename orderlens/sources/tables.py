"""A named set of tables whose plans are built on first use."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from orderlens.session import materialize, run_together


class WrittenTables(dict[str, DataFrame]):
    """Tables read back from where they were written; ``row_counts`` are those of the writes."""

    def __init__(self, tables: Mapping[str, DataFrame], row_counts: Mapping[str, int]) -> None:
        super().__init__(tables)
        self.row_counts = dict(row_counts)

    def __or__(self, other: WrittenTables) -> WrittenTables:
        return WrittenTables({**self, **other}, self.row_counts | other.row_counts)


def write_tables(tables: Mapping[str, DataFrame], root: str) -> WrittenTables:
    """Write every table to ``root/<name>`` as Parquet, side by side, and read it back.

    Rows are counted by the tasks that write them, so nobody has to read a table again for its size.
    Only the last stage of a job counts, whose tasks add what they saw once, however often they are run.
    """
    spark = session_of(tables)

    def write(name: str, df: DataFrame) -> tuple[DataFrame, int]:
        counted = Observation()
        df.observe(counted, F.count("*").alias("n")).write.mode("overwrite").parquet(f"{root}/{name}", compression="zstd")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}"), counted.get["n"]

    written = run_together([lambda n=n, df=df: write(n, df) for n, df in tables.items()])
    return WrittenTables(
        {name: df for name, (df, _) in zip(tables, written)}, {name: n for name, (_, n) in zip(tables, written)}
    )


class LazyTables(Mapping[str, DataFrame]):
    def __init__(self, makers: dict[str, Callable[[], DataFrame]]) -> None:
        self._makers = makers
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._makers[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def replace(self, **makers: Callable[[], DataFrame]) -> LazyTables:
        return LazyTables(self._makers | makers)

    def landed(self, *names: str) -> LazyTables:
        """The same tables, ``names`` written to the shared folder now.

        For jobs that read a derived table several times: it is derived once, and every
        reader then scans only the columns it needs.
        """
        written = run_together([lambda df=self[n], n=n: materialize(df, n, "zstd") for n in names])
        return self.replace(**{n: lambda df=df: df for n, df in zip(names, written)})


def session_of(tables: Mapping[str, DataFrame]) -> SparkSession:
    return next(iter(tables.values())).sparkSession
