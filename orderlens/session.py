"""Session settings and the shared work folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution is what splits a hot join key at run time. Forcing it lets
# Spark add a shuffle after the join rather than leave one task with the key.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the plans rely on to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


# What a task of the relational queries holds is bounded by what it reads: sorts and hash tables keep a multiple
# of it, as columns are compressed. So files are read and shuffles are dealt in parts of a bounded size, however
# large the tables are.
TASK_BYTES = 16 << 20


def bounded_tasks(spark: SparkSession, table_bytes: int) -> SparkSession:
    """Settings for tasks of about TASK_BYTES over tables of ``table_bytes``; smaller settings of the session stay.

    Shuffles start with that many parts, and adaptive execution puts small ones together.
    """
    for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
        spark.conf.set(key, str(min(_bytes(spark.conf.get(key)), TASK_BYTES)))
    wanted = -(-2 * table_bytes // TASK_BYTES)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(max(wanted, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    return spark


def parts_of_shuffles(spark: SparkSession) -> int:
    """Parts that Spark deals a shuffle in before it puts small ones together."""
    return int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def _bytes(size: str) -> int:
    """A size as Spark's settings write it."""
    number, unit = re.fullmatch(r"(\d+)([kmgt]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgt".index(unit or " ")


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("orderlens")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Recording the call site of every column operation costs more than small queries do.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A local session without one gets a temporary folder; a cluster session
    without one is an error, since a machine-local folder would lose data with
    its machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="orderlens-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


T = TypeVar("T")

# Jobs submitted at a time; one job's last tasks leave cores that the next one fills.
_JOBS_TOGETHER = 4


def run_together(jobs: Iterable[Callable[[], T]]) -> list[T]:
    """Submit independent Spark jobs side by side; results in order, first error raised."""
    with ThreadPoolExecutor(_JOBS_TOGETHER) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def materialize(df: DataFrame, label: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back, cutting its lineage.

    Unlike a cache this survives lost executors, and later readers prune columns. Large tables are
    smaller under the codec zstd.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, key: str, parts: int, label: str) -> DataFrame:
    """As ``materialize``, in ``parts`` buckets of ``key``: who groups or joins by it reads rows that lie together.

    A bucket is one task's, so this is for rows of which no key holds too many for a task. Rows that come dealt over
    ``parts`` by ``key`` make one file a bucket. The table is known to the returned DataFrame only.
    """
    spark = df.sparkSession
    table = f"orderlens_{label}_{uuid.uuid4().hex}"
    path = work_path(spark, label)
    df.write.bucketBy(parts, key).sortBy(key).option("compression", "zstd").saveAsTable(table, format="parquet", path=path)
    written = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # its folder is not its own, so it stays
    return written
