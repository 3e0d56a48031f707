from pyspark.sql import functions as F

from orderlens.operators import numbering
from orderlens.operators.numbering import dense_ids
from orderlens.session import materialize


def test_ids_follow_the_order_without_gaps(spark):
    rows = spark.range(0, 20_000, 1, 6).select(
        (F.col("id") * 7919 % 20_000).alias("a"), F.when(F.col("id") % 5 != 0, F.col("id") % 3).alias("b")
    )
    out = dense_ids(rows, ["a", "b"], "n").orderBy("n").collect()
    assert [r["n"] for r in out] == list(range(1, 20_001))
    assert [r["a"] for r in out] == sorted(r["a"] for r in out)


def test_a_hot_leading_key_is_spread(spark):
    """One leading key with all the rows still uses several partitions."""
    rows = spark.range(0, 20_000, 1, 6).select(F.lit(1).alias("a"), F.col("id").alias("b"))
    ranged = rows.repartitionByRange(4, "a", "b").groupBy(F.spark_partition_id()).count().collect()
    assert len(ranged) == 4 and max(r["count"] for r in ranged) < 8_000
    out = dense_ids(rows, ["a", "b"], "n")
    assert out.where(F.col("n") != F.col("b") + 1).count() == 0


def test_the_rows_are_written_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(numbering, "materialize", lambda df, label: written.append(label) or materialize(df, label))
    joined = spark.range(5_000).join(spark.range(0, 5_000, 3).withColumnRenamed("id", "b"), F.col("id") == F.col("b"))
    out = dense_ids(joined, ["id"], "n").orderBy("n").collect()
    assert written == ["ids"]
    assert [(r["n"], r["id"]) for r in out] == [(k + 1, 3 * k) for k in range(1667)]


def test_ids_count_on_and_nulls_come_first(spark):
    rows = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    out = dense_ids(rows, ["a"], "n", after=100)
    assert sorted(tuple(r) for r in out.collect()) == [(101, None), (102, 1), (103, 2)]


def test_empty(spark):
    assert dense_ids(spark.createDataFrame([], "a int"), ["a"], "n").count() == 0
