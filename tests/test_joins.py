"""Cardinality guards, salted joins and adaptive splitting."""

import random
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens.operators import joins
from orderlens.operators.joins import fanout_left_join, guard_unique, hot_keys
from orderlens.plans import marts
from orderlens.queries import queries


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("rows_per_task", [1, 3, 10, 10_000])
def test_fanout_join_equals_a_left_join(spark, rows_per_task):
    rng = random.Random(rows_per_task)
    left = [(rng.choice([None, *range(12)]), rng.randint(0, 2), i) for i in range(40)]
    # A third of the right rows share one key; exact copies are among them.
    right = [(3 if i % 3 == 0 else rng.choice([None, *range(9)]), rng.randint(0, 2), i % 7) for i in range(300)]
    a = spark.createDataFrame(left, "k int, j int, x int")
    b = spark.createDataFrame(right, "k int, j int, y int").repartition(5)
    assert bag(fanout_left_join(a, b, ["k", "j"], b.columns, rows_per_task)) == bag(a.join(b, ["k", "j"], "left"))


def test_fanout_join_spreads_a_hot_key(spark):
    """The largest (key, salt) group stays near the bound, copies of one row included."""
    hot = spark.range(0, 30_000, 1, 8).select(F.lit(1).alias("k"), F.lit(0).alias("y"))
    distinct = spark.range(0, 30_000, 1, 8).select(F.lit(2).alias("k"), F.col("id").cast("int").alias("y"))
    left = spark.createDataFrame([(1,), (2,), (9,)], "k int")
    joined = fanout_left_join(left, hot.unionByName(distinct), ["k"], hot.columns, rows_per_task=5_000)
    sizes = joined.groupBy("k").count()
    assert sorted(tuple(r) for r in sizes.collect()) == [(1, 30_000), (2, 30_000), (9, 1)]
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_salt" in plan and "spark_partition_id" in plan.lower()


@pytest.mark.parametrize("rows_per_task", [1, 3, 10, 10_000])
def test_fanout_join_with_hot_keys_apart_equals_a_left_join(spark, rows_per_task):
    rng = random.Random(rows_per_task)
    left = [(rng.choice([None, *range(12)]), rng.randint(0, 2), i) for i in range(40)]
    right = [(3 if i % 3 == 0 else rng.choice([None, *range(9)]), rng.randint(0, 2), i % 7) for i in range(300)]
    a = spark.createDataFrame(left, "k int, j int, x int")
    b = spark.createDataFrame(right, "k int, j int, y int").repartition(5)
    assert bag(fanout_left_join(a, b, ["k", "j"], b.columns, rows_per_task, apart=True)) == bag(a.join(b, ["k", "j"], "left"))


@pytest.mark.parametrize("groups", [1, 4, 1 << 14])
def test_hot_keys_are_counted_exactly(spark, monkeypatch, groups):
    """Whichever keys share a group."""
    monkeypatch.setattr(joins, "KEY_GROUPS", groups)
    rows = spark.range(0, 1000, 1, 4).select(F.expr("CAST(sqrt(id) AS int)").alias("k"), (F.col("id") % 2).alias("j"))
    exact = Counter({tuple(r): 1 for r in rows.groupBy("k", "j").count().where("count > 20").collect()})
    assert len(exact) > 10 and bag(hot_keys(rows, ["k", "j"], 20)) == exact
    assert hot_keys(rows, ["k", "j"], 1000).count() == 0


def test_hot_keys_are_looked_for_without_shuffling_keys(spark):
    """Distinct keys reach the count as no more rows than there are groups."""
    rows = spark.range(0, 200_000, 1, 2).select(F.col("id").alias("k"))
    found = hot_keys(rows, ["k"], 1000)
    assert found.count() == 0
    plan = executed_plan(found)
    assert "LocalTableScan <empty>" in plan or "EmptyRelation" in plan


def split_small_partitions(spark):
    """Settings under which test data counts as skewed; returns the undo."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    return lambda: [spark.conf.set(k, v) if v is not None else spark.conf.unset(k) for k, v in before.items()]


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_header_is_split_by_adaptive_execution(spark):
    """A guarded many-to-one join stays a join that Spark can split."""
    restore = split_small_partitions(spark)
    try:
        items = spark.range(0, 200_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5_000).alias("delivery_id"),
            F.col("id").alias("item_number"), F.rand(3).alias("weight"),
        )
        headers = spark.range(5_000).select(F.col("id").alias("delivery_id"), (F.col("id") % 9).alias("route"),
                                            F.lit(1).alias("order_id"), F.lit(1).alias("customer_id"))
        joined = marts.delivery_items(items, headers)
        out = joined.agg(F.count("*"), F.count("route"), F.max("weight") < 1)
        assert "skew=true" in executed_plan(out)
        assert tuple(out.first()) == (200_000, 200_000, True)
    finally:
        restore()


MANY = [(1, 10), (2, 20), (2, 21), (3, 30)]


def guarded(spark, one_rows):
    one = spark.createDataFrame(one_rows, "k int, v string")
    many = spark.createDataFrame(MANY, "k int, x int")
    joined = many.join(one, "k", "left").withColumn("big", F.col("x") > 15)
    return guard_unique(joined, one, ["k"], "many to one")


@pytest.mark.parametrize("use", [
    lambda df: df.count(),
    lambda df: df.select("x").collect(),
    lambda df: df.where("big IS NOT NULL").count(),
    lambda df: df.where("v IS NULL").collect(),
    lambda df: df.where("x > 1000").count(),
    lambda df: df.groupBy("big").count().collect(),
])
def test_guard_raises_however_the_result_is_used(spark, use):
    with pytest.raises(PySparkException, match="many to one: key .k. repeats"):
        use(guarded(spark, [(1, "a"), (1, "b"), (2, "c")]))


def test_guard_counts_null_keys_as_equal(spark):
    with pytest.raises(PySparkException, match="repeats"):
        guarded(spark, [(None, "a"), (None, "b")]).count()


def test_guard_adds_nothing_when_it_holds(spark):
    df = guarded(spark, [(1, "a"), (2, "c"), (None, "d")])
    assert bag(df) == Counter({(1, 10, "a", False): 1, (2, 20, "c", True): 1, (2, 21, "c", True): 1, (3, 30, None, True): 1})


def test_on_time_verdicts_are_the_flags_of_the_analytics(spark, sheets):
    built = marts.Marts(sheets)
    flags = built.delivery_analytics.select("order_id", "item_number", "on_time").where("on_time IS NOT NULL")
    assert flags.count() and bag(built.on_time_verdicts.where("on_time IS NOT NULL")) == bag(flags)


def test_on_time_rate_reads_keys_and_dates_only(spark, tmp_path):
    """KPI 9 scans the lines twice, and leaves quantities, prices and parts unread."""
    root = str(tmp_path)
    spark.sql(
        "SELECT 1L AS o_orderkey, 2L AS o_custkey, DATE'2024-01-01' AS o_orderdate, '1' AS o_orderpriority, 'F' AS o_orderstatus"
    ).write.parquet(f"{root}/orders.parquet")
    spark.sql(
        "SELECT 1L AS l_orderkey, 1 AS l_linenumber, 3L AS l_partkey, 4L AS l_suppkey, 1D AS l_quantity, 2D AS l_extendedprice,"
        " 'F' AS l_linestatus, 'N' AS l_returnflag, DATE'2024-01-09' AS l_shipdate"
    ).write.parquet(f"{root}/lineitem.parquet")
    rate = queries()["kpi09_on_time_rate"](spark, root)
    assert tuple(rate.first()) == (100.0, 1)
    plan = rate._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation [l_orderkey") <= 2
    assert not any(name in plan.executedPlan().toString() for name in ("l_quantity", "l_extendedprice", "l_partkey"))


def test_duplicate_headers_fail_the_marts(spark, sheets):
    doubled = dict(sheets) | {"VBAK": sheets["VBAK"].unionByName(sheets["VBAK"])}
    for build in ("order_items", "item_delivery_performance", "order_summary", "on_time_verdicts"):
        with pytest.raises(PySparkException, match="order header to item"):
            getattr(marts.Marts(doubled), build).collect()
