"""Loads are seen whole or not at all; appended batches are checked by their own keys."""

import logging
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderlens.operators import numbering
from orderlens.operators.joins import held_keys, orphan_rows, orphan_values, reference_gaps
from orderlens.plans import quality, staging, warehouse
from orderlens.schema import FOREIGN_KEYS, LOAD_ORDER, PRIMARY_KEYS, table_columns
from orderlens.session import materialize, work_path


def contents(spark, database):
    return {n: Counter(map(tuple, spark.table(f"{database}.{n}").collect())) for n in LOAD_ORDER}


def orders(sheets, shift):
    """The sheets as another batch: order, delivery and shipment numbers moved on, masters without rows."""
    moved = {"Sales Document", "Delivery Number", "Shipment Number"}
    out = {n: df.select(*[(F.col(f"`{c}`") + shift).cast(t).alias(c) if c in moved else F.col(f"`{c}`") for c, t in df.dtypes]) for n, df in sheets.items()}
    return out | {n: sheets[n].limit(0) for n in ("KNA1", "LFA1")}


def wrong(sheets, kind):
    if kind == "number":
        bad = sheets["VBAP"].withColumn("Quantity", F.when(F.col("Item Number") == 20, F.lit("1" + "0" * 17)).otherwise(F.lit("7")))
        return sheets | {"VBAP": bad}
    return sheets | {"VTTK": sheets["VTTK"].withColumn("Carrier", F.lit("x" * 51))}


@pytest.fixture(scope="module")
def base(spark, sheets):
    """A loaded database that failing loads must leave alone, and what it holds."""
    warehouse.load(sheets, "base_dw")
    return "base_dw", contents(spark, "base_dw")


@pytest.mark.parametrize("kind, append, message", [
    ("number", False, r"fact_order_item\.order_quantity DECIMAL\(18,3\)"),
    ("length", True, r"fact_shipment\.carrier_name VARCHAR\(50\)"),
])
def test_a_value_that_does_not_fit_leaves_all_tables(spark, sheets, base, kind, append, message):
    database, before = base
    more = orders(sheets, 10**9) if append else dict(sheets)
    extra = more["VBAK"].limit(1).withColumn("Sales Document", F.lit(5).cast("bigint"))
    with pytest.raises(ValueError, match=f"values that do not fit: .*{message}"):
        warehouse.load(wrong(more | {"VBAK": more["VBAK"].unionByName(extra)}, kind), database, append=append)
    assert contents(spark, database) == before
    assert {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()} == set(LOAD_ORDER)


class Died(BaseException):
    """The driver's end: nothing that handles errors sees it."""


@pytest.mark.parametrize("append", [False, True])
@pytest.mark.parametrize("error", [OSError, Died])
def test_a_load_that_ends_between_two_tables_is_undone(spark, sheets, base, monkeypatch, append, error):
    (database, before), publish = base, staging.Step.publish

    def stuck(step, session):
        if step.table.endswith("fact_delivery_item"):
            raise error("no such luck")
        publish(step, session)

    monkeypatch.setattr(staging.Step, "publish", stuck)
    with pytest.raises(error, match="no such luck"):
        warehouse.load(orders(sheets, 10**9), database, append=append, validate=False, with_analytics=False)
    assert (contents(spark, database) == before) == (error is OSError)
    assert len(staging.recover(spark, database)) == (error is Died)
    assert contents(spark, database) == before and staging.recover(spark, database) == []


def test_analytics_come_from_where_they_were_written_or_not_at_all(spark, sheets, caplog):
    path = work_path(spark, "analytics")
    with caplog.at_level(logging.WARNING):
        assert warehouse.load(sheets, "optional_dw", analytics=path)["fact_delivery_analytics"].count() == 0
    assert path in caplog.text
    warehouse.table(sheets, "fact_delivery_analytics").drop("analytics_id").write.parquet(path)
    loaded = warehouse.load(sheets, "optional_dw", analytics=path)["fact_delivery_analytics"]
    assert sorted(map(tuple, loaded.collect())) == sorted(map(tuple, warehouse.table(sheets, "fact_delivery_analytics").collect()))


def test_appended_batches_are_checked_against_what_is_held(spark, sheets):
    warehouse.load(sheets, "batches_dw")
    batch = orders(sheets, 10**9)
    loaded = warehouse.load(batch, "batches_dw", append=True)
    written = staging.published_rows(spark, "batches_dw").groupBy("table").agg(F.sum("row_count").alias("n"))
    assert {r["table"]: r["n"] for r in written.collect()} == {n: df.count() for n, df in loaded.items()}
    assert not quality.foreign_key_violations(loaded).where("violating_rows > 0").count()
    assert not quality.primary_key_violations(loaded).where("duplicate_rows + null_key_rows > 0").count()
    before = contents(spark, "batches_dw")
    with pytest.raises(ValueError, match=r"fact_order primary key: \d+ keys are there already"):
        warehouse.load(batch, "batches_dw", append=True)
    strangers = orders(sheets, 2 * 10**9)
    strangers["VBAK"] = strangers["VBAK"].withColumn("Customer ID", F.lit("nobody"))
    with pytest.raises(ValueError, match=r"fact_order\(customer_id\) -> dim_customer: 22 rows"):
        warehouse.load(strangers, "batches_dw", append=True, with_analytics=False)
    assert contents(spark, "batches_dw") == before


def test_an_appended_batch_reads_keys_only_and_shuffles_nothing_held(spark):
    held = materialize(spark.range(100_000).select(F.col("id").alias("order_id"), F.lit("x" * 50).alias("payload")), "held")
    coming = materialize(spark.createDataFrame([(5,), (7,), (10**6,)], "order_id bigint"), "coming")
    found = held_keys(held, coming, ["order_id"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["order_id"] for r in found.collect()) == [5, 7]
    assert "payload" not in plan and "LeftSemi" in plan and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert held_keys(held, coming.limit(0), ["order_id"]).count() == 0


def test_reference_gaps_equal_joins_per_rule(spark):
    import random

    rng = random.Random(4)
    tables = {n: spark.createDataFrame([(rng.choice([None, *range(hi)]), rng.randrange(3)) for _ in range(size)] + [(1, 1)] * hot, "k int, j int").repartition(3)
              for n, hi, size, hot in (("a", 30, 60, 500), ("b", 25, 20, 0), ("c", 12, 30, 0), ("d", 5, 0, 0))}
    rules = [("a", ["b"]), ("b", ["a"]), ("c", ["d"]), ("a", ["b", "c"]), ("d", ["a"])]
    for keys in (["k"], ["k", "j"]):
        got = {(r["child"], r["parents"]): (r["orphan_values"], r["orphan_rows"]) for r in reference_gaps({n: (df, keys) for n, df in tables.items()}, rules).collect()}
        for child, parents in rules:
            known = tables[parents[0]].select(*keys)
            for more in parents[1:]:
                known = known.union(tables[more].select(*keys))
            lost = orphan_rows(tables[child], keys, known).collect()
            assert got[child, ",".join(parents)] == (len(lost), sum(r["n"] for r in lost))
    strict = reference_gaps({n: (df, ["k"]) for n, df in tables.items()}, [("a", ["b"])], null_is_orphan=True).first()
    assert strict["orphan_values"] == orphan_values(tables["a"], "k", tables["b"], "k", null_is_orphan=True).count()


def test_rules_on_one_parent_share_a_grouping(spark, sheets):
    tables = {n: materialize(df, n) for n, df in warehouse.tables(sheets).items()}
    plan = quality.foreign_key_violations(tables)._jdf.queryExecution().executedPlan().toString()
    parents = {(parent, keys) for _, keys, parent in FOREIGN_KEYS}
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == len(parents) < 8 and "Join" not in plan
    assert all(r["violating_rows"] == 0 for r in quality.foreign_key_violations(tables).collect()) and PRIMARY_KEYS


def test_staged_files_are_small(spark, sheets, monkeypatch):
    """Staged rows are written with zstd, and ids without the columns that only put them in order."""
    held = []
    monkeypatch.setattr(numbering, "materialize", lambda df, label: held.append(df.columns) or materialize(df, label))
    loaded = warehouse.load(sheets, "small_dw")
    assert held == [[*[c for c, _ in table_columns("fact_delivery_analytics")][1:], "_at"]]
    for name, df in loaded.items():
        assert df.count() and all("zstd" in path for path in df.inputFiles()), name
