"""Files in and out, and the warehouse tables."""

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderlens import session
from orderlens.plans import quality, warehouse
from orderlens.schema import LOAD_ORDER, SHEETS, table_columns
from orderlens.session import shared_dir, work_path
from orderlens.sources import files
from orderlens.sources.bridge import Bridge
from tests.fixture_sheets import rows


@pytest.fixture(scope="module")
def csv_root(tmp_path_factory):
    """The golden sheets as CSV files, headers padded with blanks."""
    root = tmp_path_factory.mktemp("csv")
    for sheet, data in rows().items():
        with open(root / f"{sheet}.csv", "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow([f" {h} " for h in SHEETS[sheet].headers])
            out.writerows(data)
    return str(root)


def test_csv_sheets_equal_the_typed_ones(spark, sheets, csv_root):
    read = files.read_sheets(spark, csv_root)
    for name, df in sheets.items():
        assert read[name].dtypes == df.dtypes
        assert sorted(map(str, read[name].collect())) == sorted(map(str, df.collect())), name


def test_codes_survive_as_text(spark, csv_root):
    row = files.read_sheet(spark, f"{csv_root}/KNA1.csv", "KNA1").first()
    assert row["Postal Code"] == "00100" and row["Street Address"] == "1-1 Main, Street"


def test_missing_source_fails_early(spark, csv_root):
    with pytest.raises(FileNotFoundError, match="nowhere"):
        files.read_sheet(spark, f"{csv_root}/nowhere.csv", "KNA1")
    with pytest.raises(ValueError, match="missing columns"):
        files.read_sheet(spark, f"{csv_root}/KNA1.csv", "LFA1")


def test_optional_source(spark, csv_root, caplog):
    assert files.read_optional(spark, f"{csv_root}/nowhere", "csv") is None
    assert "nowhere" in caplog.text
    assert files.read_optional(spark, f"{csv_root}/VBAK.csv", "csv").count() == 22


def test_land_and_shape(spark, csv_root):
    root = work_path(spark, "landed")
    landed = files.land(files.read_sheets(spark, csv_root), root)
    assert sorted(tuple(r) for r in files.shape(landed).collect()) == sorted(
        (n, len(data), len(SHEETS[n].columns)) for n, data in rows().items()
    )
    assert files.read_sheet(spark, f"{root}/VBAP", "VBAP", "parquet").dtypes == landed["VBAP"].dtypes


def parts(root: str) -> list[bytes]:
    return [p.read_bytes() for p in Path(root.removeprefix("file:")).glob("part-*.csv")]


def test_bi_export_is_crlf_with_headers(spark, sheets):
    root = work_path(spark, "bi")
    tables = {n: warehouse.table(sheets, n) for n in ("dim_carrier", "fact_delivery_analytics")}
    files.export_for_bi(tables, root)
    carriers = parts(f"{root}/dim_carrier")
    assert carriers and all(p.startswith(b"carrier_name\r\n") for p in carriers)
    assert sorted(b"".join(p.split(b"\r\n", 1)[1] for p in carriers).split()) == [b"Carrier1", b"Carrier2", b"Carrier3"]
    lines = [line for p in parts(f"{root}/fact_delivery_analytics") for line in p.decode().split("\r\n")[1:] if line]
    assert sorted(lines, key=lambda s: int(s.split(",")[0]))[0] == "1,1000001,10,2001001,2,0,"


def test_plain_csv_uses_newlines(spark, sheets):
    path = work_path(spark, "csv")
    files.write_csv(sheets["VBAK"], path)
    assert all(b"\r" not in p for p in parts(path))
    assert spark.read.option("header", True).csv(path).count() == 22


def test_schema_matches_the_declared_tables(spark):
    warehouse.create_schema(spark, "schema_dw", work_path(spark, "schema_dw"))
    warehouse.create_schema(spark, "schema_dw", work_path(spark, "schema_dw"))
    made = spark.sql("SHOW TABLES IN schema_dw").where("NOT isTemporary").collect()
    assert {r["tableName"] for r in made} == set(LOAD_ORDER)
    for name in LOAD_ORDER:
        assert spark.table(f"schema_dw.{name}").columns == [c for c, _ in table_columns(name)]


def test_literal_insert_and_length_limit(spark):
    warehouse.create_schema(spark, "literal_dw", work_path(spark, "literal_dw"))
    spark.sql("INSERT INTO literal_dw.fact_delivery_analytics (order_id, item_number, delivery_time_days, on_time)"
              " VALUES (1, 10, 2, false), (1, 20, NULL, NULL)")
    inserted = spark.table("literal_dw.fact_delivery_analytics")
    assert inserted.where("analytics_id IS NULL AND delay_reason IS NULL").count() == 2
    numbered = warehouse.number_analytics(inserted.drop("analytics_id"))
    assert sorted((r["analytics_id"], r["item_number"]) for r in numbered.collect()) == [(1, 10), (2, 20)]
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH|exceeds"):
        spark.sql(f"INSERT INTO literal_dw.dim_carrier VALUES ('{'x' * 51}')")


def test_load_rejects_broken_keys(spark, sheets):
    orphaned = dict(sheets) | {"VBAK": sheets["VBAK"].where("`Sales Document` <> 1000002")}
    with pytest.raises(ValueError, match=r"fact_order_item\(order_id\) -> fact_order: 1 rows"):
        warehouse.load(orphaned, "orphan_dw")
    doubled = dict(sheets) | {"LFA1": sheets["LFA1"].unionByName(sheets["LFA1"])}
    with pytest.raises(ValueError, match="dim_vendor primary key: 60 duplicate"):
        warehouse.load(doubled, "double_dw", with_analytics=False)


def test_load_can_append_and_skip_analytics(spark, sheets):
    loaded = warehouse.load(sheets, "append_dw", with_analytics=False)
    assert loaded["fact_delivery_analytics"].count() == 0
    rows = spark.createDataFrame([(1000001, 10, 2001001, 2, False, None)],
                                 "order_id bigint, item_number int, shipment_id bigint, delivery_time_days int,"
                                 " on_time boolean, delay_reason string")
    for expected in (1, 2):
        loaded = warehouse.load(sheets, "append_dw", analytics=rows, append=True, validate=False)
        assert loaded["fact_delivery_analytics"].agg(F.max("analytics_id")).first()[0] == expected
    violations = {r["table"]: r["duplicate_rows"] for r in quality.primary_key_violations(loaded).collect()}
    assert violations["fact_order"] == 66 and violations["fact_delivery_analytics"] == 0


def test_shared_folder_is_the_configured_one(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == shared_dir(spark)
    assert work_path(spark, "x") != work_path(spark, "x")
    if configured is not None:
        assert configured.removeprefix("file:").rstrip("/") in shared_dir(spark)


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_a_rejected_load_leaves_the_tables(spark, sheets):
    warehouse.load(sheets, "kept_dw", with_analytics=False)
    doubled = dict(sheets) | {"LFA1": sheets["LFA1"].unionByName(sheets["LFA1"])}
    for append in (False, True):
        with pytest.raises(ValueError, match="dim_vendor primary key"):
            warehouse.load(doubled, "kept_dw", with_analytics=False, append=append)
        assert spark.table("kept_dw.dim_vendor").count() == 30


def test_csv_quotes_commas_and_line_breaks_round_trip(spark, sheets, tmp_path):
    rows = sheets["LFA1"].limit(2).withColumn("Vendor Name", F.lit('Acme "Best", Inc')).withColumn("City", F.lit("a\nb"))
    files.write_csv(rows, str(tmp_path / "LFA1.csv"))
    back = files.read_sheet(spark, str(tmp_path / "LFA1.csv"), "LFA1", multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.select(*back.columns).collect()))
    text = "".join(p.read_text() for p in (tmp_path / "LFA1.csv").glob("part-*"))
    assert '"Acme ""Best"", Inc"' in text


def test_suppliers_of_an_order_keep_their_own_deliveries(spark, tmp_path):
    line = "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_partkey bigint, l_quantity double, l_extendedprice double, l_linestatus string, l_returnflag string, l_shipdate date"
    day = date(2024, 1, 1)
    rows = [(7, 1, 5, 1, 1.0, 2.0, "F", "N", day), (7, 2, 10005, 1, 1.0, 2.0, "F", "N", day), (7, 3, 5, 1, 1.0, 2.0, "F", "N", day)]
    spark.createDataFrame(rows, line).write.parquet(str(tmp_path / "lineitem.parquet"))
    likp = Bridge(spark, str(tmp_path)).likp(with_order=False)
    assert sorted(r["Delivery Number"] for r in likp.collect()) == [70000, 70001]


def test_a_quoted_line_break_fails_and_names_the_option(spark, sheets, tmp_path):
    rows = sheets["LFA1"].limit(3).withColumn("City", F.lit('a "b"\nc'))
    files.write_csv(rows, str(tmp_path / "broken"))
    for use in (lambda df: df.count(), lambda df: df.select("Country").where("Country IS NULL").collect()):
        with pytest.raises(PySparkException, match="multi_line=True"):
            use(files.read_csv(spark, str(tmp_path / "broken")))
    assert files.read_csv(spark, str(tmp_path / "broken"), multi_line=True).where("City = 'a \"b\"\nc'").count() == 3


def test_quotes_within_a_line_pass(spark, sheets, tmp_path):
    rows = sheets["LFA1"].limit(3).withColumn("City", F.lit('"a", ""b""'))
    files.write_csv(rows, str(tmp_path / "plain"), "\r\n")
    assert files.read_csv(spark, str(tmp_path / "plain")).where("City = '\"a\", \"\"b\"\"'").count() == 3


def test_counts_come_from_the_write(spark, tmp_path):
    """Also of empty tables and of jobs with several stages; the files are not read for it."""
    made = {"none": spark.range(0), "some": spark.range(1000).repartition(7).groupBy((F.col("id") % 10).alias("k")).count()}
    written = files.land(made, str(tmp_path / "landed"))
    assert written.row_counts == {"none": 0, "some": 10}
    assert {n: df.count() for n, df in written.items()} == written.row_counts
    for part in (tmp_path / "landed" / "some").glob("part-*"):
        part.unlink()
    assert sorted(map(tuple, files.shape(written).collect())) == [("none", 0, 1), ("some", 10, 2)]


def test_sheets_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SHEETS", {"LFA1": files.SHEETS["LFA1"]})
    names = [c.header for c in files.SHEETS["LFA1"].columns]
    lines = [",".join(names)] + [",".join([str(k)] + ["x"] * (len(names) - 1)) for k in range(5000)]
    (tmp_path / "LFA1.csv").write_text("\n".join(lines) + "\n")
    whole = files.read_sheets(spark, str(tmp_path), typed=False, multi_line=True)["LFA1"]
    split = files.read_sheets(spark, str(tmp_path), typed=False)["LFA1"]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        tasks = lambda df: df.select(F.spark_partition_id().alias("task")).distinct().count()
        assert tasks(whole) == 1 < tasks(split)
        assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tasks_are_bounded_by_size_not_by_number(spark, tmp_path):
    """Larger tables get more parts, never larger ones; what the session has set smaller stays."""
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for own, then in (("64MB", 16 << 20), ("128m", 16 << 20), ("1g", 16 << 20), ("256k", 256 << 10), ("1000b", 1000)):
            for k in keys:
                spark.conf.set(k, own)
            session.bounded_tasks(spark, 0)
            assert [int(spark.conf.get(k)) for k in keys] == [then, then]
        assert int(spark.conf.get(parts)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
        session.bounded_tasks(spark, 10 * session.TASK_BYTES)
        assert int(spark.conf.get(parts)) == 20
        session.bounded_tasks(spark, 10_000 * session.TASK_BYTES)
        assert int(spark.conf.get(parts)) == 20_000
    finally:
        spark.conf.unset(parts)
        for k, v in before.items():
            spark.conf.set(k, v)
    spark.range(1000).write.parquet(f"{tmp_path}/t.parquet")
    assert files.size(spark, f"{tmp_path}/t.parquet") > 1000 and files.size(spark, f"{tmp_path}/none") == 0


def test_landed_sheets_equal_those_derived_alone(spark, tmp_path):
    """Finished lines are written once; orders that repeat or have no key, and lines without, give the same rows."""
    day = "timestamp'1995-03-02'"
    spark.sql(f"""SELECT * FROM VALUES (1, 7, 'F', 1.0, {day}, '1-A'), (1, 7, 'F', 1.0, {day}, '1-A'), (1, 8, 'O', 2.0, {day}, '2-B'),
        (2, NULL, 'P', 2.0, {day}, '2-B'), (NULL, 9, 'F', 3.0, {day}, '1-A') AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)
    """).write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"""SELECT k l_orderkey, p l_partkey, s l_suppkey, n l_linenumber, CAST(q AS double) l_quantity, 2.5D l_extendedprice, f l_returnflag,
        t l_linestatus, {day} + make_interval(0, 0, 0, q) l_shipdate FROM VALUES (1, 3, 5, 1, 4, 'N', 'F'), (1, 3, 5, 1, 6, 'A', 'F'), (1, 2, 4, 2, 1, 'R', 'F'),
        (1, 2, 5, 3, 1, 'R', 'F'), (2, 2, 4, 1, NULL, 'N', 'F'), (2, 2, 4, 2, 3, 'N', 'O'), (3, 1, 1, 1, 2, NULL, 'F'),
        (NULL, 1, 1, 1, 2, 'N', 'F'), (4, 1, NULL, NULL, 2, 'A', 'F') AS t(k, p, s, n, q, f, t)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    bridge = Bridge(spark, str(tmp_path))
    alone, landed = bridge.sheets(), bridge.landed_sheets("VBAP")
    for name in ("VBAP", "LIKP", "LIPS", "VTTK", "VTTP"):
        assert landed[name].dtypes == alone[name].dtypes
        assert sorted(map(repr, landed[name].collect())) == sorted(map(repr, alone[name].collect()))
        assert not any("lineitem" in path for path in landed[name].inputFiles())
    for one, other in (("LIPS", "VTTP"), ("LIKP", "VTTK")):
        assert set(landed[one].inputFiles()) == set(landed[other].inputFiles())


def test_landed_lines_lie_by_order(spark, tmp_path):
    """Readers put an order's rows together without an exchange, and hand its lines over once in each of two tables."""
    day = "timestamp'1995-03-02'"
    spark.sql(f"SELECT id o_orderkey, id % 7 o_custkey, 'F' o_orderstatus, 1D o_totalprice, {day} o_orderdate, '1' o_orderpriority FROM range(50)").write.parquet(f"{tmp_path}/orders.parquet")
    spark.sql(f"""SELECT id % 50 l_orderkey, id l_partkey, id % 3 l_suppkey, CAST(id % 4 AS int) l_linenumber, 1D l_quantity, 2D l_extendedprice, 'N' l_returnflag,
        'F' l_linestatus, {day} l_shipdate FROM range(400)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    tables = len(spark.catalog.listTables())
    landed = Bridge(spark, str(tmp_path)).landed_sheets("VBAP")
    assert len(spark.catalog.listTables()) == tables
    for name in ("VBAP", "LIKP", "LIPS", "VTTK", "VTTP"):
        per_order = landed[name].groupBy("Sales Document").count()
        assert per_order.count() == 50
        assert "hashpartitioning" not in per_order._jdf.queryExecution().executedPlan().toString()
    assert set(landed["LIKP"].inputFiles()) == set(landed["LIPS"].inputFiles())
