"""Null, duplicate and date rules on hand-made rows."""

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest

from orderlens.functions import joined_text, on_time
from orderlens.operators import checks
from orderlens.operators.conform import to_mart, to_table, trim_headers
from orderlens.operators.joins import orphan_rows, orphan_values, repeated_keys
from orderlens.plans import feeders, kpis, marts, quality, warehouse
from pyspark.sql import functions as F


def tuples(df):
    return [tuple(r) for r in df.collect()]


def issue(df):
    return {r["check"]: r["issue_count"] for r in df.collect()}


HEADERS = "order_id bigint, customer_id string, order_date date, order_status string"
ITEMS = "order_id bigint, item_number int, order_quantity decimal(18,3), requested_delivery_date date, product_id string"
DELIVERED = (
    "delivery_id bigint, item_number int, order_id bigint, sales_item int, delivered_quantity decimal(18,3),"
    " item_delivery_status string, delivery_date date"
)
SHIPPED = (
    "shipment_id bigint, order_id bigint, sales_item int, shipped_quantity decimal(18,3), item_shipment_status string"
)
D1, D2, D3 = date(2025, 2, 1), date(2025, 2, 2), date(2025, 2, 3)


def summary(spark, headers, items, delivered=(), shipped=()):
    df = marts.order_summary(
        spark.createDataFrame(headers, HEADERS), spark.createDataFrame(items, ITEMS),
        spark.createDataFrame(list(delivered), DELIVERED), spark.createDataFrame(list(shipped), SHIPPED),
    )
    return {r["order_id"]: r.asDict() for r in df.collect()}


def test_null_keys_and_null_quantities(spark):
    rows = summary(
        spark,
        [(1, "a", D1, "Open"), (None, "b", D1, "Open")],
        [(1, 10, None, D1, "p"), (1, 20, None, D1, "p"), (None, 10, Decimal(5), D1, "p")],
        [(7, 10, 1, 10, None, None, D1)],
    )
    assert list(rows) == [1]
    assert rows[1]["total_ordered_qty"] == 0 and rows[1]["total_order_items"] == 2
    assert rows[1]["total_delivered_qty"] == 0
    assert rows[1]["delivery_statuses"] == "" and rows[1]["shipment_statuses"] is None


def test_statuses_are_distinct_and_sorted(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("B",)], "s string")
    assert tuples(df.agg(joined_text(F.collect_list("s")))) == [("B, a, b",)]


def test_deliveries_of_an_order_are_counted_once_with_all_their_statuses(spark):
    rows = summary(
        spark, [(1, "a", D1, "Open")], [(1, 10, Decimal(9), D1, "p")],
        [(7, 1, 1, 10, Decimal(2), "b", D1), (7, 2, 1, 10, Decimal(3), "a", D1), (8, 1, 1, 10, Decimal(1), "b", D1), (None, 1, 1, 10, None, None, D1)],
    )
    assert (rows[1]["total_deliveries"], rows[1]["total_delivered_qty"], rows[1]["delivery_statuses"]) == (2, 6, "a, b")


def test_on_time_is_three_valued(spark):
    df = spark.createDataFrame([(D1, D1), (D2, D1), (D1, None), (None, D1), (None, None)], "d date, r date")
    assert [r[0] for r in df.select(on_time(F.col("d"), F.col("r"))).collect()] == [True, False, False, None, None]


def test_averages_skip_missing_verdicts(spark):
    items = [(1, n, Decimal(1), D2, "p") for n in (10, 20, 30)] + [(2, 10, Decimal(1), D2, "p")]
    delivered = [(7, 10, 1, 10, Decimal(1), "x", D1), (7, 20, 1, 20, Decimal(1), "x", D3)]
    rows = summary(spark, [(1, "a", D1, "Open"), (2, "a", D1, "Open")], items, delivered)
    assert rows[1]["pct_items_on_time_proxy"] == 0.5 and rows[1]["avg_delivery_gap_days"] == 0.0
    assert rows[2]["pct_items_on_time_proxy"] is None


def test_order_without_items(spark):
    headers = spark.createDataFrame([(1, "a", D1, "Open")], HEADERS)
    lines = marts.order_lines(headers, spark.createDataFrame([], ITEMS))
    assert [(r["order_id"], r["item_number"]) for r in lines.collect()] == [(1, None)]
    row = summary(spark, [(1, "a", D1, "Open")], [])[1]
    assert (row["total_order_items"], row["total_ordered_qty"], row["outstanding_qty"]) == (0, 0, 0)


def test_item_in_two_deliveries(spark):
    lines = spark.createDataFrame([(1, "a", 10, "p", D1)],
                                  "order_id bigint, customer_id string, item_number int, product_id string,"
                                  " requested_delivery_date date")
    delivered = [(7, 1, 1, 10, Decimal(2), "x", D1), (8, 1, 1, 10, Decimal(3), "x", D3)]
    df = spark.createDataFrame(delivered, DELIVERED)
    performance = sorted(tuples(marts.item_delivery_performance(lines, df).select("delivery_gap_days", "on_time_proxy")))
    assert performance == [(0, True), (2, False)]
    row = summary(spark, [(1, "a", D1, "Open")], [(1, 10, Decimal(6), D1, "p")], delivered)[1]
    assert (row["total_ordered_qty"], row["total_delivered_qty"], row["outstanding_qty"]) == (6, 5, 1)
    assert row["total_deliveries"] == 2


def test_sales_item_links_a_delivery_not_its_item_number(spark):
    lines = spark.createDataFrame([(1, "a", 20, "p", D1)],
                                  "order_id bigint, customer_id string, item_number int, product_id string,"
                                  " requested_delivery_date date")
    df = spark.createDataFrame([(7, 1, 1, 20, Decimal(2), "x", D2), (7, 20, 1, 10, Decimal(2), "x", D3)], DELIVERED)
    assert [r["delivery_date"] for r in marts.item_delivery_performance(lines, df).collect()] == [D2]


def test_first_shipment_is_the_lowest(spark):
    df = spark.createDataFrame([(9, 1, 10, None, None), (8, 1, 10, None, None), (5, 1, 20, None, None)], SHIPPED)
    assert sorted(tuples(marts.first_shipment_per_item(df))) == [(1, 10, 8), (1, 20, 5)]


def test_duplicates_count_nulls_as_equal(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, "d")]
    df = spark.createDataFrame(rows, "k int, v string")
    expected = {"duplicate_primary_key": 5, "full_row_duplicate": 2}
    assert issue(checks.duplicates(df, "t", ["k"])) == expected
    assert issue(checks.duplicate_keys(df, "t", ["k"])) == {"duplicate_primary_key": 5}
    assert sorted(tuples(repeated_keys(df, ["k"])), key=str) == [(1, 3), (None, 2)]


def test_duplicates_agree_with_and_without_a_broadcast(spark):
    rows = [(i % 7, None if i % 5 == 0 else i % 3, "v" if i % 2 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "`key one` int, k2 int, v string")
    counts, keys = Counter(rows), Counter(r[:2] for r in rows)
    expected = {
        "duplicate_primary_key": sum(n for n in keys.values() if n > 1),
        "full_row_duplicate": sum(n - 1 for n in counts.values()),
    }
    assert issue(checks.duplicates(df, "t", ["key one", "k2"])) == expected
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert issue(checks.duplicates(df, "t", ["key one", "k2"])) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


def test_checks_on_an_empty_table(spark):
    df = spark.createDataFrame([], "k int, v string")
    assert set(issue(checks.duplicates(df, "t", ["k"])).values()) == {0}
    assert set(issue(checks.profile(df, "t", ["k"])).values()) == {0}


def test_profile_counts_nulls_in_one_pass(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, 2, None), (1, 2, "y")], "`a key` int, b int, c string")
    assert issue(checks.profile(df, "t", ["a key", "b"])) == {
        "row_count": 3, "missing_primary_key": 2, "missing_a key": 1, "missing_b": 1, "missing_c": 1,
    }


def test_unparseable_dates(spark):
    texts = ["2025-02-01", "2025-2-3", "02/03/2025", "x", None, "2025-02-03 10:00"]
    df = spark.createDataFrame([(s,) for s in texts], "`Order Date` string")
    assert issue(checks.unparseable_dates(df, "VBAK", "Order Date")) == {"unparseable_date_Order Date": 4}


def test_corrupted_numbers(spark):
    numbers = spark.createDataFrame([(-5,), (None,), (5,)], "`Phone Number` bigint")
    texts = spark.createDataFrame([("1-212-5551234",), ("-5551234",), (None,)], "`Phone Number` string")
    for df in (numbers, texts):
        assert issue(checks.corrupted_numbers(df, "LFA1", "Phone Number")) == {"corrupted_Phone_Number": 1}


def test_negative_quantities_ignore_nulls(spark):
    df = spark.createDataFrame([(Decimal(-1),), (None,), (Decimal(0),)], "Quantity decimal(18,3)")
    assert issue(checks.negative_values(df, "VBAP", "Quantity")) == {"negative_Quantity": 1}


def test_orphans_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (None,), (3,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert tuples(orphan_values(child, "k", parent, "k")) == [(3,)]
    assert tuples(orphan_rows(child, ["k"], parent)) == [(3, 2)]
    strict = tuples(orphan_values(child, "k", parent, "k", null_is_orphan=True))
    assert sorted(strict, key=str) == [(3,), (None,)]


def test_composite_reference_with_a_null_part_passes(spark):
    child = spark.createDataFrame([(1, 10), (1, None), (2, 10)], "order_id int, item_number int")
    parent = spark.createDataFrame([(1, 10)], "order_id int, item_number int")
    assert tuples(orphan_rows(child, ["order_id", "item_number"], parent)) == [(2, 10, 1)]


def test_ratios_over_nothing_are_null(spark):
    items = spark.createDataFrame([], "order_id bigint, item_number int, order_quantity decimal(18,3)")
    delivered = spark.createDataFrame([(1, 10, Decimal(5))], "order_id bigint, sales_item int, delivered_quantity decimal(18,3)")
    orders = spark.createDataFrame([], HEADERS)
    assert tuples(kpis.fulfillment_pct(items, delivered)) == [(None,)]
    assert tuples(kpis.customer_fulfillment_pct(orders)) == [(None,)]
    assert tuples(feeders.outstanding_total(items, delivered)) == [(0, Decimal(0))]


def test_outstanding_drops_unknown_quantities(spark):
    items = spark.createDataFrame([(1, 10, None), (1, 20, Decimal(4)), (1, 30, Decimal(3))],
                                  "order_id bigint, item_number int, order_quantity decimal(18,3)")
    delivered = spark.createDataFrame([(1, 20, Decimal(1)), (1, 20, Decimal(1)), (1, 30, Decimal(3))],
                                      "order_id bigint, sales_item int, delivered_quantity decimal(18,3)")
    assert tuples(kpis.outstanding(items, delivered)) == [(1, 20, Decimal(4), Decimal(2), Decimal(2))]


def test_day_means_equal_the_joined_mean(spark):
    """Duplicates on both sides and missing dates, against the plain join."""
    orders = spark.createDataFrame([(1, D1), (1, D2), (2, None), (3, D3), (None, D1)], "order_id bigint, order_date date")
    deliveries = spark.createDataFrame(
        [(1, 11, D3), (1, 12, None), (2, 13, D3), (3, 14, D1), (3, 15, D2), (4, 16, D1), (None, 17, D1)],
        "order_id bigint, delivery_id bigint, delivery_date date")
    shipments = spark.createDataFrame(
        [(1, 11, "A", D1), (1, 11, "A", D2), (1, 12, "B", D1), (2, 13, "B", None), (3, 14, "A", D3), (3, 15, None, D1)],
        "order_id bigint, delivery_id bigint, carrier_name string, shipment_date date")
    for df, name in ((orders, "o"), (deliveries, "d"), (shipments, "s")):
        df.createOrReplaceTempView(name)
    gap = "round(avg(datediff(d.delivery_date, o.order_date)), 2)"
    plain = spark.sql(f"SELECT {gap} FROM o JOIN d ON o.order_id = d.order_id")
    assert tuples(kpis.processing_days(orders, deliveries)) == tuples(plain)
    plain = spark.sql(f"""SELECT s.carrier_name, {gap}, count(*) FROM o JOIN s ON o.order_id = s.order_id
        JOIN d ON s.delivery_id = d.delivery_id GROUP BY s.carrier_name""")
    key = lambda rows: sorted(rows, key=str)
    assert key(tuples(kpis.carrier_performance(orders, shipments, deliveries))) == key(tuples(plain))
    plain = spark.sql("""SELECT s.carrier_name, round(avg(datediff(d.delivery_date, s.shipment_date)), 2), count(*)
        FROM s JOIN d ON s.delivery_id = d.delivery_id GROUP BY s.carrier_name""")
    assert key(tuples(kpis.carrier_shipment_days(shipments, deliveries))) == key(tuples(plain))


def test_status_case_is_kept(spark):
    df = spark.createDataFrame([("Open",), ("open",)], "order_status string")
    assert sorted(tuples(kpis.orders_by_status(df))) == [("Open", 1), ("open", 1)]


def test_status_case_can_be_ignored_by_collation(spark):
    df = spark.createDataFrame([("Delivered",), ("delivered",), ("Open",)], "order_status string")
    folded = df.select(F.collate("order_status", "UTF8_LCASE").alias("order_status"))
    assert sorted(r["total_orders"] for r in kpis.orders_by_status(folded).collect()) == [1, 2]
    assert tuples(kpis.customer_fulfillment_pct(folded)) == [(66.67,)]


def test_dimensions_skip_nulls(spark):
    shipments = spark.createDataFrame([("B",), ("A",), ("A",), (None,)], "Carrier string")
    assert sorted(tuples(warehouse.dim_carrier(shipments))) == [("A",), ("B",)]
    one, two = [spark.createDataFrame([(m,), (None,)], "`Material Number` string") for m in ("x", "y")]
    assert sorted(tuples(warehouse.dim_product(one, two, one))) == [("x",), ("y",)]


def test_delivered_without_records(spark):
    orders = spark.createDataFrame([(1, "Delivered"), (2, "Delivered"), (3, "Delivered"), (4, "Open")],
                                   "`Sales Document` int, `Order Status` string")
    delivered = spark.createDataFrame([(1,), (None,)], "`Sales Document` int")
    shipped = spark.createDataFrame([(2,)], "`Sales Document` int")
    sheets = {"VBAK": orders, "LIPS": delivered, "VTTP": shipped}
    assert [r["issue_count"] for r in quality.delivered_without_records(sheets).collect()] == [1]


def test_grain_check_sees_multiplied_rows(spark):
    four, two = spark.range(4), spark.range(2)
    assert tuples(quality.grain_check("t", four, [two, two])) == [("t", 4, 4, 0)]
    assert tuples(quality.grain_check("t", four, [two])) == [("t", 4, 2, 2)]


def test_type_violations(spark):
    carriers = spark.createDataFrame([("x" * 51,), ("y" * 50,)], "carrier_name string")
    assert tuples(quality.type_violations({"dim_carrier": carriers})) == [
        ("dim_carrier", "carrier_name", "VARCHAR(50)", 51, 1)
    ]


def test_conform_types_and_names(spark, sheets):
    assert trim_headers(spark.createDataFrame([(1,)], "` a b ` int")).columns == ["a b"]
    assert to_mart(sheets["VBAP"], "VBAP").columns[4] == "unit_price"
    table = to_table(sheets["VBAP"], "VBAP")
    assert table.columns[4] == "net_price" and dict(table.dtypes)["requested_delivery_date"] == "date"


@pytest.mark.parametrize("sheet", ["LIKP", "VTTK"])
def test_bad_dates_become_null(spark, sheets, sheet):
    column = "Delivery Date" if sheet == "LIKP" else "Shipment Date"
    bad = sheets[sheet].withColumn(column, F.lit("not a date"))
    name = "delivery_date" if sheet == "LIKP" else "shipment_date"
    assert to_table(bad, sheet).select(name).distinct().collect()[0][0] is None


def test_values_that_do_not_fit_are_counted_and_fail_the_load(spark, sheets):
    wide = sheets["VBAP"].withColumn("Quantity", F.when(F.col("Item Number") == 20, F.lit("1" + "0" * 17)).otherwise(F.lit("7")))
    found = quality.type_violations(warehouse.untyped_tables({**sheets, "VBAP": wide})).where("violating_rows > 0")
    assert [(r["table"], r["column"], r["violating_rows"]) for r in found.collect()] == [("fact_order_item", "order_quantity", 1)]
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_INVALID_INPUT"):
        warehouse.table({**sheets, "VBAP": wide}, "fact_order_item").collect()


def test_orders_of_other_or_no_status_are_in_the_matrix(spark):
    orders = spark.createDataFrame([("c", "Open"), ("c", "Blocked"), ("c", None)], "customer_id string, order_status string")
    customers = spark.createDataFrame([("c", "DE")], "customer_id string, country string")
    assert tuples(feeders.country_status_matrix(orders, customers)) == [("DE", 1, 0, 0, 2)]
