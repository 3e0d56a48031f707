"""Published results of the golden data set."""

from datetime import date
from decimal import Decimal

import pytest

from orderlens.operators.conform import to_table
from orderlens.plans import feeders, kpis, quality, warehouse
from orderlens.plans import marts as mart_plans
from orderlens.plans.marts import Marts, export_marts, preview, write_marts
from orderlens.session import work_path
from orderlens.sources import files


@pytest.fixture(scope="module")
def marts(sheets):
    return Marts(sheets)


@pytest.fixture(scope="module")
def t(sheets):
    return lambda sheet: to_table(sheets[sheet], sheet)


def tuples(df):
    return [tuple(r) for r in df.collect()]


def test_kpi01_orders_by_status(t):
    assert tuples(kpis.orders_by_status(t("VBAK"))) == [("Open", 11), ("Delivered", 6), ("Closed", 5)]


def test_kpi02_and_kpi03_share_a_definition(t):
    assert tuples(kpis.processing_days(t("VBAK"), t("LIKP"))) == [(7.2,)]
    assert tuples(kpis.delivery_days(t("VBAK"), t("LIKP"))) == [(7.2,)]


def test_kpi03b_shipment_to_delivery(t):
    assert tuples(kpis.shipment_to_delivery_days(t("VTTK"), t("LIKP"))) == [(0.0,)]


def test_kpi04_fulfillment(t):
    assert tuples(kpis.fulfillment_pct(t("VBAP"), t("LIPS"))) == [(93.52,)]


def test_kpi05_outstanding(t):
    rows = sorted(tuples(kpis.outstanding(t("VBAP"), t("LIPS"))))
    assert rows == [(1000021, 10, Decimal(180), 0, Decimal(180)), (1000022, 10, Decimal(220), 0, Decimal(220))]
    assert tuples(feeders.outstanding_total(t("VBAP"), t("LIPS"))) == [(2, Decimal(400))]


def test_kpi06_status_breakdown(t):
    assert tuples(kpis.status_breakdown(t("LIKP"))) == [("Delivered", "Shipped", 10), ("Open", "Not Shipped", 10)]


def test_kpi07_carriers(t):
    rows = tuples(kpis.carrier_performance(t("VBAK"), t("VTTK"), t("LIKP")))
    assert rows == [("Carrier3", 7.0, 6), ("Carrier1", 7.25, 8), ("Carrier2", 7.33, 6)]
    rows = sorted(tuples(kpis.carrier_shipment_days(t("VTTK"), t("LIKP"))))
    assert rows == [("Carrier1", 0.0, 8), ("Carrier2", 0.0, 6), ("Carrier3", 0.0, 6)]


def test_kpi08_fulfillment_rate(t):
    assert tuples(kpis.customer_fulfillment_pct(t("VBAK"))) == [(27.27,)]


def test_kpi09_on_time(marts):
    assert tuples(kpis.on_time_rate(marts.delivery_analytics)) == [(0.0, 21)]
    assert tuples(feeders.on_time_gauge(marts.delivery_analytics, 90)) == [(0.0, 21, 90.0, -90.0, 0)]


def test_kpi10_reconciliation(sheets):
    facts = {n: warehouse.table(sheets, n) for n in warehouse.SOURCE_FACTS}
    assert [n for _, n in tuples(kpis.reconciliation(facts))] == [22, 23, 20, 21, 20, 21]


def test_kpi_cards(t, marts):
    cards = feeders.kpi_cards(t("VBAK"), t("VBAP"), t("LIKP"), t("LIPS"), marts.delivery_analytics)
    assert cards.first().asDict() == {
        "avg_order_processing_days": 7.2, "fulfillment_efficiency_pct": 93.52,
        "customer_order_fulfillment_rate_pct": 27.27, "on_time_rate_pct": 0.0,
    }


def test_dashboard_feeders(t):
    matrix = feeders.country_status_matrix(t("VBAK"), t("KNA1")).collect()
    assert sum(r["open"] for r in matrix) == 11 and sum(r["delivered"] for r in matrix) == 6
    assert tuples(feeders.order_trend(t("VBAK"))) == [(date(2025, 2, 1), 22)]
    geo = feeders.geo_orders(t("VBAK"), t("VBAP"), t("KNA1")).collect()
    assert sum(r["total_orders"] for r in geo) == 22 and sum(r["total_ordered_qty"] for r in geo) == 6170


def test_item_tables_keep_their_grain(marts):
    counts = {name: df.count() for name, df in marts.all().items()}
    assert counts == {
        "order_items": 23, "delivery_items": 21, "shipment_items": 21, "item_delivery_performance": 23,
        "order_summary": 22, "delivery_analytics": 23,
    }


def test_item_table_columns(marts):
    assert marts.order_items.columns == (
        "order_id order_date customer_id order_type sales_organization distribution_channel division order_status"
        " item_number product_id order_quantity unit_price item_status requested_delivery_date customer_name country"
        " region city"
    ).split()
    assert marts.delivery_items.columns == (
        "delivery_id item_number product_id delivered_quantity unit_price item_delivery_status customer_id order_id"
        " sales_item delivery_date delivery_header_date shipping_point shipping_type delivery_header_status"
        " shipping_status route delivery_priority"
    ).split()
    assert marts.shipment_items.columns == (
        "shipment_id item_number product_id shipped_quantity item_shipment_status delivery_id customer_id order_id"
        " sales_item shipment_date shipment_header_date shipping_point carrier_name shipment_header_status route"
        " shipping_type header_customer_id"
    ).split()


def test_first_rows_of_the_item_tables(marts):
    row = marts.order_items.where("order_id = 1000001 AND item_number = 20").first().asDict()
    assert (row["customer_name"], row["country"], row["product_id"]) == ("Customer A", "US", "MAT002")
    assert row["requested_delivery_date"] == date(2025, 2, 8) and row["unit_price"] == 30
    row = marts.shipment_items.where("shipment_id = 2001002").first().asDict()
    assert (row["carrier_name"], row["shipment_header_status"]) == ("Carrier2", "Delivered")
    assert row["customer_id"] == row["header_customer_id"] == "CUST002"


def test_item_gaps(marts):
    gaps = marts.item_delivery_performance.groupBy("delivery_gap_days", "on_time_proxy").count()
    assert sorted(tuples(gaps), key=str) == [(1, False, 17), (2, False, 4), (None, None, 2)]


def test_order_summary(marts):
    summary = {r["order_id"]: r.asDict() for r in marts.order_summary.collect()}
    first = summary[1000001]
    assert (first["total_order_items"], first["total_ordered_qty"], first["total_deliveries"]) == (2, 300, 1)
    assert (first["delivery_statuses"], first["avg_delivery_gap_days"], first["outstanding_qty"]) == ("Delivered", 2.0, 0)
    assert first["pct_items_on_time_proxy"] == 0.0 and first["order_date"] == date(2025, 2, 1)
    for order, outstanding in ((1000021, 180), (1000022, 220)):
        row = summary[order]
        assert row["outstanding_qty"] == outstanding and row["avg_delivery_gap_days"] is None
        assert [row[c] for c in ("total_deliveries", "total_delivered_qty", "delivery_statuses")] == [None] * 3
        assert [row[c] for c in ("total_shipments", "total_shipped_qty", "shipment_statuses")] == [None] * 3
    assert [r["order_id"] for r in preview(marts.order_summary).collect()] == list(range(1000001, 1000006))


def test_delivery_analytics(marts):
    rows = {(r["order_id"], r["item_number"]): r for r in marts.delivery_analytics.collect()}
    assert rows[1000001, 20]["shipment_id"] == 2001001 and rows[1000004, 10]["delivery_time_days"] == 1
    assert rows[1000021, 10]["shipment_id"] is None and rows[1000021, 10]["on_time"] is None
    assert {r["delay_reason"] for r in rows.values()} == {None}


def test_analytics_ids(sheets):
    rows = warehouse.table(sheets, "fact_delivery_analytics").orderBy("analytics_id").collect()
    assert [r["analytics_id"] for r in rows] == list(range(1, 24))
    keys = [(r["order_id"], r["item_number"]) for r in rows]
    assert keys == sorted(keys)


def test_validation_report(sheets):
    rows = tuples(quality.report(sheets))
    assert len(rows) == len({r[:2] for r in rows}) == 128
    nonzero = {(t, c): n for t, c, n in rows if n and c != "row_count"}
    assert nonzero == {
        ("LFA1", "corrupted_Phone_Number"): 30,
        ("VTTK", "carrier_not_mappable_to_LFA1_vendor"): 3,
        ("VBAK", "order_status_delivered_but_no_delivery_or_shipment_record"): 1,
    }
    counts = {t: n for t, c, n in rows if c == "row_count"}
    assert counts == {"KNA1": 30, "LFA1": 30, "VBAK": 22, "VBAP": 23, "LIKP": 20, "LIPS": 21, "VTTK": 20, "VTTP": 21}
    checks = {c for t, c, _ in rows if t == "VBAP"}
    assert {"missing_primary_key", "duplicate_primary_key", "full_row_duplicate", "missing_Net Price",
            "orphan_Sales Document_to_VBAK", "unparseable_date_Delivery Date"} <= checks


def test_no_other_violations(sheets):
    assert {n for *_, n in tuples(quality.subset_violations(sheets))} == {0}
    assert {n for *_, n in tuples(quality.nonnegative_quantities(sheets))} == {0}
    assert sorted(n for *_, n in tuples(quality.carriers_against_vendors(sheets))) == [3, 3]


def test_load(spark, sheets):
    loaded = warehouse.load(sheets, "golden_dw")
    counts = {name: df.count() for name, df in loaded.items()}
    assert counts == {
        "dim_customer": 30, "dim_vendor": 30, "dim_carrier": 3, "dim_product": 4, "fact_order": 22,
        "fact_order_item": 23, "fact_delivery": 20, "fact_delivery_item": 21, "fact_shipment": 20,
        "fact_shipment_item": 21, "fact_delivery_analytics": 23,
    }
    assert sum(counts.values()) == 217
    again = warehouse.load(sheets, "golden_dw")
    assert {name: df.count() for name, df in again.items()} == counts
    violations = tuples(quality.type_violations(loaded))
    assert {r[-1] for r in violations} == {0} and len(violations) == 91


def test_written_marts_equal_the_lazy_ones(spark, sheets, marts):
    written = write_marts(sheets, work_path(spark, "marts"))
    for name, df in marts.all().items():
        assert written[name].columns == df.columns
        assert sorted(tuples(written[name]), key=str) == sorted(tuples(df), key=str), name


def test_csv_of_the_tables_and_the_report_is_sorted_by_key(spark, sheets):
    root = work_path(spark, "csv")
    export_marts(write_marts(sheets, work_path(spark, "marts")), root)
    quality.export_report(quality.report(sheets), f"{root}/report")
    summary = files.read_csv(spark, f"{root}/order_summary")
    rows = [(int(r["order_id"]), r["total_delivered_qty"]) for r in summary.collect()]
    assert len(rows) == 22 and [r[0] for r in rows] == list(range(1000001, 1000023))
    assert [float(q) for k, q in rows if k in (1000001, 1000008)] == [300.0, 300.0]
    assert files.read_csv(spark, f"{root}/report").count() == 128
    assert files.read_csv(spark, f"{root}/item_delivery_performance").where("delivery_gap_days is null").count() == 2


def test_written_marts_meet_deliveries_once(spark, sheets, monkeypatch):
    """Later tables read the written ones, with the rows that each has when it is built alone."""
    alone = {name: sorted(map(repr, df.collect())) for name, df in Marts(sheets).all().items()}
    met = []
    matched = mart_plans.match_deliveries
    monkeypatch.setattr(mart_plans, "match_deliveries", lambda *of: met.append(1) or matched(*of))
    written = write_marts(sheets, work_path(spark, "marts"))
    assert len(met) == 1
    assert {name: sorted(map(repr, df.select(*Marts(sheets).all()[name].columns).collect())) for name, df in written.items()} == alone


def test_customers_are_looked_up_per_order(spark, sheets):
    """Not per item: the join with customers reads the headers."""
    plan = Marts(sheets).order_items._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    by_order, by_customer = [next(i for i, line in enumerate(lines) if key in line) for key in ("(order_id", "(customer_id")]
    assert by_order < by_customer
