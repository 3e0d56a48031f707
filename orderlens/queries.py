"""Every query by name, over one folder of driver tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from orderlens.functions import named
from orderlens.operators import checks
from orderlens.operators.checks import stack_rows
from orderlens.plans import feeders, kpis, quality, staging, warehouse
from orderlens.plans.marts import Marts, preview, write_marts
from orderlens.schema import REFERENCE_RULES, SHEETS
from orderlens.session import bounded_tasks, materialize, tune, work_path
from orderlens.sources import files
from orderlens.sources.bridge import Bridge

# Sheets made of lines. A query that reads one three times or more lands it first; below
# that, deriving it again with only the columns each reader needs is cheaper.
_ITEMS = ("VBAP", "LIPS", "VTTP")
_LINE_SHEETS = (*_ITEMS, "LIKP", "VTTK")

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def comparable(df: DataFrame) -> DataFrame:
    """The result with types that every engine renders alike."""
    as_type = {"decimal": "double", "date": "string", "boolean": "int"}
    return df.select(*[
        named(f.name).cast(as_type[f.dataType.typeName()]).alias(f.name)
        if f.dataType.typeName() in as_type else named(f.name)
        for f in df.schema
    ])


def _query(build: Callable[[Bridge], DataFrame], name: str | None = None) -> Callable[[Bridge], DataFrame]:
    def run(spark: SparkSession, root: str) -> DataFrame:
        # All other tables are smaller than the order lines.
        bounded_tasks(tune(spark), files.size(spark, f"{root}/lineitem.parquet"))
        return comparable(build(Bridge(spark, root)))

    _QUERIES[name or build.__name__] = run
    return build


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


class _Facts:
    """Warehouse tables straight from the sheets that KPIs need."""

    def __init__(self, bridge: Bridge, timed: bool = False) -> None:
        self.sheets = bridge.lean_sheets(requested_date=timed)

    def __getattr__(self, table: str) -> DataFrame:
        return warehouse.table(self.sheets, table)

    @property
    def verdicts(self) -> DataFrame:
        return Marts(self.sheets).on_time_verdicts


# -- sources ----------------------------------------------------------------
@_query
def source_shape(b: Bridge) -> DataFrame:
    return files.shape(b.lean_sheets())


@_query
def land_sources(b: Bridge) -> DataFrame:
    return files.shape(files.land(b.sheets(), work_path(b.spark, "landed")))


# -- warehouse tables -------------------------------------------------------
for _table in ("dim_customer", "dim_vendor", "fact_order", "fact_order_item", "fact_delivery",
               "fact_delivery_item", "fact_shipment", "fact_shipment_item"):
    _query(lambda b, t=_table: warehouse.table(b.sheets(), t), _table)


@_query
def dim_carrier(b: Bridge) -> DataFrame:
    return warehouse.table(b.lean_sheets(), "dim_carrier").orderBy("carrier_name")


@_query
def dim_product(b: Bridge) -> DataFrame:
    return warehouse.table(b.lean_sheets(), "dim_product").orderBy("product_id")


@_query
def fact_delivery_analytics(b: Bridge) -> DataFrame:
    return warehouse.table(b.lean_sheets(requested_date=True), "fact_delivery_analytics")


@_query
def load_warehouse(b: Bridge) -> DataFrame:
    # A database per call: the result stays this folder's, whatever is loaded later.
    database = f"orderlens_dw_{uuid.uuid4().hex}"
    warehouse.load(b.landed_sheets("VBAP"), database)
    return staging.published_rows(b.spark, database).select("table", "row_count")


@_query
def bi_export_shape(b: Bridge) -> DataFrame:
    root = work_path(b.spark, "bi")
    tables = warehouse.tables(b.landed_sheets("VBAP"))
    files.export_for_bi(tables, root)
    return files.shape({n: b.spark.read.option("header", True).csv(f"{root}/{n}") for n in tables})


@_query
def csv_round_trip(b: Bridge) -> DataFrame:
    """Rows and nulls per column of tables written as CSV, sorted by key, and read back."""
    root = work_path(b.spark, "csv")
    summary = Marts(b.lean_sheets(requested_date=True).landed(*_ITEMS)).order_summary
    tables = {
        "dim_customer": (warehouse.table({"KNA1": b.kna1_with_addresses()}, "dim_customer"), ["customer_id"]),
        "order_summary": (summary, ["order_id"]),
    }
    for name, (df, keys) in tables.items():
        files.write_csv(materialize(df, name), f"{root}/{name}", order_by=keys)
    return stack_rows([files.null_counts(files.read_csv(b.spark, f"{root}/{name}", multi_line=name == "dim_customer"), name) for name in tables])


# -- derived tables ---------------------------------------------------------
@_query
def order_items(b: Bridge) -> DataFrame:
    return Marts(b.sheets()).order_items


@_query
def delivery_items(b: Bridge) -> DataFrame:
    return Marts(b.sheets()).delivery_items


@_query
def shipment_items(b: Bridge) -> DataFrame:
    return Marts(b.sheets()).shipment_items


@_query
def item_delivery_performance(b: Bridge) -> DataFrame:
    return Marts(b.lean_sheets(requested_date=True)).item_delivery_performance


@_query
def order_summary(b: Bridge) -> DataFrame:
    return Marts(b.lean_sheets(requested_date=True).landed(*_ITEMS)).order_summary


@_query
def order_summary_preview(b: Bridge) -> DataFrame:
    return preview(Marts(b.lean_sheets(requested_date=True).landed(*_ITEMS)).order_summary)


@_query
def first_shipment_per_item(b: Bridge) -> DataFrame:
    return Marts(b.lean_sheets()).first_shipment_per_item


@_query
def delivery_analytics(b: Bridge) -> DataFrame:
    return Marts(b.lean_sheets(requested_date=True)).delivery_analytics


@_query
def transform_row_counts(b: Bridge) -> DataFrame:
    written = write_marts(b.landed_sheets("VBAP"), work_path(b.spark, "marts"))
    return files.shape(written).select("table", "row_count")


# -- KPIs -------------------------------------------------------------------
@_query
def kpi01_orders_by_status(b: Bridge) -> DataFrame:
    return kpis.orders_by_status(_Facts(b).fact_order)


@_query
def kpi02_processing_days(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.processing_days(f.fact_order, f.fact_delivery)


@_query
def kpi03_delivery_days(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.delivery_days(f.fact_order, f.fact_delivery)


@_query
def kpi03b_shipment_to_delivery_days(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.shipment_to_delivery_days(f.fact_shipment, f.fact_delivery)


@_query
def kpi04_fulfillment_pct(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.fulfillment_pct(f.fact_order_item, f.fact_delivery_item)


@_query
def kpi05_outstanding(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.outstanding(f.fact_order_item, f.fact_delivery_item)


@_query
def kpi06_status_breakdown(b: Bridge) -> DataFrame:
    return kpis.status_breakdown(_Facts(b).fact_delivery)


@_query
def kpi07_carrier_performance(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.carrier_performance(f.fact_order, f.fact_shipment, f.fact_delivery)


@_query
def kpi07b_carrier_shipment_days(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.carrier_shipment_days(f.fact_shipment, f.fact_delivery)


@_query
def kpi08_customer_fulfillment_pct(b: Bridge) -> DataFrame:
    return kpis.customer_fulfillment_pct(_Facts(b).fact_order)


@_query
def kpi09_on_time_rate(b: Bridge) -> DataFrame:
    return kpis.on_time_rate(_Facts(b, timed=True).verdicts)


@_query
def kpi10_reconciliation(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return kpis.reconciliation({t: getattr(f, t) for t in warehouse.SOURCE_FACTS})


# -- dashboard feeders ------------------------------------------------------
@_query
def country_status_matrix(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return feeders.country_status_matrix(f.fact_order, f.dim_customer)


@_query
def order_trend(b: Bridge) -> DataFrame:
    return feeders.order_trend(_Facts(b).fact_order)


@_query
def geo_orders(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return feeders.geo_orders(f.fact_order, f.fact_order_item, f.dim_customer)


@_query
def on_time_gauge(b: Bridge) -> DataFrame:
    return feeders.on_time_gauge(_Facts(b, timed=True).verdicts)


@_query
def kpi_cards(b: Bridge) -> DataFrame:
    f = _Facts(b, timed=True)
    return feeders.kpi_cards(f.fact_order, f.fact_order_item, f.fact_delivery, f.fact_delivery_item, f.verdicts)


@_query
def outstanding_total(b: Bridge) -> DataFrame:
    f = _Facts(b)
    return feeders.outstanding_total(f.fact_order_item, f.fact_delivery_item)


# -- validation -------------------------------------------------------------
@_query
def dq_profile(b: Bridge) -> DataFrame:
    """The eight sheets, and order items, where orders without items show as nulls."""
    sheets = b.sheets()
    lines = Marts(sheets).order_items
    return quality.profile(sheets).unionByName(checks.profile(lines, "order_items", ["order_id", "item_number"]))


@_query
def dq_duplicate_keys(b: Bridge) -> DataFrame:
    """With order lines as they come, where keys do repeat."""
    return quality.duplicate_keys(b.lean_sheets().replace(VBAP=b.vbap_raw))


@_query
def dq_full_row_duplicates(b: Bridge) -> DataFrame:
    return quality.full_row_duplicates(b.landed_sheets().replace(VBAP=b.vbap_raw))


@_query
def dq_orphans(b: Bridge) -> DataFrame:
    """The six rules, and orders no item refers to."""
    itemless = ("VBAK", "Sales Document", "VBAP", "Sales Document")
    return quality.orphans(b.lean_sheets(), [*REFERENCE_RULES, itemless])


@_query
def dq_subset(b: Bridge) -> DataFrame:
    return quality.subset_violations(b.lean_sheets())


@_query
def dq_unparseable_dates(b: Bridge) -> DataFrame:
    """The four rules, with order dates as text from a mixed-format feed."""
    return quality.unparseable_dates(b.lean_sheets(requested_date=True).replace(VBAK=b.vbak_mixed_dates))


@_query
def dq_corrupted_numbers(b: Bridge) -> DataFrame:
    return quality.corrupted_numbers(b.lean_sheets())


@_query
def dq_unmapped_carriers(b: Bridge) -> DataFrame:
    return quality.carriers_against_vendors(b.lean_sheets())


@_query
def dq_delivered_without_records(b: Bridge) -> DataFrame:
    return quality.delivered_without_records(b.lean_sheets())


@_query
def dq_nonnegative_quantity(b: Bridge) -> DataFrame:
    return quality.nonnegative_quantities(b.lean_sheets())


@_query
def dq_join_cardinality(b: Bridge) -> DataFrame:
    """The guarded joins, and raw order lines as a one side that must fail."""
    sheets = b.lean_sheets()
    return quality.join_cardinality({
        "order item to header": (sheets["VBAK"], list(SHEETS["VBAK"].key)),
        "order item to customer": (sheets["KNA1"], list(SHEETS["KNA1"].key)),
        "delivery item to header": (sheets["LIKP"], list(SHEETS["LIKP"].key)),
        "shipment item to header": (sheets["VTTK"], list(SHEETS["VTTK"].key)),
        "delivery item to raw order line": (b.vbap_raw(), list(SHEETS["VBAP"].key)),
    })


@_query
def dq_grain_check(b: Bridge) -> DataFrame:
    sheets = b.lean_sheets().landed(*_LINE_SHEETS)
    marts = Marts(sheets)
    key = "`Sales Document`"
    itemless = sheets["VBAK"].join(sheets["VBAP"].select(key).distinct(), "Sales Document", "left_anti")
    return stack_rows([
        quality.grain_check("order_items", marts.order_items, [sheets["VBAP"], itemless]),
        quality.grain_check("delivery_items", marts.delivery_items, [sheets["LIPS"]]),
        quality.grain_check("shipment_items", marts.shipment_items, [sheets["VTTP"]]),
    ])


@_query
def dq_report(b: Bridge) -> DataFrame:
    """The whole report over landed sheets: each is derived once, then read by column."""
    return quality.report(files.land(b.sheets(), work_path(b.spark, "landed")))


@_query
def dw_pk_violations(b: Bridge) -> DataFrame:
    return quality.primary_key_violations(warehouse.tables(b.lean_sheets(requested_date=True).landed(*_ITEMS)))


def _unnumbered_tables(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    names = [t for t in warehouse.LOAD_ORDER if t != "fact_delivery_analytics"]
    return {t: warehouse.table(sheets, t) for t in names} | {
        "fact_delivery_analytics": Marts(sheets).delivery_analytics
    }


@_query
def dw_fk_violations(b: Bridge) -> DataFrame:
    return quality.foreign_key_violations(_unnumbered_tables(b.landed_sheets("VBAP")))


@_query
def dw_length_violations(b: Bridge) -> DataFrame:
    """Values as they come, with customer groups from a feed that mixes names and numbers."""
    sheets = b.landed_sheets("VBAP")
    found = warehouse.untyped_tables(sheets.replace(KNA1=b.kna1_mixed_groups))
    return quality.type_violations(found | {"fact_delivery_analytics": Marts(sheets).delivery_analytics})
