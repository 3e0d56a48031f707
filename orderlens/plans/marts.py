"""The six derived tables. Inputs are conformed with ``operators.conform.to_mart``."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import day_gap, joined_text, on_time, zero_if_null
from orderlens.operators.conform import to_mart
from orderlens.operators.joins import fanout_left_join, guard_unique
from orderlens.session import run_together
from orderlens.sources.files import write_csv
from orderlens.sources.tables import WrittenTables, write_tables

ITEM_KEY = ["order_id", "item_number"]
# Order of the rows in CSV output.
SORT_KEYS = {
    "order_items": ITEM_KEY,
    "delivery_items": ["delivery_id", "item_number"],
    "shipment_items": ["shipment_id", "item_number"],
    "item_delivery_performance": ITEM_KEY,
    "order_summary": ["order_id"],
    "delivery_analytics": ITEM_KEY,
}


def order_lines(headers: DataFrame, items: DataFrame) -> DataFrame:
    """Every order with its items; an order without items keeps one row, items null."""
    joined = fanout_left_join(headers, items, ["order_id"], ["item_number"], apart=True)
    return guard_unique(joined, headers, ["order_id"], "order header to item")


def order_items(headers: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Order lines with the customer's name and place, which are looked up per order, before items multiply the rows."""
    who = customers.select("customer_id", "customer_name", "country", "region", "city")
    placed = headers.join(who, "customer_id", "left")
    joined = fanout_left_join(placed, items, ["order_id"], ["item_number"], apart=True)
    joined = guard_unique(joined, headers, ["order_id"], "order header to item")
    joined = guard_unique(joined, who, ["customer_id"], "order item to customer")
    return joined.select(*headers.columns, *[c for c in items.columns if c != "order_id"], *who.columns[1:])


def delivery_items(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Delivery items with their header; order and customer are the item's own."""
    joined = items.join(headers.drop("order_id", "customer_id"), "delivery_id", "left")
    return guard_unique(
        joined.select(*items.columns, *[c for c in joined.columns if c not in items.columns]),
        headers, ["delivery_id"], "delivery item to header",
    )


def shipment_items(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Shipment items with their header; the header's customer is ``header_customer_id``."""
    joined = items.join(headers.drop("order_id", "delivery_id"), "shipment_id", "left")
    return guard_unique(
        joined.select(*items.columns, *[c for c in joined.columns if c not in items.columns]),
        headers, ["shipment_id"], "shipment item to header",
    )


def _deliveries_of_items(delivered: DataFrame) -> DataFrame:
    """Delivery rows under the order item they deliver: the sales item, not the item number."""
    return delivered.select(
        "order_id",
        F.col("sales_item").alias("item_number"),
        "delivery_id",
        F.col("item_number").alias("delivery_item"),
        "delivery_date",
    )


def match_deliveries(lines: DataFrame, delivered: DataFrame) -> DataFrame:
    """Order lines x their deliveries, with the day gap and the on-time flag.

    An item delivered in parts appears once per delivery; an item without one keeps a
    row with a null date, gap and flag. One item may own a huge share of the deliveries,
    hence the fan-out join.
    """
    matched = fanout_left_join(lines, _deliveries_of_items(delivered), ITEM_KEY, ["delivery_id", "delivery_item"])
    return matched.withColumns({
        "delivery_gap_days": day_gap(F.col("delivery_date"), F.col("requested_delivery_date")),
        "on_time_proxy": on_time(F.col("delivery_date"), F.col("requested_delivery_date")),
    })


def on_time_verdicts(headers: DataFrame, items: DataFrame, delivered: DataFrame) -> DataFrame:
    """The on-time flag of order items that were delivered, one row per delivery.

    The same flags as in the delivery analytics, without the items that have no delivery: inner
    joins do, and adaptive execution splits a hot key on either of their sides.
    """
    ordered = items.select(*ITEM_KEY, "requested_delivery_date").join(headers.select("order_id"), "order_id")
    matched = ordered.join(_deliveries_of_items(delivered).select(*ITEM_KEY, "delivery_date"), ITEM_KEY)
    flags = matched.select(*ITEM_KEY, on_time(F.col("delivery_date"), F.col("requested_delivery_date")).alias("on_time"))
    return guard_unique(flags, headers, ["order_id"], "order header to item")


def item_delivery_performance(lines: DataFrame, delivered: DataFrame) -> DataFrame:
    return match_deliveries(lines, delivered).select(
        "order_id", "item_number", "customer_id", "product_id", "requested_delivery_date",
        "delivery_date", "delivery_gap_days", "on_time_proxy",
    )


def _per_order(items: DataFrame, key: str, quantity: str, status: str, names: tuple[str, str, str]) -> DataFrame:
    """Distinct documents, total quantity and distinct statuses per order, in one pass over the items.

    Items are reduced to their documents first. An order then collects the status sets of its
    documents, of which there are no more than combinations of statuses.
    """
    documents, total, statuses = names
    of_document = items.groupBy("order_id", key).agg(
        F.sum(quantity).alias("_quantity"), F.array_sort(F.collect_set(status)).alias("_statuses")
    )
    return of_document.groupBy("order_id").agg(
        F.count(key).alias(documents),
        zero_if_null(F.sum("_quantity")).alias(total),
        joined_text(F.flatten(F.collect_set("_statuses"))).alias(statuses),
    )


def order_summary(
    headers: DataFrame, items: DataFrame, delivered: DataFrame, shipped: DataFrame, performance: DataFrame | None = None
) -> DataFrame:
    """One row per order with item, delivery and shipment totals.

    ``performance`` is the item delivery performance of the same sheets, where it is written already: items have met
    their deliveries there.

    Each input is reduced to one row per order before any join, so no quantity is
    counted twice and no order can be a hot key. An order nothing was delivered for has
    null delivery figures and its whole quantity outstanding.
    """
    keyed = F.col("order_id").isNotNull()
    ordered = items.where(keyed).groupBy("order_id").agg(
        F.count("item_number").alias("_items"), F.sum("order_quantity").alias("_ordered")
    )
    deliveries = _per_order(
        delivered.where(keyed), "delivery_id", "delivered_quantity", "item_delivery_status",
        ("total_deliveries", "total_delivered_qty", "delivery_statuses"),
    )
    shipments = _per_order(
        shipped.where(keyed), "shipment_id", "shipped_quantity", "item_shipment_status",
        ("total_shipments", "total_shipped_qty", "shipment_statuses"),
    )
    if performance is None:
        wanted = items.where(keyed).select(*ITEM_KEY, "requested_delivery_date")
        performance = match_deliveries(wanted, delivered)
    timing = performance.where(keyed).groupBy("order_id").agg(
        F.avg("delivery_gap_days").alias("avg_delivery_gap_days"),
        F.avg(F.col("on_time_proxy").cast("double")).alias("pct_items_on_time_proxy"),
    )
    summary = (
        headers.where(keyed)
        .join(ordered, "order_id", "left")
        .join(deliveries, "order_id", "left")
        .join(shipments, "order_id", "left")
        .join(timing, "order_id", "left")
    )
    ordered_qty = zero_if_null(F.col("_ordered"))
    summary = summary.select(
        "order_id", "customer_id", "order_date", "order_status",
        zero_if_null(F.col("_items")).alias("total_order_items"),
        ordered_qty.alias("total_ordered_qty"),
        "total_deliveries", "total_delivered_qty", "delivery_statuses",
        "total_shipments", "total_shipped_qty", "shipment_statuses",
        "avg_delivery_gap_days", "pct_items_on_time_proxy",
        (ordered_qty - zero_if_null(F.col("total_delivered_qty"))).alias("outstanding_qty"),
    )
    return guard_unique(summary, headers, ["order_id"], "order header to item")


def first_shipment_per_item(shipped: DataFrame) -> DataFrame:
    """The lowest shipment id per order item."""
    return shipped.groupBy("order_id", F.col("sales_item").alias("item_number")).agg(
        F.min("shipment_id").alias("shipment_id")
    )


def analytics_rows(lines: DataFrame, delivered: DataFrame, shipped: DataFrame) -> DataFrame:
    """Delivery analytics with the delivery's own key, which tells the rows apart.

    The first shipment is looked up per item, before deliveries multiply the rows.
    """
    with_shipment = lines.join(first_shipment_per_item(shipped), ITEM_KEY, "left")
    return match_deliveries(with_shipment, delivered).select(*_analytics_columns(), "delivery_id", "delivery_item")


def _analytics_columns() -> list[Column]:
    """What delivery analytics hold of items matched with their first shipment and their deliveries."""
    return [
        *map(F.col, [*ITEM_KEY, "shipment_id"]),
        F.col("delivery_gap_days").alias("delivery_time_days"),
        F.col("on_time_proxy").alias("on_time"),
        F.lit(None).cast("string").alias("delay_reason"),
    ]


def delivery_analytics(
    lines: DataFrame, delivered: DataFrame, shipped: DataFrame, performance: DataFrame | None = None
) -> DataFrame:
    """Delay per order item and delivery; the sources give no delay reason.

    ``performance`` is the item delivery performance of the same rows, where it is written already: items have met
    their deliveries there, so only their first shipment is looked up.
    """
    if performance is None:
        return analytics_rows(lines, delivered, shipped).drop("delivery_id", "delivery_item")
    return performance.join(first_shipment_per_item(shipped), ITEM_KEY, "left").select(*_analytics_columns())


def preview(summary: DataFrame, n: int = 5) -> DataFrame:
    return summary.orderBy("order_id").limit(n)


@dataclass(frozen=True)
class Marts:
    """The six tables over one set of sheets; each property is a lazy plan.

    Where a table needs no customer or header attributes it is built from the sheets
    that carry its columns: a guarded many-to-one left join adds columns, never rows.
    """

    sheets: Mapping[str, DataFrame]

    def conformed(self, name: str) -> DataFrame:
        return to_mart(self.sheets[name], name)

    @property
    def lines(self) -> DataFrame:
        return order_lines(self.conformed("VBAK"), self.conformed("VBAP"))

    @property
    def order_items(self) -> DataFrame:
        return order_items(self.conformed("VBAK"), self.conformed("VBAP"), self.conformed("KNA1"))

    @property
    def delivery_items(self) -> DataFrame:
        return delivery_items(self.conformed("LIPS"), self.conformed("LIKP"))

    @property
    def shipment_items(self) -> DataFrame:
        return shipment_items(self.conformed("VTTP"), self.conformed("VTTK"))

    @property
    def on_time_verdicts(self) -> DataFrame:
        return on_time_verdicts(*[self.conformed(n) for n in ("VBAK", "VBAP", "LIPS")])

    @property
    def item_delivery_performance(self) -> DataFrame:
        return item_delivery_performance(self.lines, self.conformed("LIPS"))

    @property
    def order_summary(self) -> DataFrame:
        return order_summary(*[self.conformed(n) for n in ("VBAK", "VBAP", "LIPS", "VTTP")])

    @property
    def first_shipment_per_item(self) -> DataFrame:
        return first_shipment_per_item(self.conformed("VTTP"))

    @property
    def analytics_rows(self) -> DataFrame:
        return analytics_rows(self.lines, self.conformed("LIPS"), self.conformed("VTTP"))

    @property
    def delivery_analytics(self) -> DataFrame:
        return delivery_analytics(self.lines, self.conformed("LIPS"), self.conformed("VTTP"))

    def all(self) -> dict[str, DataFrame]:
        return {
            "order_items": self.order_items,
            "delivery_items": self.delivery_items,
            "shipment_items": self.shipment_items,
            "item_delivery_performance": self.item_delivery_performance,
            "order_summary": self.order_summary,
            "delivery_analytics": self.delivery_analytics,
        }


def write_marts(sheets: Mapping[str, DataFrame], root: str) -> WrittenTables:
    """Build and write the six tables as Parquet; returns the written tables.

    The written order items serve as the order lines of the later tables, and the written item delivery performance
    as the items with their deliveries.
    """
    marts = Marts(sheets)

    def headed() -> WrittenTables:
        return write_tables({"delivery_items": marts.delivery_items, "shipment_items": marts.shipment_items}, root)

    def timed() -> WrittenTables:
        headers, items, delivered, shipped = [marts.conformed(n) for n in ("VBAK", "VBAP", "LIPS", "VTTP")]
        first = write_tables({"order_items": marts.order_items}, root)
        lines = first["order_items"]
        met = write_tables({"item_delivery_performance": item_delivery_performance(lines, delivered)}, root)
        performance = met["item_delivery_performance"]
        return first | met | write_tables({
            "order_summary": order_summary(headers, items, delivered, shipped, performance),
            "delivery_analytics": delivery_analytics(lines, delivered, shipped, performance),
        }, root)

    one, other = run_together([timed, headed])
    return one | other


def export_marts(written: Mapping[str, DataFrame], root: str) -> None:
    """The tables that ``write_marts`` wrote as CSV, each sorted by its key."""
    run_together([lambda n=n, df=df: write_csv(df, f"{root}/{n}", order_by=SORT_KEYS[n]) for n, df in written.items()])
