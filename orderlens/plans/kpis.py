"""The KPI set, over the warehouse fact tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import mean2, percent2, zero_if_null
from orderlens.operators.checks import stack_rows
from orderlens.operators.dates import date_mass, gap_mass
from orderlens.schema import DELIVERED


def orders_by_status(fact_order: DataFrame) -> DataFrame:
    """KPI 1."""
    return fact_order.groupBy("order_status").agg(F.count("*").alias("total_orders")).orderBy(
        F.desc("total_orders"), "order_status"
    )


def _order_to_delivery(fact_order: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    return gap_mass(
        date_mass(fact_order, "order_date", ["order_id"]),
        date_mass(fact_delivery, "delivery_date", ["order_id"]),
        "order_id",
    )


def _mean_gap() -> F.Column:
    return mean2(F.sum("gap_days"), F.sum("gaps"))


def processing_days(fact_order: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """KPI 2: order date to delivery date."""
    return _order_to_delivery(fact_order, fact_delivery).agg(_mean_gap().alias("avg_order_processing_days"))


def delivery_days(fact_order: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """KPI 3: the same date pair as KPI 2, by definition."""
    return _order_to_delivery(fact_order, fact_delivery).agg(_mean_gap().alias("avg_delivery_time_days"))


def shipment_to_delivery_days(fact_shipment: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """KPI 3b: shipment date to delivery date."""
    mass = gap_mass(
        date_mass(fact_shipment, "shipment_date", ["delivery_id"]),
        date_mass(fact_delivery, "delivery_date", ["delivery_id"]),
        "delivery_id",
    )
    return mass.agg(_mean_gap().alias("avg_shipment_to_delivery_days"))


def fulfillment_pct(fact_order_item: DataFrame, fact_delivery_item: DataFrame) -> DataFrame:
    """KPI 4: delivered quantity as a share of ordered quantity; null without orders."""
    none = F.lit(None).cast("decimal(18,3)")
    both = fact_delivery_item.select(F.col("delivered_quantity").alias("out"), none.alias("due")).unionByName(
        fact_order_item.select(none.alias("out"), F.col("order_quantity").alias("due"))
    )
    return both.agg(percent2(F.sum("out"), F.sum("due")).alias("fulfillment_efficiency_pct"))


def outstanding(fact_order_item: DataFrame, fact_delivery_item: DataFrame) -> DataFrame:
    """KPI 5: order items whose delivered quantity differs from the ordered one."""
    ordered = fact_order_item.groupBy("order_id", "item_number").agg(F.sum("order_quantity").alias("ordered_qty"))
    delivered = fact_delivery_item.groupBy("order_id", F.col("sales_item").alias("item_number")).agg(
        F.sum("delivered_quantity").alias("_delivered")
    )
    got = zero_if_null(F.col("_delivered"))
    return (
        ordered.join(delivered, ["order_id", "item_number"], "left")
        .select(
            "order_id", "item_number", "ordered_qty",
            got.alias("delivered_qty"), (F.col("ordered_qty") - got).alias("outstanding_qty"),
        )
        .where("outstanding_qty <> 0")
    )


def status_breakdown(fact_delivery: DataFrame) -> DataFrame:
    """KPI 6."""
    return fact_delivery.groupBy("delivery_status", "shipping_status").agg(
        F.count("*").alias("delivery_count")
    ).orderBy(F.desc("delivery_count"), "delivery_status", "shipping_status")


def carrier_performance(fact_order: DataFrame, fact_shipment: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """KPI 7: order date to delivery date, by carrier.

    Shipments are counted per (delivery, carrier, order) and the dated deliveries
    summed per (order, carrier), so each join sees every key once per side and carrier.
    """
    shipped = fact_shipment.groupBy("delivery_id", "carrier_name", "order_id").agg(F.count("*").alias("_n"))
    arrived = date_mass(fact_delivery, "delivery_date", ["delivery_id"])
    per_order = shipped.join(arrived, "delivery_id").groupBy("order_id", "carrier_name").agg(
        *[F.sum(F.col("_n") * F.col(c)).alias(c) for c in ("rows", "dated", "days")]
    )
    mass = gap_mass(date_mass(fact_order, "order_date", ["order_id"]), per_order, "order_id")
    return mass.groupBy("carrier_name").agg(
        _mean_gap().alias("avg_order_to_delivery_days"), F.sum("pairs").alias("order_delivery_pairs")
    ).orderBy("avg_order_to_delivery_days", "carrier_name")


def carrier_shipment_days(fact_shipment: DataFrame, fact_delivery: DataFrame) -> DataFrame:
    """KPI 7b: shipment date to delivery date, by carrier."""
    mass = gap_mass(
        date_mass(fact_shipment, "shipment_date", ["delivery_id", "carrier_name"]),
        date_mass(fact_delivery, "delivery_date", ["delivery_id"]),
        "delivery_id",
    )
    return mass.groupBy("carrier_name").agg(
        _mean_gap().alias("avg_shipment_to_delivery_days"), F.sum("pairs").alias("shipment_delivery_pairs")
    )


def customer_fulfillment_pct(fact_order: DataFrame) -> DataFrame:
    """KPI 8: share of orders that are delivered."""
    done = F.count_if(F.col("order_status") == DELIVERED)
    return fact_order.agg(percent2(done, F.count("*")).alias("customer_order_fulfillment_rate_pct"))


def on_time_rate(analytics: DataFrame) -> DataFrame:
    """KPI 9, over the delivery analytics (or ``marts.on_time_verdicts``) that have a verdict."""
    return analytics.where("on_time IS NOT NULL").agg(
        percent2(F.count_if("on_time"), F.count("*")).alias("on_time_rate_pct"),
        F.count("*").alias("matched_items"),
    )


def reconciliation(facts: Mapping[str, DataFrame]) -> DataFrame:
    """KPI 10: rows per fact table."""
    return stack_rows([
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in facts.items()
    ])
