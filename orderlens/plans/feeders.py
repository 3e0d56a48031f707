"""Aggregates behind the dashboard pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import zero_if_null
from orderlens.operators.checks import stack_rows
from orderlens.plans import kpis

# The order statuses, one matrix column each.
ORDER_STATUSES = ("Open", "Delivered", "Closed")


def country_status_matrix(fact_order: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders per country and status, those of another or no status as ``other``.

    Orders are counted per customer before the join.
    """
    counted = fact_order.groupBy("customer_id", "order_status").agg(F.count("*").alias("n"))
    placed = counted.join(dim_customer.select("customer_id", "country"), "customer_id", "left")
    cells = [
        zero_if_null(F.sum(F.when(F.col("order_status") == s, F.col("n")))).alias(s.lower()) for s in ORDER_STATUSES
    ]
    known = F.coalesce(F.col("order_status").isin(*ORDER_STATUSES), F.lit(False))
    cells.append(zero_if_null(F.sum(F.when(~known, F.col("n")))).alias("other"))
    return placed.groupBy("country").agg(*cells)


def order_trend(fact_order: DataFrame) -> DataFrame:
    """Orders per month."""
    return fact_order.groupBy(F.trunc("order_date", "month").alias("order_month")).agg(
        F.count("*").alias("total_orders")
    )


def geo_orders(fact_order: DataFrame, fact_order_item: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders and ordered quantity per country and region.

    Quantities are summed per order, then orders per customer, so neither a big order
    nor a big customer reaches a join as more than one row.
    """
    per_order = fact_order_item.groupBy("order_id").agg(F.sum("order_quantity").alias("qty"))
    per_customer = fact_order.select("order_id", "customer_id").join(per_order, "order_id", "left").groupBy(
        "customer_id"
    ).agg(F.count("*").alias("orders"), F.sum("qty").alias("qty"))
    placed = per_customer.join(dim_customer.select("customer_id", "country", "region"), "customer_id", "left")
    return placed.groupBy("country", "region").agg(
        F.sum("orders").alias("total_orders"), zero_if_null(F.sum("qty")).alias("total_ordered_qty")
    )


def on_time_gauge(analytics: DataFrame, target_pct: float = 95.0) -> DataFrame:
    """On-time rate against a target."""
    rate = F.col("on_time_rate_pct")
    return kpis.on_time_rate(analytics).select(
        "on_time_rate_pct", "matched_items", F.lit(float(target_pct)).alias("target_pct"),
        F.round(rate - target_pct, 2).alias("gap_to_target_pct"), (rate >= target_pct).cast("int").alias("target_met"),
    )


def kpi_cards(
    fact_order: DataFrame, fact_order_item: DataFrame, fact_delivery: DataFrame,
    fact_delivery_item: DataFrame, analytics: DataFrame,
) -> DataFrame:
    """KPI 2, 4, 8 and 9 as one row."""
    cards = [
        kpis.processing_days(fact_order, fact_delivery),
        kpis.fulfillment_pct(fact_order_item, fact_delivery_item),
        kpis.customer_fulfillment_pct(fact_order),
        kpis.on_time_rate(analytics).select("on_time_rate_pct"),
    ]
    names = [c.columns[0] for c in cards]
    tagged = [c.select(F.lit(n).alias("name"), F.col(n).alias("value")) for c, n in zip(cards, names)]
    return stack_rows(tagged).agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in names])


def outstanding_total(fact_order_item: DataFrame, fact_delivery_item: DataFrame) -> DataFrame:
    """Items and units still outstanding."""
    return kpis.outstanding(fact_order_item, fact_delivery_item).agg(
        F.count("*").alias("outstanding_items"), zero_if_null(F.sum("outstanding_qty")).alias("outstanding_units")
    )
