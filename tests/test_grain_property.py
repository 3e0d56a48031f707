"""However deliveries are split, no quantity is counted twice."""

from datetime import date, timedelta
from decimal import Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlens.plans import marts
from tests.test_semantics import DELIVERED, HEADERS, ITEMS, SHIPPED

DAY = date(2025, 2, 1)
orders = st.lists(  # one entry per order: its items, each with the sizes of its deliveries
    st.lists(st.lists(st.integers(1, 50), max_size=4), max_size=3), min_size=1, max_size=5
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(orders)
def test_totals_survive_split_deliveries(spark, book):
    headers, items, delivered, shipped = [], [], [], []
    for o, lines in enumerate(book):
        headers.append((o, "c", DAY, "Open"))
        for n, parts in enumerate(lines):
            items.append((o, n, Decimal(sum(parts) + 1), DAY, "p"))
            for part, size in enumerate(parts):
                key = 1000 * o + 10 * n + part
                delivered.append((key, n, o, n, Decimal(size), "x", DAY + timedelta(days=part)))
                shipped.append((key, o, n, Decimal(size), "x"))
    frame = spark.createDataFrame
    h, i = frame(headers, HEADERS), frame(items, ITEMS)
    d, s = frame(delivered, DELIVERED), frame(shipped, SHIPPED)

    rows = {r["order_id"]: r for r in marts.order_summary(h, i, d, s).collect()}
    for o, lines in enumerate(book):
        sizes = [size for parts in lines for size in parts]
        row = rows[o]
        assert row["total_order_items"] == len(lines)
        assert row["total_ordered_qty"] == sum(sizes) + len(lines)
        assert (row["total_deliveries"] or 0) == len(sizes) and (row["total_delivered_qty"] or 0) == sum(sizes)
        assert row["outstanding_qty"] == len(lines)
        gaps = [part for parts in lines for part in range(len(parts))]
        assert row["avg_delivery_gap_days"] == (sum(gaps) / len(gaps) if gaps else None)

    lines = marts.order_lines(h, i)
    assert lines.count() == sum(max(1, len(lines)) for lines in book)
    assert marts.item_delivery_performance(lines, d).count() == sum(
        max(1, sum(max(1, len(parts)) for parts in lines)) for lines in book
    )
