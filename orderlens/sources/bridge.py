"""The eight source sheets, derived from TPC-H-like ``orders`` and ``lineitem`` tables.

Deliveries and shipments do not exist in those tables. A delivery is taken to be the
finished lines (``l_linestatus = 'F'``) of one order from one supplier, and each
delivery travels as one shipment. Columns without a counterpart are null.
"""

from __future__ import annotations

from decimal import Decimal
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.schema import SHEETS
from orderlens.session import materialize, materialize_by, parts_of_shuffles, run_together
from orderlens.sources.tables import LazyTables

# A delivery's id is its order's times this plus the number of its supplier within the order.
# An order of more suppliers fails instead of sharing ids.
DELIVERIES_PER_ORDER = 10_000
SHIPMENT_ID_BASE = 10_000_000_000
REQUESTED_AFTER_DAYS = 30
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

ORDER_STATUS = {"O": "Open", "F": "Delivered", "P": "Closed"}
ITEM_STATUS = {"O": "Open", "F": "Delivered"}
DELIVERY_STATUS = {"N": "Delivered", "A": "Open", "R": "Returned"}


def _decode(code: Column, labels: dict[str, str], otherwise: Column | None = None) -> Column:
    out = F
    for letter, label in labels.items():
        out = out.when(code == ord(letter), label)
    return out if otherwise is None else out.otherwise(otherwise)


def _code(name: str) -> Column:
    """A one-letter flag as its code point: a number, so max() stays a hash aggregate."""
    return F.ascii(name)


class Bridge:
    """Sheets over one folder of driver tables. Every method is lazy."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root
        # Opening a Parquet table reads its footer, so open each one once.
        self.table = cache(lambda name: spark.read.parquet(f"{root}/{name}.parquet"))

    def sheets(self) -> LazyTables:
        """All sheets with all their columns."""
        return LazyTables({name: getattr(self, name.lower()) for name in SHEETS})

    def lean_sheets(self, requested_date: bool = False) -> LazyTables:
        """All sheets, those made of lines without what only their order knows.

        Saves a join per sheet where customer and priority are not asked for;
        ``requested_date`` keeps the one on order items.
        """
        return self.sheets().replace(
            VBAP=lambda: self.vbap(with_order=requested_date),
            LIKP=lambda: self.likp(with_order=False),
            LIPS=lambda: self.lips(with_order=False),
            VTTK=lambda: self.vttk(with_order=False),
            VTTP=lambda: self.vttp(with_order=False),
        )

    def landed_sheets(self, *names: str) -> LazyTables:
        """All sheets, for jobs that read several of those made of lines, or one several times.

        Finished lines are numbered and meet their order once, for all four sheets made of them, and are written to the
        shared folder with what their delivery as a whole has; one line of a delivery stands for it. The sheets ``names``
        are written too. What is made of lines is dealt by order once, grouped and joined there, and written in buckets
        of orders, so that no reader deals it again to put an order's rows together.
        """
        parts = parts_of_shuffles(self.spark)  # as many as what meets them is dealt in
        makers = {n: lambda n=n: materialize(self.sheets()[n], n, "zstd") for n in names}
        if "VBAP" in makers:
            makers["VBAP"] = lambda: _vbap(materialize_by(self._items(True, parts).drop("o_orderkey", "o_custkey", "o_orderpriority"), "l_orderkey", parts, "items"), True)
        lines, *own = run_together([
            lambda: materialize_by(
                self._with_order(_with_delivery(self._finished("l_linenumber", parts=parts)), True, parts).drop("o_orderkey"),
                "l_orderkey", parts, "finished",
            ),
            *makers.values(),
        ])
        deliveries = lines.where("stands").select(*[
            F.col(f"delivery_{c}").alias(c) if c in _DELIVERY_VALUES else F.col(c)
            for c in ("l_orderkey", "point", "number", "delivery", "o_custkey", "o_orderpriority", *_DELIVERY_VALUES)
        ])
        customer = {"Customer ID": F.col("o_custkey")}
        priority = {"Delivery Priority": F.col("o_orderpriority")}
        return self.sheets().replace(
            LIKP=lambda: _likp(deliveries, customer | priority),
            LIPS=lambda: _lips(lines, customer),
            VTTK=lambda: _vttk(deliveries, customer),
            VTTP=lambda: _vttp(lines, customer),
            **{n: lambda df=df: df for n, df in zip(names, own)},
        )

    def _lines(self, parts: int | None, where: str = "true") -> DataFrame:
        """Order lines with their amounts in units and their flags as numbers; in so many ``parts`` by order, if given."""
        lines = self.table("lineitem").where(where).select(
            "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
            _whole("l_quantity", 3).alias("quantity"), _whole("l_extendedprice", 2).alias("price"),
            _code("l_linestatus").alias("status"), _code("l_returnflag").alias("flag"),
            F.col("l_shipdate").cast("date").alias("day"),
        )
        return lines.repartition(parts, "l_orderkey") if parts else lines

    # -- masters ------------------------------------------------------------
    def _places(self) -> DataFrame:
        return self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey", F.col("n_name").alias("Country"), F.col("r_name").alias("Region")
        )

    def kna1(self) -> DataFrame:
        segment = F
        for i, name in enumerate(SEGMENTS, 1):
            segment = segment.when(F.col("c_mktsegment") == name, i)
        df = self.table("customer").join(self._places(), F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return _fill(df, "KNA1", {
            "Customer ID": F.col("c_custkey").cast("string"),
            "Customer Name": F.col("c_name"),
            "Country": F.col("Country"),
            "Region": F.col("Region"),
            "Phone Number": F.floor("c_acctbal").cast("string"),
            "Customer Group": segment,
        })

    def kna1_mixed_groups(self) -> DataFrame:
        """KNA1 as text from two feeds: one of them names the machinery group instead of numbering it."""
        group = F.col("Customer Group")
        text = F.when(group == len(SEGMENTS), SEGMENTS[-1]).otherwise(group.cast("string"))
        return self.kna1().withColumn("Customer Group", text)

    def kna1_with_addresses(self) -> DataFrame:
        """KNA1 with addresses that hold quotes, commas and line breaks."""
        place = F.concat(F.lit('c/o "'), F.col("Customer Name"), F.lit('", Main\nStreet, '), F.col("Customer ID"))
        return self.kna1().withColumn("Street Address", place)

    def lfa1(self) -> DataFrame:
        df = self.table("supplier").join(self._places(), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        return _fill(df, "LFA1", {
            "Vendor Number": F.col("s_suppkey"),
            "Vendor Name": F.col("s_name"),
            "Country": F.col("Country"),
            "Region": F.col("Region"),
            "Phone Number": F.floor("s_acctbal").cast("string"),
        })

    # -- orders -------------------------------------------------------------
    def vbak(self) -> DataFrame:
        return _fill(self.table("orders"), "VBAK", {
            "Sales Document": F.col("o_orderkey"),
            "Order Date": F.col("o_orderdate").cast("date"),
            "Customer ID": F.col("o_custkey").cast("string"),
            "Order Type": F.col("o_orderpriority"),
            "Order Status": _decode(_code("o_orderstatus"), ORDER_STATUS),
        })

    def vbak_mixed_dates(self) -> DataFrame:
        """VBAK as text from two feeds: closed orders come as month/day/year."""
        day = F.col("Order Date")
        text = F.when(F.col("Order Status") == "Closed", F.date_format(day, "MM/dd/yyyy")).otherwise(
            F.date_format(day, "yyyy-MM-dd")
        )
        return self.vbak().withColumn("Order Date", text)

    def vbap_raw(self) -> DataFrame:
        """Order lines as they come: (order, line) repeats."""
        return _fill(self.table("lineitem"), "VBAP", {
            "Sales Document": F.col("l_orderkey"),
            "Item Number": F.col("l_linenumber"),
            "Material Number": F.col("l_partkey").cast("string"),
            "Quantity": _amount(_whole("l_quantity", 3), 3),
            "Net Price": _amount(_whole("l_extendedprice", 2), 2),
            "Item Status": _decode(_code("l_linestatus"), ITEM_STATUS),
            "Delivery Date": F.col("l_shipdate").cast("date"),
        })

    def _order_fields(self) -> DataFrame:
        return self.table("orders").select(
            "o_orderkey", F.col("o_custkey").cast("string").alias("o_custkey"),
            F.col("o_orderdate").cast("date").alias("o_orderdate"), "o_orderpriority",
        )

    def _with_order(self, df: DataFrame, copies: bool = False, parts: int | None = None) -> DataFrame:
        """``df`` with its order's fields; ``copies`` numbers the rows of an order that repeats, as ``copy``.

        ``parts`` is what ``df`` is dealt in by order, if it is: orders are dealt so too.
        """
        orders = self._order_fields()
        if parts:
            orders = orders.repartition(parts, "o_orderkey")
        if copies:
            of_order = Window.partitionBy("o_orderkey").orderBy("o_custkey", "o_orderpriority")
            orders = orders.drop("o_orderdate").where("o_orderkey IS NOT NULL").withColumn("copy", F.row_number().over(of_order))
        return df.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    def vbap(self, with_order: bool = True) -> DataFrame:
        """Order items. ``with_order=False`` skips the order lookup (no requested date)."""
        return _vbap(self._items(with_order), with_order)

    def _items(self, with_order: bool, parts: int | None = None) -> DataFrame:
        lines = self._lines(parts).groupBy("l_orderkey", "l_linenumber").agg(
            F.min("l_partkey").alias("part"),
            F.sum("quantity").alias("quantity"),
            F.max("price").alias("price"),
            F.max("status").alias("status"),
        )
        return self._with_order(lines, parts=parts) if with_order else lines

    # -- deliveries and shipments -------------------------------------------
    def _finished(self, *extra_keys: str, parts: int | None = None) -> DataFrame:
        """Finished lines per (order, supplier[, line]); read in so many ``parts`` by order, if given.

        Suppliers are numbered within their order after the lines are aggregated: the window sees an
        order's suppliers, or its (supplier, line) pairs where lines are among the keys.
        """
        lines = self._lines(parts, "l_linestatus = 'F'")
        keys = ["l_orderkey", F.col("l_suppkey").alias("point"), *extra_keys]
        number = F.dense_rank().over(Window.partitionBy("l_orderkey").orderBy("point")) - 1
        too_many = F.raise_error(F.concat(F.lit("more deliveries than ids in order "), "l_orderkey"))
        return lines.groupBy(*keys).agg(
            F.max("day").alias("last_day"),
            F.min("day").alias("first_day"),
            F.max("flag").alias("last_flag"),
            F.min("flag").alias("first_flag"),
            F.min("l_partkey").alias("part"),
            F.sum("quantity").alias("quantity"),
            F.max("price").alias("price"),
        ).withColumn("number", number).withColumn("delivery", F.when(
            F.col("number") < DELIVERIES_PER_ORDER, F.col("l_orderkey") * DELIVERIES_PER_ORDER + F.col("number")
        ).otherwise(too_many.cast("bigint")))

    def _finished_with_order(self, with_order: bool, *extra_keys: str) -> tuple[DataFrame, dict[str, Column]]:
        lines = self._finished(*extra_keys)
        if not with_order:
            return lines, {}
        return self._with_order(lines), {"Customer ID": F.col("o_custkey")}

    def likp(self, with_order: bool = True) -> DataFrame:
        """Delivery headers. ``with_order=False`` skips the order lookup (no customer, priority)."""
        lines, customer = self._finished_with_order(with_order)
        if with_order:
            customer["Delivery Priority"] = F.col("o_orderpriority")
        return _likp(lines, customer)

    def lips(self, with_order: bool = True) -> DataFrame:
        """Delivery items. ``with_order=False`` skips the order lookup (no customer)."""
        lines, customer = self._finished_with_order(with_order, "l_linenumber")
        return _lips(lines, customer)

    def vttk(self, with_order: bool = True) -> DataFrame:
        """Shipment headers. ``with_order=False`` skips the order lookup (no customer)."""
        lines, customer = self._finished_with_order(with_order)
        return _vttk(lines, customer)

    def vttp(self, with_order: bool = True) -> DataFrame:
        """Shipment items. ``with_order=False`` skips the order lookup (no customer)."""
        lines, customer = self._finished_with_order(with_order, "l_linenumber")
        return _vttp(lines, customer)


# What a delivery has of all its lines, and how.
_DELIVERY_VALUES = {"last_day": F.max, "first_day": F.min, "last_flag": F.max, "first_flag": F.min}


def _with_delivery(lines: DataFrame) -> DataFrame:
    """Finished lines with the values of their delivery, as ``delivery_<name>``; one line ``stands`` for the delivery."""
    own = Window.partitionBy("l_orderkey", "point").orderBy("l_linenumber")
    whole = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return lines.withColumns(
        {f"delivery_{c}": of(c).over(whole) for c, of in _DELIVERY_VALUES.items()}
        | {"stands": F.row_number().over(own) == 1}
    )


def _vbap(lines: DataFrame, with_order: bool) -> DataFrame:
    values = {
        "Sales Document": F.col("l_orderkey"),
        "Item Number": F.col("l_linenumber"),
        "Material Number": F.col("part").cast("string"),
        "Quantity": _amount(F.col("quantity"), 3),
        "Net Price": _amount(F.col("price"), 2),
        "Item Status": _decode(F.col("status"), ITEM_STATUS),
    }
    if with_order:
        values["Delivery Date"] = F.date_add("o_orderdate", REQUESTED_AFTER_DAYS)
    return _fill(lines, "VBAP", values)


def _likp(lines: DataFrame, orders: dict[str, Column]) -> DataFrame:
    return _fill(lines, "LIKP", orders | {
        "Delivery Number": F.col("delivery"),
        "Delivery Date": F.col("last_day"),
        "Sales Document": F.col("l_orderkey"),
        "Shipping Point": F.concat(F.lit("SP"), F.col("point").cast("string")),
        "Delivery Status": _decode(F.col("last_flag"), DELIVERY_STATUS),
        "Shipping Status": _decode(F.col("first_flag"), {"A": "Not Shipped"}, F.lit("Shipped")),
        "Route": F.col("number").cast("int"),
    })


def _lips(lines: DataFrame, orders: dict[str, Column]) -> DataFrame:
    return _fill(lines, "LIPS", orders | {
        "Delivery Number": F.col("delivery"),
        "Item Number": F.col("l_linenumber"),
        "Material Number": F.col("part").cast("string"),
        "Delivered Quantity": _amount(F.col("quantity"), 3),
        "Net Price": _amount(F.col("price"), 2),
        "Delivery Status": _decode(F.col("last_flag"), DELIVERY_STATUS),
        "Sales Document": F.col("l_orderkey"),
        "Sales Item": F.col("l_linenumber"),
        "Delivery Date": F.col("last_day"),
    })


def _vttk(lines: DataFrame, orders: dict[str, Column]) -> DataFrame:
    return _fill(lines, "VTTK", orders | {
        "Shipment Number": F.col("delivery") + SHIPMENT_ID_BASE,
        "Shipment Date": F.col("first_day"),
        "Sales Document": F.col("l_orderkey"),
        "Delivery Number": F.col("delivery"),
        "Shipping Point": F.concat(F.lit("SP"), F.col("point").cast("string")),
        "Carrier": F.concat(F.lit("Carrier"), (F.col("point") % 3 + 1).cast("string")),
        "Shipment Status": _decode(F.col("last_flag"), {"N": "Delivered"}, F.lit("In Transit")),
        "Route": F.col("number").cast("int"),
    })


def _vttp(lines: DataFrame, orders: dict[str, Column]) -> DataFrame:
    return _fill(lines, "VTTP", orders | {
        "Shipment Number": F.col("delivery") + SHIPMENT_ID_BASE,
        "Item Number": F.col("l_linenumber"),
        "Material Number": F.col("part").cast("string"),
        "Shipped Quantity": _amount(F.col("quantity"), 3),
        "Item Status": _decode(F.col("last_flag"), DELIVERY_STATUS),
        "Delivery Number": F.col("delivery"),
        "Sales Document": F.col("l_orderkey"),
        "Sales Item": F.col("l_linenumber"),
        "Shipment Date": F.col("first_day"),
    })


def _whole(name: str, digits: int) -> Column:
    """An amount in units of its last digit: whole numbers add up exactly and fast."""
    return F.rint(F.col(name) * 10**digits).cast("bigint")


def _amount(units: Column, digits: int) -> Column:
    """Back from units to a decimal."""
    unit = F.lit(Decimal(1).scaleb(-digits))
    return (units.cast("decimal(18,0)") * unit).cast(f"decimal(18,{digits})")


def _fill(df: DataFrame, sheet: str, values: dict[str, Column]) -> DataFrame:
    """All columns of a sheet in order; those without a value are typed nulls."""
    return df.select(*[
        values.get(c.header, F.lit(None)).cast(c.spark_type).alias(c.header) for c in SHEETS[sheet].columns
    ])
