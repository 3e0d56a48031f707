"""The data model: source sheets, warehouse tables, keys and check rules.

Every value here is a fixed value: it must equal the names, types and keys of
the data this library reads and the tables it writes.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Column:
    """One source column and the names it takes downstream."""

    header: str
    sql_type: str
    warehouse: str
    mart: str = ""

    @property
    def mart_name(self) -> str:
        return self.mart or self.warehouse

    @property
    def spark_type(self) -> str:
        """Type of the column in a DataFrame (VARCHAR lengths are a table property)."""
        return "string" if self.sql_type.startswith("VARCHAR") else self.sql_type.lower()


@dataclass(frozen=True)
class Sheet:
    name: str
    table: str
    key: tuple[str, ...]
    columns: tuple[Column, ...]
    table_order: tuple[str, ...]

    @property
    def headers(self) -> list[str]:
        return [c.header for c in self.columns]


def _sheet(name: str, table: str, key: tuple[str, ...], columns: list[tuple], order: tuple[str, ...] = ()) -> Sheet:
    cols = tuple(Column(*c) for c in columns)
    return Sheet(name, table, key, cols, order or tuple(c.warehouse for c in cols))


# --- fixed values: the eight source sheets ---------------------------------
# (source header, warehouse type, warehouse name[, mart name if different])
SHEETS: dict[str, Sheet] = {
    s.name: s
    for s in (
        _sheet("KNA1", "dim_customer", ("Customer ID",), [
            ("Customer ID", "VARCHAR(30)", "customer_id"),
            ("Customer Name", "VARCHAR(150)", "customer_name"),
            ("Country", "VARCHAR(50)", "country"),
            ("Region", "VARCHAR(100)", "region"),
            ("City", "VARCHAR(100)", "city"),
            ("Postal Code", "VARCHAR(30)", "postal_code"),
            ("Street Address", "VARCHAR(200)", "street_address"),
            ("Phone Number", "VARCHAR(50)", "phone_number"),
            ("Email Address", "VARCHAR(150)", "email_address"),
            ("Language", "VARCHAR(10)", "language"),
            ("Tax Number", "VARCHAR(50)", "tax_number"),
            ("Customer Group", "INT", "customer_group"),
            ("Sales Organization", "INT", "sales_organization"),
            ("Distribution Channel", "INT", "distribution_channel"),
            ("Division", "INT", "division"),
        ]),
        _sheet("LFA1", "dim_vendor", ("Vendor Number",), [
            ("Vendor Number", "BIGINT", "vendor_number"),
            ("Vendor Name", "VARCHAR(150)", "vendor_name"),
            ("Country", "VARCHAR(50)", "country"),
            ("Region", "VARCHAR(100)", "region"),
            ("City", "VARCHAR(100)", "city"),
            ("Postal Code", "VARCHAR(30)", "postal_code"),
            ("Street Address", "VARCHAR(200)", "street_address"),
            ("Phone Number", "VARCHAR(50)", "phone_number"),
            ("Email Address", "VARCHAR(150)", "email_address"),
            ("Language", "VARCHAR(10)", "language"),
            ("Tax Number", "VARCHAR(50)", "tax_number"),
            ("Payment Terms", "VARCHAR(30)", "payment_terms"),
        ]),
        _sheet("VBAK", "fact_order", ("Sales Document",), [
            ("Sales Document", "BIGINT", "order_id"),
            ("Order Date", "DATE", "order_date"),
            ("Customer ID", "VARCHAR(30)", "customer_id"),
            ("Order Type", "VARCHAR(30)", "order_type"),
            ("Sales Organization", "INT", "sales_organization"),
            ("Distribution Channel", "INT", "distribution_channel"),
            ("Division", "INT", "division"),
            ("Order Status", "VARCHAR(50)", "order_status"),
        ], (
            "order_id", "customer_id", "order_date", "order_type", "sales_organization", "distribution_channel",
            "division", "order_status",
        )),
        _sheet("VBAP", "fact_order_item", ("Sales Document", "Item Number"), [
            ("Sales Document", "BIGINT", "order_id"),
            ("Item Number", "INT", "item_number"),
            ("Material Number", "VARCHAR(50)", "product_id"),
            ("Quantity", "DECIMAL(18,3)", "order_quantity"),
            ("Net Price", "DECIMAL(18,2)", "net_price", "unit_price"),
            ("Item Status", "VARCHAR(50)", "item_status"),
            ("Delivery Date", "DATE", "requested_delivery_date"),
        ]),
        _sheet("LIKP", "fact_delivery", ("Delivery Number",), [
            ("Delivery Number", "BIGINT", "delivery_id"),
            ("Delivery Date", "DATE", "delivery_date", "delivery_header_date"),
            ("Sales Document", "BIGINT", "order_id"),
            ("Shipping Point", "VARCHAR(50)", "shipping_point"),
            ("Shipping Type", "VARCHAR(50)", "shipping_type"),
            ("Delivery Status", "VARCHAR(50)", "delivery_status", "delivery_header_status"),
            ("Shipping Status", "VARCHAR(50)", "shipping_status"),
            ("Route", "INT", "route"),
            ("Delivery Priority", "VARCHAR(30)", "delivery_priority"),
            ("Customer ID", "VARCHAR(30)", "customer_id"),
        ], (
            "delivery_id", "order_id", "customer_id", "delivery_date", "delivery_status", "shipping_status",
            "shipping_point", "shipping_type", "route", "delivery_priority",
        )),
        _sheet("LIPS", "fact_delivery_item", ("Delivery Number", "Item Number"), [
            ("Delivery Number", "BIGINT", "delivery_id"),
            ("Item Number", "INT", "item_number"),
            ("Material Number", "VARCHAR(50)", "product_id"),
            ("Delivered Quantity", "DECIMAL(18,3)", "delivered_quantity"),
            ("Net Price", "DECIMAL(18,2)", "net_price", "unit_price"),
            ("Delivery Status", "VARCHAR(50)", "item_delivery_status"),
            ("Customer ID", "VARCHAR(30)", "customer_id"),
            ("Sales Document", "BIGINT", "order_id"),
            ("Sales Item", "INT", "sales_item"),
            ("Delivery Date", "DATE", "delivery_date"),
        ], (
            "delivery_id", "item_number", "product_id", "order_id", "customer_id", "sales_item", "delivered_quantity",
            "net_price", "item_delivery_status", "delivery_date",
        )),
        _sheet("VTTK", "fact_shipment", ("Shipment Number",), [
            ("Shipment Number", "BIGINT", "shipment_id"),
            ("Shipment Date", "DATE", "shipment_date", "shipment_header_date"),
            ("Sales Document", "BIGINT", "order_id"),
            ("Delivery Number", "BIGINT", "delivery_id"),
            ("Shipping Point", "VARCHAR(50)", "shipping_point"),
            ("Carrier", "VARCHAR(50)", "carrier_name"),
            ("Shipment Status", "VARCHAR(50)", "shipment_status", "shipment_header_status"),
            ("Route", "INT", "route"),
            ("Shipping Type", "VARCHAR(50)", "shipping_type"),
            ("Customer ID", "VARCHAR(30)", "customer_id", "header_customer_id"),
        ], (
            "shipment_id", "delivery_id", "order_id", "customer_id", "carrier_name", "shipping_point",
            "shipment_date", "shipment_status", "route", "shipping_type",
        )),
        _sheet("VTTP", "fact_shipment_item", ("Shipment Number", "Item Number"), [
            ("Shipment Number", "BIGINT", "shipment_id"),
            ("Item Number", "INT", "item_number"),
            ("Material Number", "VARCHAR(50)", "product_id"),
            ("Shipped Quantity", "DECIMAL(18,3)", "shipped_quantity"),
            ("Item Status", "VARCHAR(50)", "item_status", "item_shipment_status"),
            ("Delivery Number", "BIGINT", "delivery_id"),
            ("Customer ID", "VARCHAR(30)", "customer_id"),
            ("Sales Document", "BIGINT", "order_id"),
            ("Sales Item", "INT", "sales_item"),
            ("Shipment Date", "DATE", "shipment_date"),
        ], (
            "shipment_id", "item_number", "product_id", "delivery_id", "order_id", "customer_id", "sales_item",
            "shipped_quantity", "item_status", "shipment_date",
        )),
    )
}

# --- fixed values: validation rules ----------------------------------------
# (child sheet, child column, parent sheet, parent column)
REFERENCE_RULES = (
    ("VBAK", "Customer ID", "KNA1", "Customer ID"),
    ("VBAP", "Sales Document", "VBAK", "Sales Document"),
    ("LIKP", "Sales Document", "VBAK", "Sales Document"),
    ("LIPS", "Delivery Number", "LIKP", "Delivery Number"),
    ("VTTK", "Delivery Number", "LIKP", "Delivery Number"),
    ("VTTP", "Shipment Number", "VTTK", "Shipment Number"),
)
DATE_RULES = (
    ("VBAK", "Order Date"),
    ("VBAP", "Delivery Date"),
    ("LIKP", "Delivery Date"),
    ("VTTK", "Shipment Date"),
)
SUSPECT_NUMBER_RULES = (("KNA1", "Phone Number"), ("LFA1", "Phone Number"))
DATE_FORMAT = "yyyy-M-d"
CORRUPTED_NUMBER = r"^-\d+$"
DELIVERED = "Delivered"

# --- fixed values: warehouse tables that no single sheet feeds --------------
DERIVED_TABLES: dict[str, tuple[tuple[str, str], ...]] = {
    "dim_carrier": (("carrier_name", "VARCHAR(50)"),),
    "dim_product": (("product_id", "VARCHAR(50)"),),
    "fact_delivery_analytics": (
        ("analytics_id", "BIGINT"),
        ("order_id", "BIGINT"),
        ("item_number", "INT"),
        ("shipment_id", "BIGINT"),
        ("delivery_time_days", "INT"),
        ("on_time", "BOOLEAN"),
        ("delay_reason", "VARCHAR(200)"),
    ),
}

# Parents before children.
LOAD_ORDER = (
    "dim_customer", "dim_vendor", "dim_carrier", "dim_product",
    "fact_order", "fact_order_item", "fact_delivery", "fact_delivery_item",
    "fact_shipment", "fact_shipment_item", "fact_delivery_analytics",
)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "dim_customer": ("customer_id",),
    "dim_vendor": ("vendor_number",),
    "dim_carrier": ("carrier_name",),
    "dim_product": ("product_id",),
    "fact_order": ("order_id",),
    "fact_order_item": ("order_id", "item_number"),
    "fact_delivery": ("delivery_id",),
    "fact_delivery_item": ("delivery_id", "item_number"),
    "fact_shipment": ("shipment_id",),
    "fact_shipment_item": ("shipment_id", "item_number"),
    "fact_delivery_analytics": ("analytics_id",),
}

# (child table, key columns, parent table); parent key columns carry the same names.
FOREIGN_KEYS = (
    ("fact_order", ("customer_id",), "dim_customer"),
    ("fact_order_item", ("order_id",), "fact_order"),
    ("fact_order_item", ("product_id",), "dim_product"),
    ("fact_delivery", ("order_id",), "fact_order"),
    ("fact_delivery", ("customer_id",), "dim_customer"),
    ("fact_delivery_item", ("delivery_id",), "fact_delivery"),
    ("fact_delivery_item", ("product_id",), "dim_product"),
    ("fact_shipment", ("delivery_id",), "fact_delivery"),
    ("fact_shipment", ("carrier_name",), "dim_carrier"),
    ("fact_shipment_item", ("shipment_id",), "fact_shipment"),
    ("fact_shipment_item", ("product_id",), "dim_product"),
    ("fact_delivery_analytics", ("order_id", "item_number"), "fact_order_item"),
    ("fact_delivery_analytics", ("shipment_id",), "fact_shipment"),
)

SHEET_OF_TABLE = {s.table: s.name for s in SHEETS.values()}


def table_columns(table: str) -> tuple[tuple[str, str], ...]:
    """(name, declared type) of a warehouse table, in table order."""
    if table in DERIVED_TABLES:
        return DERIVED_TABLES[table]
    sheet = SHEETS[SHEET_OF_TABLE[table]]
    types = {c.warehouse: c.sql_type for c in sheet.columns}
    return tuple((name, types[name]) for name in sheet.table_order)
