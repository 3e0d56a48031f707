"""The star schema: four dimensions and seven facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.functions import named
from orderlens.operators.conform import to_table, to_untyped_table
from orderlens.operators.numbering import dense_ids
from orderlens.plans import quality, staging
from orderlens.plans.marts import Marts
from orderlens.schema import LOAD_ORDER, PRIMARY_KEYS, SHEET_OF_TABLE, table_columns
from orderlens.session import run_together, work_path
from orderlens.sources.files import read_optional
from orderlens.sources.tables import session_of

SOURCE_FACTS = (
    "fact_order", "fact_order_item", "fact_delivery", "fact_delivery_item", "fact_shipment", "fact_shipment_item",
)
# Order of the analytics ids: the item, its first shipment, the deliveries, then what is left to tell rows apart.
ANALYTICS_ORDER = [
    "order_id", "item_number", "shipment_id", "delivery_id", "delivery_item", "delivery_time_days", "on_time",
]


def dim_carrier(shipments: DataFrame) -> DataFrame:
    """Carriers actually used. ``shipments`` is the VTTK sheet."""
    return shipments.select(F.col("Carrier").alias("carrier_name")).dropna().distinct()


def dim_product(*items: DataFrame) -> DataFrame:
    """Products named by any of the item sheets."""
    names = [df.select(F.col("`Material Number`").alias("product_id")).dropna().distinct() for df in items]
    union = names[0]
    for more in names[1:]:
        union = union.unionByName(more)
    return union.distinct()


def number_analytics(rows: DataFrame, after: int = 0) -> DataFrame:
    """Analytics rows with their dense ``analytics_id``, counting on from ``after``.

    Rows equal in all the order columns are equal in all that is loaded, so ids repeat
    from run to run, whether the rows carry their delivery's key or not.
    """
    order = [c for c in ANALYTICS_ORDER if c in rows.columns]
    columns = [c for c, _ in table_columns("fact_delivery_analytics")]
    return dense_ids(rows, order, "analytics_id", after, columns[1:]).select(*columns)


def table(sheets: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One warehouse table from the sheets."""
    if name == "dim_carrier":
        return dim_carrier(sheets["VTTK"])
    if name == "dim_product":
        return dim_product(sheets["VBAP"], sheets["LIPS"], sheets["VTTP"])
    if name == "fact_delivery_analytics":
        return number_analytics(Marts(sheets).analytics_rows)
    sheet = SHEET_OF_TABLE[name]
    return to_table(sheets[sheet], sheet)


def tables(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All eleven tables, parents first."""
    return {name: table(sheets, name) for name in LOAD_ORDER}


def untyped_tables(sheets: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables with their sheets' values as they came; derived tables as they are built."""
    found = {n: to_untyped_table(sheets[s], s) for n, s in SHEET_OF_TABLE.items()}
    found["dim_carrier"], found["dim_product"] = table(sheets, "dim_carrier"), table(sheets, "dim_product")
    return {n: found[n] for n in LOAD_ORDER if n in found}


def create_schema(spark: SparkSession, database: str, location: str) -> None:
    """Database and empty tables where absent. Keys are checked, not declared: see ``quality``."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name in LOAD_ORDER:
        columns = ", ".join(f"{c} {t}" for c, t in table_columns(name))
        # Appended loads are folders inside the table's.
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true')")


def load(
    sheets: Mapping[str, DataFrame],
    database: str = "orderlens_dw",
    location: str | None = None,
    analytics: DataFrame | str | None = None,
    with_analytics: bool = True,
    append: bool = False,
    validate: bool = True,
) -> dict[str, DataFrame]:
    """Create and fill the warehouse; returns the loaded tables.

    Loading replaces the rows, so it can be run again; ``append`` adds to them instead, and leaves out carriers
    and products that are there already. ``analytics`` takes analytics rows made earlier, or the path they were
    written to: where nothing was written, a warning says so and the table gets no rows. Otherwise they are built
    from the sheets, unless ``with_analytics`` is off. ``validate`` checks primary and foreign keys.

    All tables are staged first, see ``staging``: whatever fails, a value that does not fit its column, a broken
    key or a table that cannot be moved, every table keeps the rows it had. Values that do not fit are named by
    table and column, broken keys by rule. What was checked is what was written: no table is derived twice.
    """
    spark = session_of(sheets)
    create_schema(spark, database, location or work_path(spark, database))
    staging.recover(spark, database)
    held = {name: spark.table(f"{database}.{name}") for name in LOAD_ORDER}
    coming = {n: table(sheets, n) for n in LOAD_ORDER if n != "fact_delivery_analytics"}
    if append:
        for name in ("dim_carrier", "dim_product"):
            coming[name] = coming[name].join(held[name], list(PRIMARY_KEYS[name]), "left_anti")
    rows = _analytics_rows(spark, sheets, analytics) if with_analytics else None
    if rows is not None:
        last = held["fact_delivery_analytics"].agg(F.max("analytics_id")).first()[0] if append else None
        coming["fact_delivery_analytics"] = number_analytics(rows, last or 0)
    elif not append:
        coming["fact_delivery_analytics"] = held["fact_delivery_analytics"].limit(0)
    staged = staging.StagedLoad(spark, database, append)
    try:
        _stage(staged, coming, sheets)
        if validate:
            require_keys(staged.rows, held if append else None)
    except Exception:
        staged.discard()
        raise
    staged.publish()
    return {name: spark.table(f"{database}.{name}") for name in LOAD_ORDER}


def _analytics_rows(spark: SparkSession, sheets: Mapping[str, DataFrame], analytics: DataFrame | str | None) -> DataFrame | None:
    if analytics is None:
        return Marts(sheets).analytics_rows
    return read_optional(spark, analytics) if isinstance(analytics, str) else analytics


def _stage(staged: staging.StagedLoad, coming: Mapping[str, DataFrame], sheets: Mapping[str, DataFrame]) -> None:
    """Stage the tables; if a value does not fit, say which table and column has how many."""
    try:
        staged.stage(coming)
    except Exception as error:
        found = quality.type_violations(untyped_tables(sheets)).where("violating_rows > 0").collect()
        if not found:
            raise
        named_ = "; ".join(f"{r['table']}.{r['column']} {r['declared']}: {r['violating_rows']} rows" for r in found)
        raise ValueError(f"values that do not fit: {named_}") from error


def require_keys(tables: Mapping[str, DataFrame], held: Mapping[str, DataFrame] | None = None) -> None:
    """Raise if a table breaks its primary key or a reference. At most one row per rule is fetched.

    With ``held``, the ``tables`` are written rows to be added to those: the rows that are there are looked up
    by the keys that come, and are neither grouped nor checked again.
    """
    checks = [
        lambda: [
            f"{r['table']} primary key: {r['duplicate_rows']} duplicate, {r['null_key_rows']} null"
            for r in quality.primary_key_violations(tables).where("duplicate_rows > 0 OR null_key_rows > 0").collect()
        ],
        lambda: [
            f"{r['table']} primary key: {r['repeated_keys']} keys are there already"
            for r in quality.appended_key_violations(held, tables).where("repeated_keys > 0").collect()
        ] if held is not None else [],
        lambda: [
            f"{r['child']}({r['key']}) -> {r['parent']}: {r['violating_rows']} rows"
            for r in (
                quality.foreign_key_violations(tables) if held is None else quality.appended_reference_violations(held, tables)
            ).where("violating_rows > 0").collect()
        ],
    ]
    broken = [line for found in run_together(checks) for line in found]
    if broken:
        raise ValueError("key violations: " + "; ".join(broken))
