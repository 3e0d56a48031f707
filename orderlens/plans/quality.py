"""Validation of the source sheets and of the loaded warehouse. Reports, never edits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions import any_null, lenient_date, named
from orderlens.operators import checks
from orderlens.operators.checks import stack_rows
from orderlens.operators.joins import held_keys, orphan_rows, orphan_values, reference_gaps, repeated_keys
from orderlens.schema import (
    DATE_RULES, DELIVERED, FOREIGN_KEYS, PRIMARY_KEYS, REFERENCE_RULES, SHEETS, SUSPECT_NUMBER_RULES, table_columns,
)
from orderlens.session import materialize, run_together
from orderlens.sources.files import write_csv

Tables = Mapping[str, DataFrame]


# Check and rule names are fixed values.
# -- source sheets ----------------------------------------------------------
def profile(sheets: Tables) -> DataFrame:
    return stack_rows([checks.profile(df, n, list(SHEETS[n].key)) for n, df in sheets.items()])


def duplicates(sheets: Tables) -> DataFrame:
    return stack_rows(run_together([
        lambda df=df, n=n: checks.duplicates(df, n, list(SHEETS[n].key)) for n, df in sheets.items()
    ]))


def duplicate_keys(sheets: Tables) -> DataFrame:
    return stack_rows([checks.duplicate_keys(df, n, list(SHEETS[n].key)) for n, df in sheets.items()])


def full_row_duplicates(sheets: Tables) -> DataFrame:
    return duplicates(sheets).where(F.col("check") == "full_row_duplicate")


def _sheet_gaps(sheets: Tables, rules: Sequence[tuple[str, str, str, str]], null_is_orphan: bool = False) -> DataFrame:
    """Reference rules (child, column, parent, key); those whose parents share a key are answered by one grouping."""
    found = []
    for key in dict.fromkeys(key for _, _, _, key in rules):
        own = [(child, column, parent) for child, column, parent, k in rules if k == key]
        columns = {parent: key for _, _, parent in own} | {child: column for child, column, _ in own}
        members = {name: (sheets[name], [column]) for name, column in columns.items()}
        found.append(reference_gaps(members, [(child, [parent]) for child, _, parent in own], null_is_orphan).select(
            "child", F.lit(key).alias("column"), F.col("parents").alias("parent"), "orphan_values"
        ))
    return stack_rows(found)


def orphans(sheets: Tables, rules: Sequence[tuple[str, str, str, str]] = REFERENCE_RULES) -> DataFrame:
    """Distinct child values that the parent lacks, per rule."""
    name = F.concat(F.lit("orphan_"), F.col("column"), F.lit("_to_"), F.col("parent"))
    return _sheet_gaps(sheets, rules).select(F.col("child").alias("table"), name.alias("check"), F.col("orphan_values").alias("issue_count"))


# Item sheets against their header sheets.
SUBSET_RULES = (
    ("VBAP", "Sales Document", "VBAK", "Sales Document"),
    ("LIPS", "Delivery Number", "LIKP", "Delivery Number"),
    ("VTTP", "Shipment Number", "VTTK", "Shipment Number"),
)


def subset_violations(sheets: Tables) -> DataFrame:
    """Item sheets against their header sheets; here a missing key is a violation too."""
    name = F.concat(F.lit("not_in_"), F.col("parent"), F.lit("_"), F.col("column"))
    found = _sheet_gaps(sheets, SUBSET_RULES, null_is_orphan=True)
    return found.select(F.col("child").alias("table"), name.alias("check"), F.col("orphan_values").alias("issue_count"))


def unparseable_dates(sheets: Tables) -> DataFrame:
    return stack_rows([checks.unparseable_dates(sheets[n], n, column) for n, column in DATE_RULES])


def corrupted_numbers(sheets: Tables) -> DataFrame:
    return stack_rows([checks.corrupted_numbers(sheets[n], n, column) for n, column in SUSPECT_NUMBER_RULES])


def unmapped_carriers(sheets: Tables) -> DataFrame:
    """Distinct carriers; by the reported rule none of them maps to a vendor."""
    carriers = sheets["VTTK"].agg(F.count_distinct("Carrier").alias("issue_count"))
    return carriers.select(
        F.lit("VTTK").alias("table"), F.lit("carrier_not_mappable_to_LFA1_vendor").alias("check"), "issue_count"
    )


def carriers_against_vendors(sheets: Tables) -> DataFrame:
    """The comparison behind that rule: carriers, and those that are no vendor's name."""
    missing = orphan_values(sheets["VTTK"], "Carrier", sheets["LFA1"], "Vendor Name").agg(
        F.count("*").alias("issue_count")
    )
    compared = missing.select(
        F.lit("VTTK").alias("table"), F.lit("carrier_without_LFA1_vendor_name").alias("check"), "issue_count"
    )
    return unmapped_carriers(sheets).unionByName(compared)


def delivered_without_records(sheets: Tables) -> DataFrame:
    """Orders marked delivered that no delivery item and no shipment item mentions."""
    key = ["Sales Document"]
    done = sheets["VBAK"].where(F.col("`Order Status`") == DELIVERED)
    members = {"VBAK": (done, key), "LIPS": (sheets["LIPS"], key), "VTTP": (sheets["VTTP"], key)}
    return reference_gaps(members, [("VBAK", ["LIPS", "VTTP"])]).select(
        F.lit("VBAK").alias("table"),
        F.lit("order_status_delivered_but_no_delivery_or_shipment_record").alias("check"),
        F.col("orphan_values").alias("issue_count"),
    )


def report(sheets: Tables) -> DataFrame:
    """The whole validation report, one row per table and check."""
    return stack_rows([
        profile(sheets),
        duplicates(sheets),
        orphans(sheets),
        unparseable_dates(sheets),
        corrupted_numbers(sheets),
        unmapped_carriers(sheets),
        delivered_without_records(sheets),
    ])


def export_report(rows: DataFrame, path: str) -> None:
    """The report as CSV, sorted by table and check. It is written first: sorting by range reads it twice."""
    write_csv(materialize(rows, "report"), path, order_by=["table", "check"])


def nonnegative_quantities(sheets: Tables) -> DataFrame:
    return stack_rows([
        checks.negative_values(sheets["VBAP"], "VBAP", "Quantity"),
        checks.negative_values(sheets["LIPS"], "LIPS", "Delivered Quantity"),
        checks.negative_values(sheets["VTTP"], "VTTP", "Shipped Quantity"),
    ])


def join_cardinality(one_sides: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Per join rule, the keys that repeat on the side that must be unique."""
    return stack_rows([
        repeated_keys(df, keys).agg(F.count("*").alias("violating_keys")).select(
            F.lit(rule).alias("rule"), "violating_keys"
        )
        for rule, (df, keys) in one_sides.items()
    ])


def grain_check(name: str, derived: DataFrame, sources: list[DataFrame]) -> DataFrame:
    """Rows of a derived table against the rows its sources account for."""
    expected = stack_rows([s.agg(F.count("*").alias("expected_rows")) for s in sources])
    rows = derived.agg(F.count("*").alias("derived_rows")).select(
        "derived_rows", F.lit(0).cast("bigint").alias("expected_rows")
    )
    both = rows.unionByName(expected, allowMissingColumns=True)
    return both.agg(F.sum("derived_rows").alias("derived_rows"), F.sum("expected_rows").alias("expected_rows")).select(
        F.lit(name).alias("table"), "derived_rows", "expected_rows",
        (F.col("derived_rows") - F.col("expected_rows")).alias("surplus_rows"),
    )


# -- warehouse tables -------------------------------------------------------
def primary_key_violations(tables: Tables) -> DataFrame:
    """Rows that share a primary key, and rows with a null in it."""
    frames = []
    for name, df in tables.items():
        keys = list(PRIMARY_KEYS[name])
        groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
        held = F.coalesce(F.sum("n"), F.lit(0))
        frames.append(
            groups.agg(
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("duplicate_rows"),
                F.coalesce(F.sum(F.when(any_null(keys), F.col("n"))), F.lit(0)).alias("null_key_rows"),
                held.alias("row_count"),
            ).select(F.lit(name).alias("table"), "row_count", "duplicate_rows", "null_key_rows")
        )
    return stack_rows(frames)


def foreign_key_violations(tables: Tables) -> DataFrame:
    """Rows whose reference has no parent, per rule; the rules on one parent share a grouping."""
    found = []
    for parent, keys in dict.fromkeys((parent, keys) for _, keys, parent in FOREIGN_KEYS):
        children = [child for child, k, p in FOREIGN_KEYS if (p, k) == (parent, keys)]
        members = {name: (tables[name], list(keys)) for name in (parent, *children)}
        found.append(reference_gaps(members, [(child, [parent]) for child in children]).select(
            "child", F.lit(",".join(keys)).alias("key"), F.col("parents").alias("parent"), F.col("orphan_rows").alias("violating_rows"),
        ))
    return stack_rows(found)


# -- an appended batch against the tables it is added to ----------------------
def appended_key_violations(held: Tables, coming: Tables) -> DataFrame:
    """(table, repeated_keys): keys of coming rows that the table holds already; ``coming`` is written."""
    return stack_rows([
        held_keys(held[name], rows.dropna(subset=list(PRIMARY_KEYS[name])), list(PRIMARY_KEYS[name])).agg(
            F.count("*").alias("repeated_keys")
        ).select(F.lit(name).alias("table"), "repeated_keys")
        for name, rows in coming.items()
    ])


def appended_reference_violations(held: Tables, coming: Tables) -> DataFrame:
    """As foreign_key_violations, for coming rows: a parent may come with them or be held already."""
    found = []
    for child, keys, parent in FOREIGN_KEYS:
        if child not in coming:
            continue
        key = list(keys)
        known = coming.get(parent, held[parent].limit(0))
        wanted = materialize(orphan_rows(coming[child], key, known), "wanted")
        missing = wanted.join(held_keys(held[parent], wanted, key), key, "left_anti")
        found.append(missing.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("violating_rows")).select(
            F.lit(child).alias("child"), F.lit(",".join(keys)).alias("key"), F.lit(parent).alias("parent"), "violating_rows",
        ))
    return stack_rows(found)


def _fits(column: str, have: str, sql_type: str) -> tuple[F.Column, F.Column]:
    """(violation, longest text) of a value of type ``have`` against its declared type."""
    col = named(column)
    if sql_type == "DATE" and have == "string":
        return col.isNotNull() & lenient_date(col).isNull(), F.lit(None).cast("int")
    if sql_type.startswith("VARCHAR"):
        limit = int(sql_type[len("VARCHAR("):-1])
        return F.length(col) > limit, F.max(F.length(col))
    return col.isNotNull() & col.try_cast(sql_type.lower()).isNull(), F.lit(None).cast("int")


def type_violations(tables: Tables) -> DataFrame:
    """Values too long, out of range or of another kind for their declared column, in one scan per table.

    Give it tables whose values are as they came, see ``warehouse.untyped_tables``: a typed column holds
    nothing that does not fit.
    """
    frames = []
    for name, df in tables.items():
        columns = [(c, t) for c, t in table_columns(name) if c in df.columns]
        measures = []
        for column, sql_type in columns:
            bad, longest = _fits(column, df.schema[column].dataType.simpleString(), sql_type)
            measures.append(F.struct(
                F.lit(column).alias("column"), F.lit(sql_type).alias("declared"),
                longest.alias("longest"), F.count_if(bad).alias("violating_rows"),
            ))
        rows = df.agg(F.array(*measures).alias("m")).select(F.explode("m").alias("m"))
        frames.append(rows.select(F.lit(name).alias("table"), "m.*"))
    return stack_rows(frames)
