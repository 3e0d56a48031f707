"""Column expressions. Each takes and returns ``Column``; all stay JVM-side."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.schema import CORRUPTED_NUMBER, DATE_FORMAT


def lenient_date(col: Column) -> Column:
    """Text to date; anything unparseable becomes null instead of failing the job."""
    return F.try_to_date(col, DATE_FORMAT)


def day_gap(actual: Column, requested: Column) -> Column:
    """Calendar days from ``requested`` to ``actual``; negative when early."""
    return F.datediff(actual, requested)


def on_time(actual: Column, requested: Column) -> Column:
    """Three-valued on-time flag.

    Null while nothing was delivered. Once delivered it is true or false: with no
    requested date to compare against, the delivery does not count as on time.
    """
    met = F.coalesce(day_gap(actual, requested) <= 0, F.lit(False))
    return F.when(actual.isNotNull(), met)


def looks_corrupted(col: Column) -> Column:
    """A formatted number (such as a phone number) that holds a bare negative integer."""
    return col.cast("string").rlike(CORRUPTED_NUMBER)


def zero_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def joined_text(values: Column) -> Column:
    """The distinct values of an array of texts, sorted and joined; '' for an empty one."""
    return F.concat_ws(", ", F.array_sort(F.array_distinct(values)))


def mean2(total: Column, n: Column) -> Column:
    """Mean to two decimals; null, not an error, over nothing."""
    return F.round(F.try_divide(total.cast("double"), n.cast("double")), 2)


def percent2(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``, to two decimals."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), 2)


def any_null(cols: Iterable[str]) -> Column:
    """True where at least one of the named columns is null."""
    return reduce(or_, [named(c).isNull() for c in cols])


def named(name: str) -> Column:
    """Column by its exact name, which may hold spaces."""
    return F.col(f"`{name}`")
