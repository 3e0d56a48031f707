"""Joins with a cardinality guard and joins that survive hot keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import any_null, named

# Right rows of one key that a single task should join; also bounds the hot-key list.
ROWS_PER_TASK = 4_000_000


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``; nulls count as equal.

    Partial aggregation keeps one row per key and map task, so a hot key is cheap.
    """
    return df.groupBy(*[named(k) for k in keys]).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def guard_unique(result: DataFrame, one: DataFrame, keys: list[str], what: str) -> DataFrame:
    """``result``, failing at run time if ``one`` repeats a key.

    The check rides along as a union branch that yields no rows or raises. It reads
    only the key columns, needs no action of its own, and leaves the join it guards
    as a plain join, so adaptive execution can still split its hot keys.
    """
    message = F.concat(
        F.lit(f"{what}: key ({', '.join(keys)}) repeats on the side that must be unique, rows: "),
        F.col("n").cast("string"),
    )
    error = F.raise_error(message)
    # Raising in the columns too keeps the branch from being pruned by a filter on nulls.
    empty = repeated_keys(one, keys).where(error.cast("boolean")).select(
        *[error.cast(f.dataType).alias(f.name) for f in result.schema]
    )
    return result.unionByName(empty)


# Groups of keys that are counted first, to find those that can hold a hot key.
KEY_GROUPS = 1 << 14


def hot_keys(df: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Keys of ``df`` with more than ``rows_per_task`` rows, with their row count ``n``; no key is null.

    A key's group, of which there are KEY_GROUPS, has no fewer rows than the key. So groups are counted first, which
    shuffles at most KEY_GROUPS rows a task, and keys only of groups above the bound: mostly none, and then adaptive
    execution leaves the second count out.
    """
    grouped = df.select(*[named(k) for k in on], F.pmod(F.xxhash64(*[named(k) for k in on]), F.lit(KEY_GROUPS)).alias("_group"))
    crowded = grouped.groupBy("_group").agg(F.count("*").alias("n")).where(F.col("n") > rows_per_task)
    suspects = grouped.join(F.broadcast(crowded.select("_group")), "_group", "left_semi")
    return suspects.groupBy(*[named(k) for k in on]).agg(F.count("*").alias("n")).where(F.col("n") > rows_per_task)


def fanout_left_join(
    left: DataFrame, right: DataFrame, on: list[str], row_key: list[str], rows_per_task: int = ROWS_PER_TASK,
    apart: bool = False,
) -> DataFrame:
    """Left join for a right side whose rows may pile up on a few keys.

    Adaptive execution cannot split a hot key on the optional side of an outer join, so
    hot keys are salted here. A key with more than ``rows_per_task`` right rows is hot:
    its right rows are dealt over enough salts to hold that size, and its left rows are
    copied to each salt. There can be at most ``rows / rows_per_task`` hot keys, which
    bounds the broadcast. A hot key has matches by definition, so the unmatched rows its
    copies may leave on an empty salt are dropped; every other row is joined as usual.

    The salt hashes ``row_key``, the columns that tell the right rows of a key apart, and the
    partition: both are the same when a task is run again, and no other column has to be read.

    ``apart`` salts hot keys beside a plain join of all others, which needs no exchange of a side that lies in
    buckets of the key; adaptive execution leaves the salted join out where no key is hot. Both read ``left``, so
    this is for one that is cheap to read.
    """
    right = right.dropna(subset=on)
    columns = [named(c) for c in [*left.columns, *[c for c in right.columns if c not in on]]]
    sizes = hot_keys(right, on, rows_per_task)
    hot = F.broadcast(sizes.select(*on, F.ceil(F.col("n") / rows_per_task).cast("int").alias("_salts")))
    if apart:
        plain = left.join(hot, on, "left_anti").join(right.join(hot, on, "left_anti"), on, "left")
        left, right = left.join(hot, on, "left_semi"), right.join(hot, on, "left_semi")

    deal = F.pmod(F.xxhash64(*[named(c) for c in row_key], F.spark_partition_id()), F.col("_salts"))
    dealt = right.join(hot, on, "left").select(
        *[named(c) for c in right.columns],
        F.coalesce(deal.cast("int"), F.lit(0)).alias("_salt"),
        F.lit(True).alias("_hit"),
    )
    copies = left.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    joined = copies.join(dealt, [*on, "_salt"], "left").where("_salts IS NULL OR _hit").select(*columns)
    return plain.select(*columns).unionByName(joined) if apart else joined


def orphan_values(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str,
                  null_is_orphan: bool = False) -> DataFrame:
    """Distinct child values that no parent row holds.

    A null references nothing and passes, unless ``null_is_orphan``.
    """
    values = child.select(named(child_key).alias("value")).distinct()
    if not null_is_orphan:
        values = values.dropna()
    known = parent.select(named(parent_key).alias("value")).dropna().distinct()
    return values.join(known, "value", "left_anti")


def orphan_rows(child: DataFrame, keys: list[str], parent: DataFrame) -> DataFrame:
    """Child keys with no parent, and how many child rows ``n`` hold each.

    A key with any null part has nothing to reference and passes.
    """
    counted = child.select(*keys).dropna().groupBy(*keys).agg(F.count("*").alias("n"))
    return counted.join(parent.select(*keys).dropna().distinct(), keys, "left_anti")


def reference_gaps(members: Mapping[str, tuple[DataFrame, list[str]]], rules: Sequence[tuple[str, Sequence[str]]],
                   null_is_orphan: bool = False) -> DataFrame:
    """(child, parents, orphan_values, orphan_rows) of rules about one key, from one grouping of that key.

    A member is a table and its key columns. A rule names a child and its parents: a key that the child holds
    and none of the parents does is an orphan. All members are stacked under the key with a tag and counted per
    key, so any number of rules costs one shuffle, which holds one row per key, member and map task. A key with
    a null part references nothing and passes, unless ``null_is_orphan``: then it is an orphan, whatever parents hold.
    """
    width = len(next(iter(members.values()))[1])
    at, keys = {name: k for k, name in enumerate(members)}, [f"_k{k}" for k in range(width)]

    def keyed(name: str) -> DataFrame:
        df, columns = members[name]
        rows = df.select(*[named(c).alias(k) for c, k in zip(columns, keys)], F.lit(at[name]).alias("_member"))
        return rows if null_is_orphan else rows.dropna(subset=keys)

    stacked = reduce(DataFrame.union, map(keyed, members))
    counts = stacked.groupBy(*keys).agg(*[F.count_if(F.col("_member") == k).alias(f"_n{k}") for k in at.values()])

    def found(child: str, parents: Sequence[str]) -> Column:
        alone = reduce(and_, [F.col(f"_n{at[p]}") == 0 for p in parents])
        if null_is_orphan:
            alone = alone | any_null(keys)
        rows = F.col(f"_n{at[child]}")
        return F.struct(
            F.lit(child).alias("child"), F.lit(",".join(parents)).alias("parents"),
            F.count_if(alone & (rows > 0)).alias("orphan_values"), F.coalesce(F.sum(F.when(alone, rows)), F.lit(0)).alias("orphan_rows"),
        )

    return counts.agg(F.array(*[found(*rule) for rule in rules]).alias("_found")).select(F.inline("_found"))


def held_keys(held: DataFrame, coming: DataFrame, keys: list[str]) -> DataFrame:
    """The distinct ``keys`` of ``coming`` that ``held`` has. ``coming`` is written and has no null in its keys.

    Only key columns of ``held`` are read, within the bounds of the coming first key, which Parquet statistics
    skip by; the rows are not shuffled unless the coming keys are too many to broadcast by Spark's own measure,
    and then a runtime filter is open to it. What is joined on is never more than the keys that come.
    """
    wanted = coming.select(*[named(k) for k in keys]).distinct()
    first = named(keys[0])
    least, most = wanted.agg(F.min(first)).scalar(), wanted.agg(F.max(first)).scalar()
    near = held.select(*[named(k) for k in keys]).where((first >= least) & (first <= most))
    return near.join(wanted, keys, "left_semi").distinct()
