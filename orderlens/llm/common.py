"""Helpers that several operators share: landing, components of links, typed empties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import materialize

#: Words are runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def _order(node: str, turn: int) -> Column:
    """Another pseudorandom order of the nodes each turn, so that no chain stays sorted."""
    return F.struct(F.xxhash64(F.col(node), F.lit(turn)).alias("h"), F.col(node).alias("id"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (id, root) per id that has an edge.

    ``root`` is one member of the component, the same for all its members. Every turn each
    node points to the first of its neighbours and itself in a pseudorandom order, then the
    edges are contracted; the number of nodes falls by a constant factor a turn. Both steps
    pre-aggregate, so a hub with any number of edges is one row per task, and the join on a
    hub's id is one that adaptive execution splits. Tables in the shared folder cut lineage.
    """
    a, b = F.col("a"), F.col("b")
    left = materialize(
        edges.where(a != b).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), label
    )
    maps: list[DataFrame] = []
    while not left.isEmpty():
        turn = len(maps)
        both = left.unionByName(left.select(b.alias("a"), a.alias("b")))
        first = both.groupBy("a").agg(F.min(_order("b", turn)).alias("first"))
        step = materialize(
            first.select(a.alias("id"), F.least(F.col("first"), _order("a", turn))["id"].alias("to")), label
        )
        to_a = step.select(F.col("id").alias("a"), F.col("to").alias("to_a"))
        to_b = step.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        moved = left.join(to_a, "a").join(to_b, "b").where("to_a != to_b")
        left = materialize(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), label
        )
        maps.append(step)
    if not maps:
        return left.select(a.alias("id"), b.alias("root"))

    def follow(known: DataFrame, step: DataFrame) -> DataFrame:
        ends = step.select(F.col("id").alias("root"), "to")
        return known.join(ends, "root", "left").select("id", F.coalesce("to", "root").alias("root"))

    start = maps[0].select("id", F.col("to").alias("root"))
    return materialize(reduce(follow, maps[1:], start), label)


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
