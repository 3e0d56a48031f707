"""Near-duplicate documents by MinHash with tensored banding, confirmed on full shingle sets.

A table's key is a pair: one sub-key from each of two small collections. ``SIDE`` sub-keys a
collection, of ``ROWS`` minima each, give SIDE * SIDE tables of 2 * ROWS rows for the price of
2 * SIDE * ROWS minima instead of 2 * SIDE * SIDE * ROWS. A pair of similarity s meets in some
table with probability (1 - (1 - s^ROWS)^SIDE)^2: 0.999 at 0.75, 0.99999 at 0.85.

Exact copies collapse into one set first. A table key can only be shared if both its halves
are, so sub-keys held by a single set are dropped before any pair is formed; most documents end
there. Buckets are never expanded into all pairs: each set is compared with the one that leads
most of its buckets, and links found join components.

Buckets that still hold several components are compared pair by pair across components, in two
exact parts. Call a shingle rare if at most ``RARE`` of the sets left hold it. Pairs that share a
rare shingle are met on it, which is at most RARE partners a shingle. For any other pair no rare
shingle is in the intersection and all are in the union; where that bound allows a link, the pair
is met on the tables again. Edited copies that are too far from each other fall to the bound,
however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import WORD, components, union_all
from orderlens.llm.hashing import mix, shingle_sets
from orderlens.session import materialize

SHINGLE = 5
SIDE = 14
ROWS = 3
#: A link needs 100 * intersection >= PERCENT * union.
PERCENT = 75
RARE = 16

_RANDOM = np.random.Generator(np.random.PCG64(7))
_TIMES = _RANDOM.integers(1, 2**63, 2 * SIDE * ROWS, np.uint64) | np.uint64(1)
_PLUS = _RANDOM.integers(0, 2**63, 2 * SIDE * ROWS, np.uint64)
_WEIGHT = _RANDOM.integers(1, 2**63, ROWS, np.uint64) | np.uint64(1)
#: Shingles hashed at a time, so that a long document needs no more memory than a short one.
_BLOCK = 2048


def minima(shingles: np.ndarray) -> np.ndarray:
    """The document's minimum under each hash function."""
    least = np.full(len(_TIMES), 2**64 - 1, np.uint64)
    for k in range(0, len(shingles), _BLOCK):
        hashed = shingles[k : k + _BLOCK, None] * _TIMES + _PLUS
        np.minimum(least, hashed.min(axis=0), out=least)
    return least


def sub_keys(rows: np.ndarray) -> np.ndarray:
    """Per row of minima 2 * SIDE sub-keys, the first collection's before the second's."""
    return mix((mix(rows).reshape(len(rows), 2 * SIDE, ROWS) * _WEIGHT).sum(axis=2, dtype=np.uint64)).view(np.int64)


def set_id(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, ids, least = [], [], []
        for shingles in shingle_sets(batch.column("text"), SHINGLE):
            sizes.append(len(shingles))
            ids.append(set_id(shingles) if len(shingles) else None)
            least.append(minima(shingles))
        if not sizes:
            continue
        keys = pa.array(list(sub_keys(np.array(least))), pa.list_(pa.int64()), mask=np.array(sizes) == 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(ids, pa.binary()), keys],
            ["doc_id", "n_shingles", "set", "keys"],
        )


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = list(shingle_sets(batch.column("text"), SHINGLE))
        yield pa.RecordBatch.from_arrays(
            [pa.array([set_id(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
            ["set", "shingles"],
        )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, set (an id of the shingle set) and keys per row of ``docs`` (doc_id, text)."""
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_sign, "doc_id bigint, n_shingles bigint, set binary, keys array<bigint>")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [set_id(s) if len(s) else None for s in shingle_sets(batch.column("text"), SHINGLE)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(ids, pa.binary())], ["row", "set"])


def with_set(docs: DataFrame) -> DataFrame:
    """row (the columns of ``docs``) and set (an id of the shingle set, null if it is empty) per row."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sets, f"row {rows.schema['row'].dataType.simpleString()}, set binary")


def buckets(sets: DataFrame) -> DataFrame:
    """(key, set) for every table key that two or more sets share."""
    subs = sets.select("set", F.posexplode("keys").alias("at", "sub"))
    shared = subs.groupBy("at", "sub").agg(F.count("*").alias("n")).where("n > 1").select("at", "sub")
    kept = subs.join(shared, ["at", "sub"]).groupBy("set").agg(F.collect_list(F.struct("at", "sub")).alias("subs"))
    half = lambda side: F.filter("subs", lambda x: (x["at"] < SIDE) if side else (x["at"] >= SIDE))
    pairs = F.flatten(F.transform(half(True), lambda x: F.transform(half(False), lambda y: F.xxhash64(x, y))))
    keys = materialize(kept.select("set", F.explode(pairs).alias("key")), "tables")
    many = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    return materialize(keys.join(many, "key"), "buckets")


def similar(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    side = lambda name: full.select(F.col("set").alias(name), F.col("shingles").alias(f"{name}_set"))
    both = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - both
    return pairs.join(side("a"), "a").join(side("b"), "b").where(both * 100 >= union * PERCENT).select("a", "b")


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows, with their component, of buckets that hold more than one."""
    rows = rows.join(roots.withColumnRenamed("id", "set"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    mixed = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo != hi")
    return rows.join(mixed.select("key"), "key")


def _rare(full: DataFrame) -> DataFrame:
    """(set, shingle) for every rare shingle."""
    every = full.select("set", F.explode("shingles").alias("shingle"))
    few = every.groupBy("shingle").agg(F.count("*").alias("n")).where(F.col("n") <= RARE).select("shingle")
    return every.join(few, "shingle")


def _rest(rows: DataFrame, full: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components that may be similar, from open bucket ``rows``."""
    left = materialize(rows.select("set", "root").distinct().join(sets.select("set", "n_shingles", "keys"), "set"), "left")
    rare = materialize(_rare(full.join(left, "set", "left_semi").distinct()), "rare")
    counts = rare.groupBy("set").agg(F.count("*").alias("rare"))
    left = left.join(counts, "set", "left").fillna(0, ["rare"]).withColumnRenamed("n_shingles", "n")
    fits = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb"))

    common = F.least(F.col("na") - F.col("ua"), F.col("nb") - F.col("ub"))
    without = common * 100 >= (F.col("na") + F.col("nb") - common) * PERCENT
    ratio = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT

    left = left.select("set", "root", "n", "rare", "keys")
    subs = left.select("*", F.posexplode(F.slice("keys", 1, SIDE)).alias("at", "sub"))
    a, b = subs.toDF("a", "ra", "na", "ua", "ka", "at", "sub"), subs.toDF("b", "rb", "nb", "ub", "kb", "at_b", "sub_b")
    same = lambda first, n: F.exists(
        F.zip_with(F.slice("ka", first, n), F.slice("kb", first, n), lambda x, y: x == y), lambda x: x
    )
    # A pair is met once, on the first sub-key it shares, and only if a table has it.
    met = (F.col("at") == F.col("at_b")) & (F.col("sub") == F.col("sub_b"))
    once = ~same(F.lit(1), F.col("at")) & same(F.lit(SIDE + 1), F.lit(SIDE))
    on_table = a.join(b, met & fits & without & once).select("a", "b")

    held = rare.join(left.drop("keys"), "set").select("set", "root", "n", "shingle")
    a, b = held.toDF("a", "ra", "na", "shingle"), held.toDF("b", "rb", "nb", "shingle_b")
    on_rare = a.join(b, (F.col("shingle") == F.col("shingle_b")) & fits & ratio).select("a", "b")
    return on_table.unionByName(on_rare).distinct()


def _stars(rows: DataFrame) -> DataFrame:
    """One pair per set: itself and the set that leads most of its buckets.

    A bucket is led by the set with the most company in its buckets, which among edited copies
    is the text they were made from.
    """
    led = rows.groupBy("key").agg(F.max(F.struct("company", "set"))["set"].alias("hub"))
    votes = rows.join(led, "key").where("set != hub").groupBy("set", "hub").agg(F.count("*").alias("n"))
    best = votes.groupBy("set").agg(F.max(F.struct("n", "hub"))["hub"].alias("hub"))
    return best.select(F.col("set").alias("a"), F.col("hub").alias("b"))


def links(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, root) of every set that is linked to another; ``sets`` (set, doc_id, n_shingles, keys) are distinct."""
    rows = buckets(sets)
    sharing = sets.join(rows.select("set").distinct(), "set", "left_semi").select("doc_id")
    full = materialize(
        docs.join(sharing, "doc_id", "left_semi").select(F.col("text").cast("string").alias("text"))
        .where("text is not null").mapInArrow(_full, "set binary, shingles array<bigint>"),
        "shingles",
    )
    rows = rows.join(rows.groupBy("key").agg(F.count("*").alias("n")), "key")
    company = rows.groupBy("set").agg(F.sum("n").alias("company"))
    rows = materialize(rows.drop("n").join(company, "set"), "company")
    near = materialize(similar(_stars(rows), full), "links")
    roots = components(near, "roots")
    rows = materialize(_open(rows, roots), "open")
    if rows.isEmpty():
        return roots
    more = similar(_rest(rows, full, sets), full)
    # What the first links joined stays joined: an edge to the root stands for them.
    return components(more.unionByName(roots.select(F.col("id").alias("a"), F.col("root").alias("b"))), "roots")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept; a row per row of ``docs``.

    ``docs`` needs doc_id and text; other columns are ignored. Null or empty texts have an empty
    set and link with nothing. Non-empty rows that share a doc_id are one document: their sets count
    as linked. A row without doc_id is linked to nothing (component null) and kept.
    """
    signed = materialize(signatures(docs), "signatures")
    named = signed.where("doc_id is not null and set is not null")
    sets = materialize(
        named.groupBy("set").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")),
        "sets",
    )
    linked = links(docs, sets)
    same_id = named.groupBy("doc_id").agg(F.min("set").alias("lo"), F.max("set").alias("hi")).where("lo != hi")
    repeats = named.join(same_id, "doc_id").select(F.col("set").alias("a"), F.col("lo").alias("b"))
    extra = materialize(repeats.where("a != b").distinct(), "repeats")
    if not extra.isEmpty():
        linked = components(extra.unionByName(linked.select(F.col("id").alias("a"), F.col("root").alias("b"))), "roots")
    placed = sets.select("set", "doc_id").join(linked.withColumnRenamed("id", "set"), "set", "left")
    placed = placed.withColumn("root", F.coalesce("root", "set"))
    least = placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_set = placed.join(least, "root").select("set", "component_id")
    # Rows of one document agree on their component, whichever of its texts they hold.
    out = signed.select("doc_id", "n_shingles", "set").join(of_set, "set", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each group of near duplicates: the one of the smallest doc_id, and one row of it.

    Rows without doc_id are in no group; of those with equal shingle sets one stays, and all whose set is
    empty. Of several rows of a doc_id, one with words is preferred. Other columns pass through, whatever
    their names and types.
    """
    at = {name: f"c{k}" for k, name in enumerate(docs.columns)}
    rows = docs.toDF(*at.values()).select(
        F.col(at["doc_id"]).cast("bigint").alias("id"), F.col(at["text"]).cast("string").alias("text"), F.struct(*at.values()).alias("row")
    )
    gone = near_duplicates(docs).where("doc_id is not null and not kept").select(F.col("doc_id").alias("id")).distinct()
    left = rows.where("id is not null").join(gone, "id", "left_anti")
    repeated = left.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    once = left.join(repeated, "id", "left_anti").select("row")
    more = _one_row(left.join(repeated, "id", "left_semi"), "id")
    nameless = with_set(rows.where("id is null")).select("set", "row.text", F.col("row.row").alias("row"))
    same = _one_row(nameless.where("set is not null"), "set")
    return union_all([once, more, same, nameless.where("set is null").select("row")]).select("row.*").toDF(*docs.columns)


def _one_row(rows: DataFrame, key: str) -> DataFrame:
    """Of the rows of each key one that has words, if any does: the first by a hash of the row, then by the row."""
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    whole = F.to_json("row")
    order = F.struct(wordless.alias("wordless"), F.xxhash64(whole).alias("hash"), whole.alias("whole"))
    return rows.groupBy(key).agg(F.min_by("row", order).alias("row")).select("row")
