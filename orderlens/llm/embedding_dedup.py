"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are scaled to length 1 and rotated onto principal axes, the leading first. Two of cosine
THRESHOLD are at most REACH apart, so along every axis too: a grid of that width over the first axes
says which cells can hold pairs, and cells are cut into tiles of about TILE rows. A task takes one tile
and up to PARTNERS of the tiles near it. Rows of a tile are sorted along the leading axis, so a stripe of
them meets only the rows within REACH there, and of a tile with itself only later ones. A stripe is
compared a few dimensions at a time. What the later dimensions can add is at most the product of the
two suffix norms; pairs whose sum so far cannot reach the threshold are dropped, rows and columns without
pairs go, and once few pairs are left, those alone are gone on with. A stripe without pairs stops.
Survivors are confirmed by their cosine in double precision.

Equal vectors are collapsed before and counted after. A tile pair returns, per vector, how many it is
linked to and one spanning link, never the pairs, so a group of any size costs rows in proportion.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import components
from orderlens.llm.vectors import matrix, tiles, usable
from orderlens.session import materialize

THRESHOLD = 0.95
#: Distance of unit vectors at the threshold, and a little more for rounding.
REACH = float(np.sqrt(2 - 2 * THRESHOLD)) + 1e-6
#: Axes of the grid; rows of a tile of up to WIDTH dimensions, fewer beyond; partners of a tile in one task.
AXES = 3
TILE = 4096
WIDTH = 64
PARTNERS = 8
#: Rows compared at a time; dimensions after which pairs are first dropped, then after twice as many, and so on.
STRIPE = 256
STEP = 8
#: One pair in so many is left: pairs go on alone, and so many components of theirs at a time.
SPARSE = 16
_CELLS = 1 << 20
#: Vectors the axes are fitted on, a bound; they only decide how early a comparison stops.
SAMPLE = 4096
_SLACK = 1e-9
_HALF = 1 << 20


def axes(vectors: np.ndarray) -> np.ndarray:
    """Columns: principal axes of unit vectors, the widest first."""
    _, vectors_of = np.linalg.eigh(vectors.T @ vectors)
    return vectors_of[:, ::-1]


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _suffixes(rotated: np.ndarray, steps: list[int]) -> list[np.ndarray]:
    return [np.sqrt((rotated[:, s:] ** 2).sum(axis=1)) for s in steps]


def _steps(dim: int) -> list[int]:
    return [STEP << k for k in range(dim.bit_length()) if STEP << k < dim] + [dim]


def stripes(a: np.ndarray, b: np.ndarray | None, turn: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, columns, multiplications) of the links of STRIPE rows of unit vectors ``a`` with ``b``.

    Without ``b`` the links of ``a`` with itself, each once.
    """
    alone, steps = b is None, _steps(a.shape[1])
    ra = a @ turn
    order_a = np.argsort(ra[:, 0], kind="stable")
    ra = ra[order_a]
    if alone:
        b, rb, order_b = a, ra, order_a
    else:
        rb = b @ turn
        order_b = np.argsort(rb[:, 0], kind="stable")
        rb = rb[order_b]
    tails_a, tails_b = _suffixes(ra, steps), _suffixes(rb, steps)
    for first in range(0, len(a), STRIPE):
        rows = np.arange(first, min(first + STRIPE, len(a)))
        lo = np.searchsorted(rb[:, 0], ra[rows[0], 0] - REACH, "left")
        hi = np.searchsorted(rb[:, 0], ra[rows[-1], 0] + REACH, "right")
        columns = np.arange(max(lo, first) if alone else lo, hi)
        alive = np.less.outer(rows, columns) if alone else np.ones((len(rows), len(columns)), bool)
        sums, at, spent, left = np.zeros(alive.shape), 0, 0, list(enumerate(steps))
        while left and alive.sum() * SPARSE > alive.size:
            k, step = left.pop(0)
            kept = np.ix_(alive.any(axis=1), alive.any(axis=0))
            rows, columns, sums, alive = rows[kept[0][:, 0]], columns[kept[1][0]], sums[kept], alive[kept]
            sums = sums + ra[rows, at:step] @ rb[columns, at:step].T
            spent += sums.size * (step - at)
            alive &= sums + np.outer(tails_a[k][rows], tails_b[k][columns]) >= THRESHOLD - _SLACK
            at = step
        x, y = np.nonzero(alive)
        i, j, sums = rows[x], columns[y], sums[x, y]
        for k, step in left:
            many = max(1, _CELLS // (step - at))
            for lo in range(0, len(i), many):
                own = slice(lo, lo + many)
                sums[own] += np.einsum("pd,pd->p", ra[i[own], at:step], rb[j[own], at:step])
            spent += len(i) * (step - at)
            near = sums + tails_a[k][i] * tails_b[k][j] >= THRESHOLD - _SLACK
            i, j, sums, at = i[near], j[near], sums[near], step
        linked = sums >= THRESHOLD
        for p in np.flatnonzero(np.abs(sums - THRESHOLD) <= _SLACK):  # rounding of the rotation decides nothing
            linked[p] = float(a[order_a[i[p]]] @ b[order_b[j[p]]]) >= THRESHOLD
        yield order_a[i[linked]], order_b[j[linked]], spent


def compare(
    a: np.ndarray, b: np.ndarray | None, ca: np.ndarray, cb: np.ndarray | None, turn: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """(linked copies, a local root) per row of ``a`` and then of ``b`` (None: ``a`` with itself), and the multiplications."""
    alone, n = b is None, len(a)
    if alone:
        cb = ca
    shift, total, spent = (0, n, 0) if alone else (n, n + len(b), 0)
    counts, label = np.zeros(total, np.int64), np.arange(total)
    for i, j, work in stripes(a, b, turn):
        spent += work
        np.add.at(counts, i, cb[j])
        np.add.at(counts, j + shift, ca[i])
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        starts = np.flatnonzero(np.diff(i, prepend=-1))
        for row, others in zip(i[starts], np.split(j + shift, starts[1:])):
            met = label[np.append(others, row)]
            root = met.min()
            apart = np.unique(met[met != root])
            if len(apart):
                label[np.isin(label, apart)] = root
    return counts, label, spent


def _tile_pairs(held: DataFrame) -> DataFrame:
    """(tile, other, part) once for every two tiles whose cells touch, a tile and itself included: ``part`` holds
    PARTNERS of a tile at most. Rows are tiles, not vectors."""
    near = F.explode(F.array(*[F.array(*[F.lit(x) for x in step]) for step in product((-1, 0, 1), repeat=AXES)]))
    cells = held.select("tile", "dim", "cell")
    wanted = cells.select("tile", "dim", near.alias("step")).join(cells.select("tile", "cell"), "tile")
    wanted = wanted.select("tile", "dim", F.zip_with("cell", "step", lambda x, y: x + y).alias("cell"))
    others = cells.select(F.col("tile").alias("other"), "dim", "cell")
    pairs = wanted.join(others, ["dim", "cell"]).where("tile <= other").select("tile", "other")
    place = F.row_number().over(Window.partitionBy("tile").orderBy("other"))  # a tile is the first of its own partners
    return pairs.withColumn("part", F.floor((place - 1) / PARTNERS))


def _placed(rows: DataFrame, turns: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` (id, vector, copies) with dim and cell (grid place along the first axes)."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, cells = [], []
            for row in batch.column("vector"):
                values = unit(np.array(row.as_py(), np.float64)[None, :])[0]
                turn = turns.get(len(values), np.eye(len(values)))
                grid = np.floor(values @ turn[:, :AXES] / REACH).astype(np.int32)
                dims.append(len(values))
                cells.append(np.pad(grid, (0, AXES - len(grid))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(dims, pa.int32()), pa.array(cells, pa.list_(pa.int32()))], [*batch.schema.names, "dim", "cell"]
            )

    kind = dict(rows.dtypes)["vector"]
    return rows.mapInArrow(place, f"id bigint, vector {kind}, copies bigint, dim int, cell array<int>")


def near_duplicates(rows: DataFrame) -> DataFrame:
    """vec_id, n_links (other vectors of cosine THRESHOLD or more), component_id (smallest vec_id reachable
    by links) and kept (it is that one), a row per row of ``rows`` (vec_id, embedding).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing; so do
    rows without vec_id, whose component is null and which are kept. Vectors are compared within one
    length. Different vectors of one vec_id are one node: the links of either count. Other columns are ignored.
    """
    kind = "float" if dict(rows.dtypes)["embedding"] == "array<float>" else "double"
    held = rows.select(F.col("vec_id").cast("bigint").alias("id"), F.col("embedding").cast(f"array<{kind}>").alias("vector"))
    good = usable("vector") & F.coalesce(F.exists("vector", lambda x: x != 0), F.lit(False)) & F.col("id").isNotNull()
    held = materialize(held.withColumn("same", F.when(good, F.struct(F.xxhash64("vector").alias("x"), F.xxhash64("vector", F.lit(1)).alias("y")))), "vectors")
    distinct = held.where("same is not null").groupBy("same").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    distinct = materialize(distinct, "distinct")
    some = distinct.select("vector").orderBy(F.xxhash64("vector", F.lit(2))).limit(SAMPLE).toArrow()["vector"].to_pylist()
    by_dim: dict[int, list] = {}
    for vector in some:
        by_dim.setdefault(len(vector), []).append(vector)
    turns = {dim: axes(unit(np.array(v, np.float64))) for dim, v in by_dim.items()}

    placed = materialize(_placed(distinct.select("id", "vector", "copies"), turns), "placed")
    rows_of_tile = F.lit(TILE * WIDTH) / F.greatest("dim", F.lit(WIDTH))
    parts = placed.groupBy("dim", "cell").agg(F.count("*").alias("n")).select("dim", "cell", F.ceil(F.col("n") / rows_of_tile).alias("parts"))
    no = F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts"))
    named = placed.join(parts, ["dim", "cell"]).withColumn("tile", F.concat_ws("/", "dim", F.concat_ws(",", "cell"), no))
    # The number of copies rides along as two more components, which even small floats hold exactly.
    copies = [F.floor(F.col("copies") / _HALF), F.col("copies") % _HALF]
    packed = named.select("tile", "id", F.concat("vector", F.array(*[c.cast(kind) for c in copies])).alias("vector"))
    form = "<f4" if kind == "float" else "<f8"
    whole = materialize(tiles(packed, "tile", form), "tiles")
    whole = whole.withColumn("dim", F.col("dim") - 2).withColumn("cell", F.split(F.split("tile", "/")[1], ",").cast("array<int>"))
    pairs = materialize(_tile_pairs(whole), "pairs")
    one = pairs.select("tile", "part").distinct().join(whole.select("tile", "dim", "ids", "packed"), "tile")
    others = pairs.where("tile != other").select(F.col("tile").alias("of"), F.col("part").alias("of_part"), "other")
    others = others.join(whole.select(F.col("tile").alias("other"), F.col("ids").alias("ids_b"), F.col("packed").alias("b")), "other")

    def run(tile: pa.Table, near: pa.Table) -> pa.Table:
        (own,) = tile.to_pylist()
        dim = own["dim"]
        turn = turns.get(dim, np.eye(dim))

        def held_in(ids: list[int], packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            rows = matrix(packed, dim + 2, form).astype(np.float64)
            return np.array(ids, np.int64), unit(rows[:, :dim]), (rows[:, dim] * _HALF + rows[:, dim + 1]).astype(np.int64)

        ids_a, a, ca = held_in(own["ids"], own["packed"])
        met = [(ids_a, *compare(a, None, ca, None, turn))] if own["part"] == 0 else []
        for batch in near.to_batches(max_chunksize=1):
            for row in batch.to_pylist():
                ids_b, b, cb = held_in(row["ids_b"], row["b"])
                met.append((np.concatenate([ids_a, ids_b]), *compare(a, b, ca, cb, turn)))
        linked = [(ids[counts > 0], counts[counts > 0], ids[label[counts > 0]]) for ids, counts, label, _ in met]
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*linked)], ["id", "links", "root"])

    by_part = one.groupBy("tile", "part").cogroup(others.groupBy("of", "of_part"))
    compared = by_part.applyInArrow(run, "id bigint, links bigint, root bigint")
    found = materialize(compared, "found")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")), "roots")
    least = joined.groupBy("root").agg(F.min("id").alias("component_id"))
    component = joined.join(least, "root").select("id", "component_id")
    of_vector = distinct.select("same", "id", "copies").join(links, "id", "left").join(component, "id", "left").select(
        "same", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    out = held.select(F.col("id").alias("vec_id"), "same").join(of_vector, "same", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
