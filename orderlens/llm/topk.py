"""Exact top-k by inner product over an impact-ordered index, score at a time.

The index is split into shards of rows. In a shard every dimension's postings are cut into segments
of equal quantised value. A query multiplies a segment's bounds by its own weight, which gives the
segment's impact, and takes all dimensions' segments by descending impact. After a step, a row's
score is at most what its seen postings add plus, for each unseen dimension, the impact of the next
segment, or of the dimension's best one if none of it has been reached. Scoring stops only when that
bound proves that no more than a few times k rows can still be among the k best, whatever the size of
the shard, or when all is seen; those are rescored exactly, so the result is exact whatever the quantisation.

Query blocks are matched with shards by an equi-join, both bounded; a shard returns k rows a query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.vectors import matrix, tiles
from orderlens.session import materialize

K = 5
SHARD_ROWS = 16384
BLOCK_QUERIES = 1024
#: Width of a segment's values.
LEVEL = 4
#: Shares of a shard's postings after which the proof is tried.
TRIES = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0)
#: Times k: rows that may still be possible when scoring stops before everything is seen.
POSSIBLE = 4
#: Share of a shard's rows; where a try leaves more of them possible, the next one is passed over.
HOPELESS = 0.1
#: What a posting adds to its row besides its impact, to be counted; and dimensions whose counts fit a double so.
ONE = 2.0**40
MOST_PACKED = 2**12


class Index:
    """Impact-ordered postings of one shard; ``read`` and ``rescored`` count postings and rows over its queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.vectors, self.read, self.rescored = ids, vectors, 0, 0
        self.largest = float(np.abs(vectors.astype(float)).max())
        self.order = np.ascontiguousarray(np.argsort(vectors, axis=0, kind="stable").T)  # by dimension: rows by value
        dims, low, high, sizes, self.lows, self.highs = [], [], [], [], np.empty(self.order.shape), np.empty(self.order.shape)
        for d, order in enumerate(self.order):
            values = vectors[order, d]
            cut = np.concatenate([[0], np.flatnonzero(np.diff(values // LEVEL)) + 1, [len(ids)]])
            dims.append(np.full(len(cut) - 1, d))
            low.append(values[cut[:-1]])
            high.append(values[cut[1:] - 1])
            sizes.append(np.diff(cut))
            self.lows[d], self.highs[d] = np.repeat(low[-1], sizes[-1]), np.repeat(high[-1], sizes[-1])
        self.dims, self.sizes, self.low, self.high = (np.concatenate(x) for x in (dims, sizes, low, high))

    def _postings(self, d: int, weight: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and impacts of a dimension's postings from place ``first`` to ``last`` by descending impact."""
        n = len(self.ids)
        at = slice(n - last, n - first) if weight > 0 else slice(first, last)
        return self.order[d, at], float(weight) * (self.highs if weight > 0 else self.lows)[d, at]

    def best(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows other than ``own``, ties to the smaller id."""
        n, dim = self.vectors.shape
        if self.largest * float(np.abs(query.astype(float)).max()) * dim >= 2.0**62:
            raise ValueError(f"scores of query {own} do not fit a long")
        segments = np.flatnonzero(query[self.dims])  # a dimension without weight adds nothing
        weight = query[self.dims[segments]]
        impact = np.maximum(weight * self.low[segments], weight * self.high[segments])
        turn = np.argsort(-impact, kind="stable")
        impact, dims, sizes = impact[turn], self.dims[segments[turn]], self.sizes[segments[turn]]
        highest = np.zeros(dim)  # of a dimension
        highest[dims[::-1]] = impact[::-1]
        done = np.cumsum(sizes)
        steps = np.unique(np.searchsorted(done, np.array(TRIES) * done[-1]) + 1).clip(max=len(turn)) if len(turn) else [0]
        slack = float(np.abs(impact).max(initial=0)) * dim * dim * 2.0**-52  # what rounding may take off a bound
        # A row's seen impacts and how many they are add up in one number: impacts are whole, and so is ONE more for each.
        # Where their sum might reach half of it, both are added on their own.
        packed = dim < MOST_PACKED and float(np.abs(weight).max(initial=0)) * self.largest * dim < ONE / 2
        one = ONE if packed else 0.0
        both, count, reached = np.zeros(n), np.zeros(n), np.zeros(dim, np.int64)
        at, passed = 0, False
        for step in steps:
            if passed and step < len(turn):
                passed = False
                continue
            until = reached + np.bincount(dims[at:step], sizes[at:step], dim).astype(np.int64)
            for d in np.flatnonzero(until > reached):
                rows, impacts = self._postings(d, query[d], reached[d], until[d])
                np.add.at(both, rows, impacts + one)
                if not packed:
                    np.add.at(count, rows, 1.0)
                self.read += len(rows)
            if packed:
                count = np.rint(both / ONE)
            seen = both - count * one
            at, reached = step, until
            bound = seen + slack
            if step < len(turn):
                following = float(impact[step])
                started = reached > 0
                bound += highest[~started].sum() + (started.sum() - count) * following
            few = min(n, 2 * k + 1)
            top = np.argpartition(-bound, few - 1)[:few]
            proven = np.sort((self.vectors[top] @ query)[self.ids[top] != own])[::-1]
            least = proven[k - 1] if len(proven) >= k else np.iinfo(np.int64).min
            possible = np.flatnonzero(bound >= least)
            if step == len(turn) or len(possible) <= POSSIBLE * k:
                break
            passed = len(possible) > n * HOPELESS
        possible = possible[self.ids[possible] != own]
        self.rescored += len(possible)
        scores = self.vectors[possible] @ query
        first = np.lexsort((self.ids[possible], -scores))[:k]
        return self.ids[possible[first]], scores[first]


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    last, index = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["shard"] != last:
                last, index = row["shard"], Index(np.array(row["ids"], np.int64), matrix(row["packed"], row["dim"], "<i8"))
            queries = matrix(row["queries"], row["dim"], "<i8")
            out = [(q, *index.best(vector, q, k)) for q, vector in zip(row["query_ids"], queries)]
            counts = [len(found) for _, found, _ in out]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([q for q, _, _ in out], counts), pa.int64()), pa.array(np.concatenate([f for _, f, _ in out]), pa.int64()),
                 pa.array(np.concatenate([s for _, _, s in out]), pa.int64())],
                ["query_id", "vec_id", "score"],
            )


def _vectors(rows: DataFrame) -> DataFrame:
    """(id, vector, dim) of the rows that can take part."""
    ok = F.coalesce((F.size("vector") > 0) & F.forall("vector", lambda x: x.isNotNull()), F.lit(False))
    return rows.where(F.col("vec_id").isNotNull() & ok).select(
        F.col("vec_id").cast("bigint").alias("id"), F.col("vector").cast("array<bigint>").alias("vector"), F.size("vector").alias("dim")
    )


def _spread(rows: DataFrame, most: int, label: str) -> DataFrame:
    """Tiles (dim, no, ids, packed) of about ``most`` rows of one length; landed, as several jobs read them."""
    rows = materialize(rows, label)
    parts = rows.groupBy("dim").agg(F.ceil(F.count("*") / most).cast("bigint").alias("parts"))
    no = F.pmod(F.xxhash64("id", F.lit(3)), F.col("parts"))
    tiled = tiles(rows.join(parts, "dim").withColumn("tile", F.concat_ws("/", "dim", no)), "tile", "<i8")
    return materialize(tiled.withColumn("no", F.split("tile", "/")[1].cast("bigint")), label)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest inner products with rows of ``vectors``.

    Both frames have vec_id and vector (an array of integers); a query is no candidate of its own, that
    is rows of its vec_id are passed over. Ties go to the smaller vec_id. Rows without id take no part,
    nor do null vectors or components; vectors are compared within one length. Rows of ``vectors`` that
    share a vec_id are candidates each; queries should not. Other columns are ignored. Components so large that
    a score might not fit a long raise an error.
    """
    shards = _spread(_vectors(vectors), SHARD_ROWS, "shards")
    blocks = _spread(_vectors(queries), BLOCK_QUERIES, "blocks")
    # Every block meets every shard of its length, by number: an equi-join of bounded tiles.
    asked = blocks.select("dim", F.col("no").alias("block"), F.col("ids").alias("query_ids"), F.col("packed").alias("queries"))
    asked = asked.join(shards.select("dim", F.col("tile").alias("to")), "dim").drop("dim")
    work = shards.select("tile", "ids", "packed", "dim").join(asked, F.col("tile") == F.col("to")).drop("to")
    dealt = work.repartition("tile", "block").sortWithinPartitions("tile").withColumnRenamed("tile", "shard").drop("block")
    found = dealt.mapInArrow(lambda batches: _search(batches, k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
