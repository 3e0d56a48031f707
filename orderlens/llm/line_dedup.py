"""Near-duplicate lines by a segment-partition edit join; later copies are removed from documents.

Two lines are linked if their edit distance is at most limit() of the shorter one: THRESHOLD code points,
and fewer in lines of under SEGMENT * (THRESHOLD + 1) code points, so that a segment never has fewer than
SEGMENT of them. Lines of under 2 * SEGMENT code points are linked if they are equal.

Lines go by classes of like lengths, and a line that is little longer than a class joins its lines as a probe. A line with
limit k has k + 1 segments, as long as the least length of its class allows, half of them counted from its beginning and
half from its end; k edits leave one of them whole and near its place (see _places()). Lines are indexed under (class,
segment number, segment) and probe with the substrings near those places. Pairs that meet and are of like length are
verified by banded bit-parallel edit distance.

A bucket of more than BUCKET lines is first compared with one line, its hub, line by line. That links some, and
tells of each line how far the hub goes along with it, from either end, before the first edit and before one edit
more than its limit. Two lines within the limit have overlapping spans of that kind at both ends: what one of them
reaches unchanged, the other one reaches with the edits between the two. So lines meet in cells of such spans
instead of the bucket, and only across components: what is left out is linked already, so the components
are those of all pairs. Copies and near copies of one line are told apart by where they differ from it. A cell that
is crowded still, of lines that differ from the hub in the same place, goes by the rarest grams of its lines.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from operator import add, and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import WORD, components
from orderlens.llm.hashing import mix, powers, runs, windows
from orderlens.session import materialize

#: Most edits of a link.
THRESHOLD = 3
#: Code points of a segment at least.
SEGMENT = 10
#: Code points of a line that takes part at least, unless another number is asked for.
MIN_CHARS = 20
BUCKET = 32
#: A cell of more than CROWD * BUCKET lines goes by grams: they cost a line as much as some hundred comparisons of spans.
CROWD = 8
#: Parts of a hub that the spans of a crowded bucket's lines are told apart by, from either end.
PARTS = 16
#: Lengths of the lines of a cell, besides those that a line within the limit may be longer by.
SIZES = 4
#: Code points of the grams that tell lines of a crowded cell apart; fewer than SEGMENT, so that a line has more
#: of them than its edits change, unless it repeats itself.
GRAM = 8
#: Words of 64 bits in the bit map that lines are looked up in before their texts are shuffled: a few MB to broadcast.
WORDS = 1 << 18
#: Columns of 64 bits for the grams of a line.
MARKS = [f"marks{k}" for k in range(16)]


def lines(docs: DataFrame, shortest: int = MIN_CHARS) -> DataFrame:
    """(doc_id, line_no, line, text) of every line that takes part; ``line`` identifies its text.

    Blank lines do not, whatever ``shortest`` is.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(F.split(F.col("text").cast("string"), "\n")).alias("line_no", "text")
    )
    there = (F.char_length("text") >= shortest) & F.col("text").rlike(WORD)
    return rows.where(there).withColumn("line", _name())


def _name() -> Column:
    return F.unhex(F.md5("text"))


def limit(length: np.ndarray, most: int) -> np.ndarray:
    """Edits allowed to a shorter line of ``length`` code points."""
    return np.clip(length // SEGMENT - 1, 0, most)


def _distinct(rows: DataFrame) -> DataFrame:
    """One row per line text: its first place and how often it comes."""
    return rows.select("line", F.struct("doc_id", "line_no").alias("at")).groupBy("line").agg(F.min("at").alias("first"), F.count("*").alias("times"))


def _classes(size: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """The shortest length of each line's class, and then of classes before it while a line there may be within the
    limit (0 if none may). All lines of a class have one limit; its lengths are SEGMENT, or up to an eighth of the least.
    """

    def least(n: np.ndarray) -> np.ndarray:
        width = SEGMENT << np.log2(np.maximum(n // (max(8, most + 1) * SEGMENT), 1)).astype(np.int64)
        return n // width * width

    n = least(size)
    while n.any():
        yield n
        before = np.maximum(n - 1, 0)
        n = np.where(size - n < limit(before, most), least(before), 0)


def _places(k: int) -> Iterator[tuple[int, int, int]]:
    """(segment, its place, shift) of the substrings that a line of limit k is indexed under (shift 0) or probes with;
    places are counted from the left or, if negative, from the right.

    If the first m segments hold fewer than m edits, the first one up to which there are no more edits than segments
    before it is whole, and there are as many edits before it as segments: its shift is no more than that. Of m segments
    from the left and k + 1 - m from the right, one side at least has fewer edits than segments.
    """
    half = k // 2 + 1
    for i in range(k + 1):
        near = i if i < half else i - half
        yield from ((i, i if i < half else -near - 1, d) for d in range(-near, near + 1))


def _keys(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """(key, h, probes) for every place of every line; copies of a line in one batch count once."""
    for batch in batches:
        batch = batch.take(pa.array(np.unique(batch.column("h").to_numpy(), return_index=True)[1]))
        for first, end, data, offsets in runs(batch.column("text")):
            at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
            up, down = powers(len(codes))
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)])])
            size, keys, held, probing = np.diff(at), [], [], []
            for before, n in enumerate(_classes(size, most)):
                allowed = limit(n, most)
                for k in range(1, most + 1):
                    lines_of = np.flatnonzero(allowed == k)
                    length, width = size[lines_of], n[lines_of] // (k + 1)
                    for i, place, shift in _places(k):
                        start = place * width + shift + (length if place < 0 else 0)
                        fits = np.flatnonzero((start >= 0) & (start + width <= length))
                        own, lo = lines_of[fits], at[lines_of[fits]] + start[fits]
                        keys.append(mix((sums[lo + width[fits]] - sums[lo]) * down[lo] + mix((n[own] * 64 + i).astype(np.uint64))).view(np.int64))
                        held.append(first + own)
                        probing.append(np.full(len(own), bool(before or shift)))
            if not keys:
                continue
            columns = [pa.array(np.concatenate(keys)), batch.column("h").take(pa.array(np.concatenate(held))), pa.array(np.concatenate(probing))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "h", "probes"])


def _buckets(texts: DataFrame, most: int) -> DataFrame:
    """(key, h, probes, n) of keys that two or more lines share, one of them indexed there; ``n`` is at least their number."""
    keys = materialize(texts.select("h", "text").mapInArrow(lambda batches: _keys(batches, most), "key bigint, h bigint, probes boolean"), "keys")
    index = keys.where("not probes")
    probing = keys.where("probes").join(index.select("key").distinct().hint("shuffle_hash"), "key", "left_semi").distinct()
    probing = materialize(probing, "probes")
    rows = index.unionByName(probing)
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")).where("lo != hi")
    return rows.join(counts.select("key", "n"), "key").distinct()


def _held(texts: DataFrame, hashes: DataFrame) -> DataFrame:
    """(h, text, line) of every line whose ``h`` is one of ``hashes``, once each.

    Few lines are, so a bit map of the hashes, of bounded size, passes over most others before texts are shuffled.
    """
    # Written, their size is known before texts are read: these are shuffled only if the hashes are too many to broadcast.
    hashes = materialize(hashes, "hashes")
    word, bit = F.shiftright("h", 14).bitwiseAND(WORDS - 1).alias("word"), F.expr("shiftleft(1L, cast(shiftright(h, 8) & 63 as int))").alias("bit")
    bits = hashes.select(word, bit).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    maybe = texts.select("*", word, bit).join(F.broadcast(bits), "word").where("bits & bit != 0").select("h", "text")
    found = maybe.join(hashes, "h").withColumn("line", _name())  # a semi join would be made before the bit map's
    return materialize(found.dropDuplicates(["line"]), "texts")


def _within(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        allowed = limit(np.array([min(len(a), len(b)) for a, b in zip(left, right)], np.int64), most)
        near = np.zeros(len(left), bool)
        for k in np.unique(allowed):
            own = np.flatnonzero(allowed == k)
            near[own] = within([left[j] for j in own], [right[j] for j in own], int(k))
        yield batch.select(["a", "b"]).filter(pa.array(near))


#: Characters of texts that are compared at a time.
_CELLS = 1 << 21


def within(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Whether the edit distance of each pair is at most ``most``."""
    return compared(left, right, most)[0] <= most


def compared(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Three rows, of each pair: the edit distance, or most + 1 if it is more; the characters of the left text that
    some beginning of the right one equals; those that one is within ``most`` edits of. Pairs of like length go together.
    """
    longest = np.array([max(len(a), len(b)) for a, b in zip(left, right)], np.int64)
    order, found, first = np.argsort(longest, kind="stable"), np.zeros((3, len(left)), np.int64), 0
    while first < len(order):
        end = first + 1
        while end < len(order) and (end + 1 - first) * (longest[order[end]] + 8) <= _CELLS:
            end += 1
        own = order[first:end]
        found[:, own] = _banded([left[k] for k in own], [right[k] for k in own], most)
        first = end
    return found


def _banded(left: list[str], right: list[str], most: int) -> np.ndarray:
    """Bit-parallel over the band of 2 * most + 1 diagonals, and over all pairs at a time.

    After i characters of the left text, bit d of reach[e] says that they are within e edits of the
    first i + d - most characters of the right one. Pairs that nothing reaches any more are dropped.
    """
    size_a, size_b = (np.array([len(t) for t in texts]) for texts in (left, right))
    band, width = 2 * most + 1, int(max(size_a.max(), size_b.max())) + 2 * most + 1
    a, b = np.zeros((len(left), width), np.uint32), np.ones((len(left), width + most), np.uint32)
    for i, (x, y) in enumerate(zip(left, right)):
        a[i, : len(x)] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) + 2
        b[i, most : most + len(y)] = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), np.uint32) + 2
    one, full = np.uint64(1), np.uint64((1 << band) - 1)
    reach = [np.full(len(left), sum(1 << d for d in range(most, most + e + 1)), np.uint64) for e in range(most + 1)]
    alive, found = np.arange(len(left)), np.array([[most + 1], [0], [0]]).repeat(len(left), 1)
    for i in range(int(size_a.max()) + 1):
        ended = np.flatnonzero(size_a[alive] == i)
        if len(ended):
            d = size_b[alive[ended]] - i + most
            inside = (d >= 0) & (d < band)
            for r in reach:
                found[0, alive[ended]] -= inside & ((r[ended] >> np.where(inside, d, 0).astype(np.uint64)) & one).astype(bool)
        if i % 16 == 0 or len(ended):
            going = (reach[most] != 0) & (size_a[alive] > i)
            if not going.any():
                break
            alive, a, b = alive[going], a[going], b[going]
            reach = [r[going] for r in reach]
        match = np.zeros(len(alive), np.uint64)
        for d in range(band):
            match |= (a[:, i] == b[:, i + d]).astype(np.uint64) << np.uint64(d)
        new: list[np.ndarray] = []
        for e in range(most + 1):
            cells = reach[e] & match  # the characters agree
            if e:
                cells |= reach[e - 1] | (reach[e - 1] >> one)  # a substitution; a character of the left text only
                cells |= (new[e - 1] << one) & full  # a character of the right text only
            new.append(cells)
        reach = new
        found[1, alive] += reach[0] != 0
        found[2, alive] += reach[most] != 0
    return found


def _spans(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Of each line b and its hub a: whether they are within the limit, the limit k of b and its length; how many
    characters of the hub go along with b before its first edit, and before one more than k, from the left (l0, lk)
    and from the right (r0, rk); and the parts of the hub that these fall in, as pl0 to prk.
    """
    for batch in batches:
        hubs, texts = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        of_hub, size = (np.array([len(t) for t in side], np.int64) for side in (hubs, texts))
        k, ends, apart = limit(size, most), np.zeros((4, len(texts)), np.int64), np.zeros(len(texts), np.int64)
        for e in np.unique(k):
            own = np.flatnonzero(k == e)
            apart[own], *ends[:2, own] = compared([hubs[j] for j in own], [texts[j] for j in own], int(e))
            ends[2:, own] = compared([hubs[j][::-1] for j in own], [texts[j][::-1] for j in own], int(e))[1:]
        near = apart <= limit(np.minimum(of_hub, size), most)
        columns = [near, k, size, *ends, *(ends * PARTS // (of_hub + 1))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "h_b")), *map(pa.array, columns)], _SPANS)


_ENDS = ["l0", "lk", "r0", "rk"]
_SPANS = ["a", "b", "h", "near", "k", "size", *_ENDS, *(f"p{e}" for e in _ENDS)]


def _grams(batches: Iterator[pa.RecordBatch], most: int, marks: bool) -> Iterator[pa.RecordBatch]:
    """(h, gram, enough) for the distinct grams of each line: ``enough`` is more of them than the line's edits can
    change. A line that has no more than they change holds one gram besides, which all such lines share.

    With ``marks`` instead (h, *MARKS) for each line: its grams as bits, so that lines differ in no more bits than grams.
    """
    for batch in batches:
        for first, end, data, offsets in runs(batch.column("text")):
            at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
            codes = np.frombuffer(data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
            every = windows(mix(codes.astype(np.uint64) + np.uint64(1)), GRAM)
            changed, names = GRAM * limit(np.diff(at), most), batch.column("h").slice(first, end - first)
            own = [np.unique(every[at[k] : max(at[k], at[k + 1] - GRAM + 1)]) for k in range(end - first)]
            if marks:
                bits = np.zeros((len(own), len(MARKS)), np.uint64)
                for k, grams in enumerate(own):
                    np.bitwise_or.at(bits[k], (grams >> np.uint64(6)) % len(MARKS), np.uint64(1) << (grams & np.uint64(63)))
                yield pa.RecordBatch.from_arrays([names, *(pa.array(b.view(np.int64)) for b in np.ascontiguousarray(bits.T))], ["h", *MARKS])
                continue
            own = [g if len(g) > few else np.append(g, np.uint64(0)) for g, few in zip(own, changed.tolist())]
            line = np.repeat(np.arange(len(own)), [len(g) for g in own])
            columns = [names.take(pa.array(line)), pa.array(np.concatenate(own).view(np.int64)), pa.array(changed[line] + 1)]
            yield pa.RecordBatch.from_arrays(columns, ["h", "gram", "enough"])


def _hubs(many: DataFrame) -> DataFrame:
    """(key, a): the line that each crowded bucket is compared with, one of many others, which need not be in it.

    Lines of which few copies differ in a segment are in the most crowded buckets for all their segments; a bucket
    takes the first such line that its own lines meet elsewhere. Any choice is right; this one links and tells apart more.
    """
    ranks = many.groupBy("h").agg(F.sum("n").alias("rank"))
    members = many.select("key", "h").join(ranks, "h").select("key", "h", F.struct("rank", "h").alias("top"))
    in_bucket = members.groupBy("key").agg(F.max("top").alias("top"))
    of_line = members.drop("top").join(in_bucket, "key").groupBy("h").agg(F.max("top").alias("top"))
    return members.drop("top").join(of_line, "h").groupBy("key").agg(F.max("top").alias("top")).select("key", F.col("top.h").alias("a"))


def _across(spans: DataFrame, near: DataFrame, held: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of lines compared with one hub that may be within the limit and that the links ``near`` leave in
    different components; ``spans`` as from _spans().

    Say that b is within k edits of c. The characters of the hub that b's beginning equals, c's beginning is within k
    edits of. So l0 of b is no more than lk of c, and the other way round: the two spans overlap, and the part that the
    later one starts in is in both. The same holds from the right. Their lengths differ by no more than k, so that c goes
    by the lengths of its cell that are down to its own limit shorter.
    """
    roots = components(near, "crowds").withColumnRenamed("id", "b")
    rows = spans.drop("near").join(roots, "b", "left").withColumn("root", F.coalesce("root", "b"))
    several = lambda df, *by: df.groupBy(*by).agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo != hi")
    rows = materialize(rows.join(several(rows, "a").select("a"), "a"), "open")
    parts = rows.withColumn("left", F.explode(F.sequence("pl0", "plk"))).withColumn("right", F.explode(F.sequence("pr0", "prk")))
    parts = parts.withColumn("sizes", F.explode(F.expr(f"sequence((size - k) div {SIZES}, size div {SIZES})")))
    cell = ["a", "left", "right", "sizes"]
    cells = parts.join(several(parts, *cell).select(*cell, "n"), cell)
    cells = materialize(cells.select(F.xxhash64(*cell).alias("cell"), *cell[1:], "n", "h", "root", "k", "size", *_ENDS, "pl0", "pr0"), "cells")

    def met(rows: DataFrame, keys: list[str], *more: str) -> DataFrame:
        own = [*cell[1:], "h", "root", "k", "size", *_ENDS, "pl0", "pr0", *more]
        a, b = (rows.select(*keys, *[F.col(c).alias(f"{c}_{side}") for c in own]) for side in "ab")
        overlap = [F.col(f"{e}0_{x}") <= F.col(f"{e}k_{y}") for e in "lr" for x, y in ("ab", "ba")]
        once = [F.col(f"{at}_a") == F.greatest(f"{p}_a", f"{p}_b") for at, p in (("left", "pl0"), ("right", "pr0"))]
        once.append(F.col("sizes_a") == F.floor(F.least("size_a", "size_b") / SIZES))
        fits = F.abs(F.col("size_a") - F.col("size_b")) <= F.least("k_a", "k_b")
        return a.join(b, keys).where(reduce(and_, [F.col("h_a") < F.col("h_b"), F.col("root_a") != F.col("root_b"), fits, *overlap, *once, *_alike(more)]))

    few, many = cells.where(F.col("n") <= CROWD * BUCKET), cells.where(F.col("n") > CROWD * BUCKET)
    pairs = met(few, ["cell"]).select("h_a", "h_b")
    if not many.isEmpty():
        pairs = pairs.unionByName(met(_rarest(many.drop("n"), held, most), ["cell", "gram"], "enough", *MARKS).select("h_a", "h_b"))
    return pairs.toDF("a", "b").distinct()


def _alike(columns: tuple[str, ...]) -> list[Column]:
    """That the marks of two lines differ in few bits, where they have marks."""
    differ = [F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in MARKS if m in columns]
    return [reduce(add, differ) <= 2 * (F.least("enough_a", "enough_b") - 1)] if differ else []


def _rarest(cells: DataFrame, held: DataFrame, most: int) -> DataFrame:
    """Rows of crowded ``cells`` for the rarest grams of each line among those of its cell, with the line's marks.

    k edits change at most GRAM * k grams of a line. So of two lines within k edits, each ordered by how many lines
    of the cell hold a gram, the rarest GRAM * k + 1 share one, and their marks differ in 2 * GRAM * k bits at most.
    """
    texts = held.join(cells.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.min("text").alias("text"))
    texts = materialize(texts, "crowded")
    grams = texts.mapInArrow(lambda batches: _grams(batches, most, False), "h bigint, gram bigint, enough bigint")
    grams = cells.select("cell", "h").join(grams, "h")
    counts = grams.groupBy("cell", "gram").agg(F.count("*").alias("n")).where("n > 1")
    placed = F.row_number().over(Window.partitionBy("cell", "h").orderBy("n", "gram"))
    ranked = grams.join(counts, ["cell", "gram"], "left").withColumn("n", F.coalesce("n", F.lit(1))).withColumn("place", placed)
    rarest = ranked.where("(place <= enough or gram = 0) and n > 1").select("cell", "gram", "h", "enough")
    marks = texts.mapInArrow(lambda batches: _grams(batches, most, True), "h bigint, " + ", ".join(f"{m} bigint" for m in MARKS))
    return materialize(rarest.join(cells, ["cell", "h"]).join(marks, "h"), "rarest")


def links(rows: DataFrame, most: int) -> DataFrame:
    """Pairs (a, b) of lines within the limit that connect every class; ``rows`` as from lines().

    Until texts are compared a line goes by ``h``, a hash of half the size, of which the last byte is that of the line's
    length; lines that share it are all compared.
    """
    size = F.char_length("text")
    h = F.shiftleft(F.xxhash64("text"), 8).bitwiseOR(size.bitwiseAND(255))
    texts = rows.where(size >= 2 * SEGMENT).select(h.alias("h"), "text")
    met = materialize(_buckets(texts, most), "met")
    few, many = met.where(F.col("n") <= BUCKET), met.where(F.col("n") > BUCKET)
    a = few.where("not probes").select("key", F.col("h").alias("a"))
    b = few.select("key", F.col("h").alias("b"), "probes")
    apart = F.pmod(F.col("a").bitwiseAND(255) - F.col("b").bitwiseAND(255) + most, F.lit(256))
    pairs = a.join(b, "key").where("a != b and (probes or a < b)").where(apart <= 2 * most)
    pairs = materialize(pairs.select("a", "b").distinct(), "pairs")
    held = _held(texts, pairs.select("a").union(pairs.select("b")).union(many.select("h")).toDF("h").distinct())
    side = lambda name: held.select(F.col("h").alias(f"h_{name}"), F.col("line").alias(name), F.col("text").alias(f"text_{name}"))
    sides = lambda pairs: pairs.toDF("h_a", "h_b").join(side("a"), "h_a").join(side("b"), "h_b")
    verified = lambda pairs: sides(pairs).mapInArrow(lambda batches: _within(batches, most), "a binary, b binary")
    near = verified(pairs)
    if many.isEmpty():
        return near
    stars = many.join(_hubs(many), "key").select("a", F.col("h").alias("b")).where("a != b").distinct()
    kinds = ", ".join(f"{c} {'binary' if c in 'ab' else 'boolean' if c == 'near' else 'bigint'}" for c in _SPANS)
    spans = materialize(sides(stars).mapInArrow(lambda batches: _spans(batches, most), kinds), "spans")
    near = materialize(near.unionByName(spans.where("near").select("a", "b")), "near")
    return near.unionByName(verified(_across(spans, near, held, most)))


def classes(docs: DataFrame, most: int = THRESHOLD, shortest: int = MIN_CHARS) -> DataFrame:
    """(line, first_doc, first_line, times) of lines that are not alone in their class: where it first comes,
    and how often this text does."""
    rows = lines(docs, shortest)
    distinct = materialize(_distinct(rows), "lines")
    roots = components(materialize(links(rows, most), "links"), "roots").withColumnRenamed("id", "line")
    placed = distinct.join(roots, "line", "left").where("times > 1 or root is not null")
    placed = placed.withColumn("root", F.coalesce("root", "line"))
    least = placed.groupBy("root").agg(F.min("first").alias("least"))
    return materialize(
        placed.join(least, "root").select("line", F.col("least.doc_id").alias("first_doc"), F.col("least.line_no").alias("first_line"), "times"),
        "classes",
    )


def line_classes(docs: DataFrame, most: int = THRESHOLD, shortest: int = MIN_CHARS) -> DataFrame:
    """doc_id, line_no, class_doc_id, class_line_no and kept for every line of at least ``shortest`` code points
    that is not blank; ``most`` edits link two lines.

    A class is a component of links; it is named by its first place, by doc_id and line, and kept there
    only. Documents without id and null texts have no lines here; rows that share a doc_id are one
    document, and equal lines at one place of it are one place. Other columns are ignored.
    """
    found = classes(docs, most, shortest).drop("times")
    rows = lines(docs, shortest).select("doc_id", "line_no", "line").join(found, "line", "left")
    at = rows.select(
        "doc_id", F.col("line_no").cast("bigint").alias("line_no"), F.coalesce("first_doc", "doc_id").alias("class_doc_id"),
        F.coalesce("first_line", "line_no").cast("bigint").alias("class_line_no"),
    )
    return at.withColumn("kept", (F.col("doc_id") == F.col("class_doc_id")) & (F.col("line_no") == F.col("class_line_no")))


def deduplicated(docs: DataFrame, most: int = THRESHOLD, shortest: int = MIN_CHARS) -> DataFrame:
    """``docs`` without the lines that line_classes() does not keep; n_chars follows the text.

    A document all of whose text is removed goes; one that was empty, null or without id stays as it is.
    """
    found = classes(docs, most, shortest).drop("times")
    rows = lines(docs, shortest).select("doc_id", "line_no", "line").join(found, "line")
    gone = rows.where((F.col("doc_id") != F.col("first_doc")) | (F.col("line_no") != F.col("first_line")))
    marks = gone.groupBy("doc_id").agg(F.collect_set(F.struct("line_no", "line")).alias("gone"))
    at, n = docs.columns.index("text"), len(docs.columns)
    names = [str(k) for k in range(n)]
    kinds = ", ".join(f"`{k}` {f.dataType.simpleString()}" for k, f in enumerate(docs.schema))
    numbered = docs.toDF(*names).withColumn("id", F.col(f"`{docs.columns.index('doc_id')}`").cast("bigint"))
    marked = numbered.join(marks.withColumnRenamed("doc_id", "id"), "id", "left").select(*names, "gone")
    left = marked.mapInArrow(lambda batches: _without(batches, at), f"{kinds}, lost boolean").where("not lost").drop("lost")
    if "n_chars" in docs.columns:
        chars = str(docs.columns.index("n_chars"))
        left = left.withColumn(chars, F.coalesce(F.char_length(f"{at}").cast(docs.schema["n_chars"].dataType), chars))
    return left.toDF(*docs.columns)


def _without(batches: Iterator[pa.RecordBatch], at: int) -> Iterator[pa.RecordBatch]:
    """Batches without the lines in their last column ``gone``; ``lost`` marks texts that lose all they had."""
    for batch in batches:
        texts, lost = batch.column(at).to_pylist(), [False] * batch.num_rows
        for k, gone in enumerate(batch.column(batch.num_columns - 1)):
            if not gone.is_valid:
                continue
            marks = {(g["line_no"], g["line"]) for g in gone.as_py()}
            every = texts[k].split("\n")
            left = [t for i, t in enumerate(every) if (i, hashlib.md5(t.encode()).digest()) not in marks]
            if len(left) < len(every):
                texts[k] = "\n".join(left)
                lost[k] = not texts[k].strip(" \t\n\v\f\r")
        columns = list(batch.columns[:-1])
        columns[at] = pa.array(texts, columns[at].type)
        yield pa.RecordBatch.from_arrays([*columns, pa.array(lost)], [*batch.schema.names[:-1], "lost"])
