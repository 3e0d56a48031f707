"""Conversation structure repair at the least cost, ties by the least audit text.

Roles must read ``(s?(ua)+)?`` by their initials. An automaton reads them: nothing yet, system, user,
assistant; a conversation may end in the first or the last. Every edit has one letter (Keep, Rerole, Delete,
Insert), and from one state a letter leads to one state, so an audit text names one repair.

A node is a state before a row. A cost DP from the end gives each node its least cost to go and so its optimal
arcs. *Prefix-doubling path ranking* then orders the nodes by the least audits that lead on from them: first by
one letter, then by two, four and so on, each time by the rank of a node and of the one that its doubled pointer
reaches. The least path is read through the doubled pointers.

A conversation may hold any share of the rows. It is repaired in chunks of CHUNK rows: a chunk is a 4 x 4 matrix
of least costs, the matrices of a conversation are folded from its end, which gives each chunk the costs after
it; a chunk then tells for each state it may be entered in its audit and the state it is left in, and those are
followed from the start. Only such summaries, one for so many rows, are seen in order; texts join their edits last.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import union_all
from orderlens.llm.ordered import by_block, groups, placed, sent, tagged
from orderlens.session import materialize

#: Rows of a chunk, unless another number is asked for.
CHUNK = 1024
#: Rows of chunks that are worked on side by side.
CELLS = 1 << 16

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
STATES = NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a rerole or an insert leads to, from each state.
WANTED = np.array([USER, USER, ASSISTANT, USER])
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of the edits in the order of the alphabet.
LETTERS = "DIKR"
_D, _I, _K, _R = range(4)
#: What a conversation costs from its end on: inserts until it may end.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])
_FAR = 1 << 40
_WHITE = " \t\n\x0b\f\r"

#: Faults of a row, as numbers.
NONE, BLANK, DUPLICATE, CUT = range(4)


class Paths:
    """Least repairs of chunks side by side. ``initials`` and ``faults`` have a row for each chunk, aligned at
    its end, where ``after`` is the cost to go by state; ``sizes`` counts their rows."""

    def __init__(self, initials: np.ndarray, faults: np.ndarray, sizes: np.ndarray, after: np.ndarray) -> None:
        self.sizes, (self.count, self.width) = sizes, initials.shape
        into = np.stack([(initials == ord("s")) * SYSTEM, (initials == ord("u")) * USER, (initials == ord("a")) * ASSISTANT]).sum(0)
        fits = {NOTHING: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
        worse = np.where(faults == CUT, TRUNCATED, 0)
        must_go = (faults == BLANK) | (faults == DUPLICATE)
        #: cost[i][:, state], and for each letter the costs and targets of the arcs of level i.
        self.cost = [after]
        self.arcs: list[tuple[np.ndarray, np.ndarray]] = []
        for i in range(self.width - 1, -1, -1):
            later = self.cost[-1]
            price, target = np.full((self.count, 4, 4), _FAR), np.zeros((self.count, 4, 4), np.int64)
            for state in STATES:
                keep = np.isin(into[:, i], fits[state]) & ~must_go[:, i]
                price[:, state, _D], target[:, state, _D] = DELETE + later[:, state], state
                price[:, state, _K] = np.where(keep, worse[:, i] + np.take_along_axis(later, into[:, i : i + 1], 1)[:, 0], _FAR)
                target[:, state, _K] = into[:, i]
                price[:, state, _R] = np.where(must_go[:, i], _FAR, REROLE + worse[:, i] + later[:, WANTED[state]])
                price[:, state, _I] = _FAR
                target[:, state, _R] = target[:, state, _I] = WANTED[state]
            least = price.min(axis=2)
            for _ in STATES:  # inserts lead on within the level
                price[:, :, _I] = INSERT + least[:, WANTED]
                least = np.minimum(least, price[:, :, _I])
            self.cost.append(least)
            self.arcs.append((price, target))
        self.cost.reverse()
        self.arcs.reverse()

    def start_costs(self) -> np.ndarray:
        """Least cost by the state that each chunk is entered in."""
        return np.stack([self.cost[self.width - n][g] for g, n in enumerate(self.sizes)])

    def rank(self) -> None:
        """Rank the nodes by their least audits; nodes are numbered level by level, those after the last row are ends."""
        nodes = self.count * (self.width + 1) * 4
        number = np.arange(nodes).reshape(self.width + 1, self.count, 4)
        letter, follow = np.full((self.width + 1, self.count, 4), len(LETTERS)), number.copy()
        chunk = np.arange(self.count)[:, None, None]
        for i, (price, target) in enumerate(self.arcs):
            optimal = price == self.cost[i][:, :, None]
            letter[i] = optimal.argmax(axis=2)  # of the optimal arcs the one of the least letter: no two have the same
            level = np.where(np.arange(4) == _I, i, i + 1)
            reached = number[level, chunk, target]
            follow[i] = np.take_along_axis(reached, letter[i][:, :, None], 2)[:, :, 0]
        rank, pointer = letter.ravel(), follow.ravel()
        self.letter, self.pointers = rank, [pointer]
        length = 1
        while length < 4 * self.width and (pointer != pointer[pointer]).any():
            _, rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)
            pointer = pointer[pointer]
            self.pointers.append(pointer)
            length *= 2
        self.rank_of = rank

    def path(self, chunk: int, state: int) -> tuple[str, int]:
        """The least audit of a chunk entered in ``state``, and the state it is left in."""
        first = ((self.width - self.sizes[chunk]) * self.count + chunk) * 4 + state
        steps = np.arange(1 << len(self.pointers))
        at = np.full(len(steps), first)
        for k, pointer in enumerate(self.pointers):
            at = np.where(steps >> k & 1, pointer[at], at)
        letters = self.letter[at]
        ends = np.flatnonzero(letters == len(LETTERS))
        last = at[ends[0]] if len(ends) else self.pointers[-1][self.pointers[-1][first]]
        return "".join(LETTERS[k] for k in letters[: ends[0] if len(ends) else len(letters)]), int(last % 4)


def _side_by_side(chunks: Iterator[list[tuple]]) -> Iterator[list[list[tuple]]]:
    """Chunks of like length together, in bounded numbers."""
    waiting: dict[int, list] = {}
    for rows in chunks:
        kind = len(rows).bit_length()
        held = waiting.setdefault(kind, [])
        held.append(rows)
        if len(held) << kind >= CELLS:
            yield waiting.pop(kind)
    yield from waiting.values()


def _aligned(held: list[list[tuple]], column: int, fill: int) -> np.ndarray:
    width = max(map(len, held))
    out = np.full((len(held), width), fill, np.int64)
    for k, rows in enumerate(held):
        if rows:
            out[k, width - len(rows) :] = [r[column] for r in rows]
    return out


_SUMMARY = pa.schema([
    ("conv", pa.string()), ("block", pa.int64()), ("matrix", pa.list_(pa.int64())), ("first", pa.int64()), ("last", pa.int64()), ("illegal", pa.int64()),
])
_AFTER = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("cost", pa.int64()), ("illegal", pa.int64())])
_WAYS = pa.schema([
    ("conv", pa.string()), ("block", pa.int64()), ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int64())), ("last_block", pa.bool_()),
])
_TAKEN = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("audit", pa.string()), ("state", pa.int64())])
_WHOLE = pa.schema([("conv", pa.string()), ("audit", pa.string())])
_EDITS = pa.schema([
    ("conv", pa.string()), ("step", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("old_role", pa.string()), ("digest", pa.string()),
])
_LEGAL = {(ord(a), ord(b)) for a, b in ("su", "ua", "au")}


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.bool_(): "boolean", pa.list_(pa.int64()): "array<bigint>", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _illegal(initials: list[int]) -> int:
    return sum(pair not in _LEGAL for pair in zip(initials, initials[1:]))


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (conv, block, at, initial, fault) in order: least costs between the states before and after each chunk."""

    def summed(held: list[list[tuple]]) -> list[tuple]:
        matrix = []
        for end in STATES:
            after = np.where(np.arange(4) == end, 0, _FAR) + np.zeros((len(held), 1), np.int64)
            matrix.append(Paths(_aligned(held, 3, 0), _aligned(held, 4, NONE), np.array([len(r) for r in held]), after).start_costs())
        found = np.minimum(np.stack(matrix, axis=2), _FAR).reshape(len(held), 16).tolist()
        return [(r[0][0], r[0][1], m, r[0][3], r[-1][3], _illegal([x[3] for x in r])) for r, m in zip(held, found)]

    return sent(map(summed, _side_by_side(groups(batches, 2))), _SUMMARY)


def _from_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From summaries, the last chunk of a conversation first: the costs after each chunk, and totals with its first one."""

    def folded() -> Iterator[list[tuple]]:
        conv, after, illegal, later = None, AT_END, 0, 0
        for batch in batches:
            rows = []
            for name, block, matrix, first, last, own in zip(*(c.to_pylist() for c in batch.columns)):
                if name != conv:
                    conv, after, illegal, later = name, AT_END, 0, None
                illegal += own + (later is not None and (last, later) not in _LEGAL)
                later = first
                before = np.minimum((np.array(matrix).reshape(4, 4) + after).min(axis=1), _FAR)
                rows.append((name, block, after.tolist(), int(before[NOTHING]), illegal))
                after = before
            yield rows

    return sent(folded(), _AFTER)


def _ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a chunk's head and rows: its least audit and its end for each state it may be entered in."""

    def ways(held: list[list[tuple]]) -> list[tuple]:
        heads, rows = [r[0] for r in held], [r[1:] for r in held]
        paths = Paths(_aligned(rows, 3, 0), _aligned(rows, 4, NONE), np.array([len(r) for r in rows]), np.array([h[5] for h in heads]))
        paths.rank()
        out = []
        for k, head in enumerate(heads):
            found = [paths.path(k, state) for state in STATES]
            out.append((head[0], head[1], [audit for audit, _ in found], [end for _, end in found], head[6]))
        return out

    return sent(map(ways, _side_by_side(groups(batches, 2))), _WAYS)


def _from_the_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the ways of a conversation's chunks in order: the one that is taken, and the state it starts in."""

    def followed() -> Iterator[list[tuple]]:
        conv, state = None, NOTHING
        for batch in batches:
            rows = []
            for name, block, audits, ends, last in zip(*(c.to_pylist() for c in batch.columns)):
                if name != conv:
                    conv, state = name, NOTHING
                end = ends[state]
                more = LETTERS[_I] * (AT_END[end] // INSERT) if last else ""
                rows.append((name, block, audits[state] + more, state))
                state = end
            yield rows

    return sent(followed(), _TAKEN)


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From a chunk's audit and its rows: one row for each edit; ``step`` orders a conversation's edits."""

    def edits(rows: list[tuple]) -> list[tuple]:
        (conv, _, _, _, _, _, _, audit, state), *held = rows
        out, left, at = [], iter(held), held[0][2]
        inserted = 0
        for letter in audit:
            if letter == "I":
                state = WANTED[state]
                out.append((conv, at * 4 + inserted, letter, None, ROLES[state], None, None))
                inserted += 1
                continue
            _, _, at, initial, role, turn, digest, _, _ = next(left)
            if letter == "R":
                state = WANTED[state]
            elif letter == "K":
                state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[chr(initial)]
            out.append((conv, at * 4 + 3, letter, turn, ROLES[state] if letter == "R" else role, role, digest))
            at, inserted = at + 1, 0
        return out

    return sent(map(edits, groups(batches, 2)), _EDITS)


@dataclass(frozen=True)
class Repair:
    """``report``: a row for each conversation; ``edits``: a row for each edit; ``rows``: the repaired conversations."""

    report: DataFrame
    edits: DataFrame
    rows: DataFrame


def _texts(rows: DataFrame) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return rows.select(
        tagged(F.col("conv_id")).alias("conv"), F.col("turn").cast("bigint").alias("turn"), text("role").alias("role"), text("text").alias("text")
    ).withColumn("digest", F.sha2(F.col("text").cast("binary"), 256))


def _faults(rows: DataFrame) -> DataFrame:
    """(conv, at, turn, role, digest, initial, fault) of the rows of ``_texts``."""
    shown = F.rtrim("text", F.lit(_WHITE))
    kind = F.when(shown == "", BLANK).when(~F.substring(shown, -1, 1).isin(*".!?"), CUT).otherwise(NONE)
    light = materialize(rows.select("conv", "turn", "role", "digest", kind.alias("fault")), "turns")
    at = materialize(placed(light, "conv", ["turn", "role", "digest"], "placed").drop("held"), "turns")
    same = ["conv", "role", "digest"]
    seen = at.groupBy(*same).agg(F.min("at").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    fault = F.when(F.col("fault") == BLANK, BLANK).when(F.col("at") > F.col("first"), DUPLICATE).otherwise(F.col("fault"))
    return at.join(seen, same, "left").select(
        "conv", "at", "turn", "role", "digest", F.ascii(F.substring("role", 1, 1)).cast("bigint").alias("initial"), fault.cast("bigint").alias("fault")
    )


def _stacked(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def repair(rows: DataFrame, known: DataFrame | None = None, chunk: int = CHUNK) -> Repair:
    """Repair conversations of ``rows`` (conv_id, turn, role, text); ``known`` names more conversations, in conv_id.

    Rows go by turn, null first, then by role and text, so repeated rows are next to each other. Null roles and
    texts are empty, a null conv_id is a conversation like any other, other columns are ignored. The report has conv
    (the conversation's tag), conv_id, gaps, blank, duplicate, truncated, illegal, cost and audit; a conversation
    without rows has zeros and an empty audit. Edits are (conv, step, edit, turn, role, old_role, digest of the
    text), repaired rows (conv, step, role, text). Empty tables give empty results.
    """
    texts = _texts(rows)
    found = materialize(_faults(texts), "faults")
    blocks = by_block(found, "conv", chunk).select("conv", "block", "at", "initial", "fault")
    summaries = materialize(blocks.mapInArrow(_summaries, _ddl(_SUMMARY)), "summaries")
    backwards = summaries.repartition("conv").sortWithinPartitions("conv", F.desc("block"))
    after = materialize(backwards.mapInArrow(_from_the_end, _ddl(_AFTER)), "after")
    last = after.groupBy("conv").agg(F.max("block").alias("final"))
    totals = after.where("block = 0").select("conv", "cost", "illegal")
    heads = after.join(last, "conv").select(
        "conv", (F.col("block") * chunk).alias("at"), "after", (F.col("block") == F.col("final")).alias("last_block"), F.lit(0).alias("kind")
    )
    light = found.withColumn("kind", F.lit(1))
    ways = by_block(_stacked([light.select("conv", "at", "initial", "fault", "kind"), heads]), "conv", chunk, "kind", "at")
    ways = ways.select("conv", "block", "at", "initial", "fault", "after", "last_block").mapInArrow(_ways, _ddl(_WAYS))
    forwards = ways.repartition("conv").sortWithinPartitions("conv", "block")
    taken = materialize(forwards.mapInArrow(_from_the_start, _ddl(_TAKEN)), "taken")
    audits = taken.select("conv", (F.col("block") * chunk).alias("at"), "audit", "state", F.lit(0).alias("kind"))
    dealt = by_block(_stacked([light, audits]), "conv", chunk, "kind", "at")
    edits = materialize(
        dealt.select("conv", "block", "at", "initial", "role", "turn", "digest", "audit", "state").mapInArrow(_edits, _ddl(_EDITS)), "edits"
    )
    return Repair(_report(found, totals, taken, rows, known), edits, _repaired(edits, texts))


def _report(found: DataFrame, totals: DataFrame, taken: DataFrame, rows: DataFrame, known: DataFrame | None) -> DataFrame:
    held = lambda fault: F.count_if(F.col("fault") == fault)
    turns = found.groupBy("conv", "turn").agg(*[held(k).alias(name) for k, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (CUT, "truncated"))])
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")  # one row for each turn
    counts = turns.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")]
    )
    audits = taken.repartition("conv").sortWithinPartitions("conv", "block").select("conv", "block", "audit").mapInArrow(_joined, _ddl(_WHOLE))
    ids = union_all([df.select("conv_id") for df in (rows, known) if df is not None]).distinct()
    named = ids.withColumn("conv", tagged(F.col("conv_id")))
    whole = named.join(counts, "conv", "left").join(totals, "conv", "left").join(audits, "conv", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return whole.select(
        "conv", "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit")
    )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole audits from those of chunks in order."""
    return sent(([(rows[0][0], "".join(r[2] for r in rows))] for rows in groups(batches, 1)), _WHOLE)


def _repaired(edits: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows that stay, with their texts. A role and text of a conversation stay once at most, so texts join without a hot key."""
    stay = edits.where("edit in ('K', 'R')").select("conv", "step", "role", "old_role", "digest")
    text_of = texts.groupBy("conv", F.col("role").alias("old_role"), "digest").agg(F.any_value("text").alias("text"))
    kept = stay.join(text_of, ["conv", "old_role", "digest"]).select("conv", "step", "role", "text")
    return kept.unionByName(edits.where("edit = 'I'").select("conv", "step", "role", F.lit("").alias("text")))


_DIGEST = pa.schema([("conv", pa.string()), ("sha256", pa.string())])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def digests() -> Iterator[list[tuple]]:
        conv, state = None, None
        for batch in batches:
            rows = []
            for name, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if name != conv:
                    if state is not None:
                        rows.append((conv, state.hexdigest()))
                    conv, state = name, hashlib.sha256(f"{role}:{text}".encode())
                else:
                    state.update(f"\n{role}:{text}".encode())
            yield rows
        if state is not None:
            yield [(conv, state.hexdigest())]

    return sent(digests(), _DIGEST)


def digests(repaired: DataFrame) -> DataFrame:
    """(conv, sha256) over ``role:text`` of repaired rows, joined by newlines. A conversation's rows stream by in order."""
    ordered = repaired.repartition("conv").sortWithinPartitions("conv", "step").select("conv", "role", "text")
    return ordered.mapInArrow(_digest, _ddl(_DIGEST))
