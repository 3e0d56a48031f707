"""Merkle manifest of a dataset: a tree for each source, a tree over their roots, and a proof for each row.

H is SHA-256 as lowercase hex of its inputs one after the other, digests as hex text. Every 3 consecutive
nodes become their H (the last run may be shorter, even a single one) until one node is left.

A parent is a *midstate tree* node: it retains a copy of its hash state before each child slot. A change of
one child resumes the copy before that child's slot with the new digest and the siblings to its right only;
what is left of it is never hashed again.

A tree is built in blocks of ARITY**LEVELS successive nodes, whatever key they belong to, bottom up: a block becomes
one node of the next tier. Proofs go top down: a block's task gets the path above its top as one row that
comes first, restores the states on that path once, and retains them for all its nodes. So a source with a
third of all rows is many blocks, no task holds more than a block, and a lost task is run again alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.ordered import by_block, groups, placed, sent, tagged
from orderlens.session import materialize

#: Children of a node.
ARITY = 3
#: Levels of a block, unless another number is asked for.
LEVELS = 6


def _part(col: Column) -> Column:
    """A value as its length in bytes, a colon and its text; null as ``-``."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """H of a row's values."""
    return F.sha2(F.concat(*map(_part, values)).cast("binary"), 256)


def depth(held: int) -> int:
    """Levels above the leaves of a tree of ``held`` leaves."""
    levels = 0
    while held > 1:
        held, levels = -(-held // ARITY), levels + 1
    return levels


def _lifts(held: int, tier: int, levels: int) -> int:
    """Levels that a block of this tier adds in a tree of ``held`` leaves."""
    return min(levels, max(0, depth(held) - tier * levels))


class MidstateTree:
    """Nodes over ``digests``, ``lifts`` levels of them; ``states[level][k]`` is the state before child k's slot."""

    def __init__(self, digests: list[str], lifts: int) -> None:
        self.levels = [[d.encode() for d in digests]]
        self.states: list[list] = []
        for _ in range(lifts):
            above, states = [], []
            for k, child in enumerate(self.levels[-1]):
                if k % ARITY == 0:
                    state = hashlib.sha256()
                states.append(state.copy())
                state.update(child)
                if k % ARITY == ARITY - 1 or k == len(self.levels[-1]) - 1:
                    above.append(state.hexdigest().encode())
            self.states.append(states)
            self.levels.append(above)

    @property
    def top(self) -> str:
        return self.levels[-1][0].decode()

    def siblings(self, k: int) -> list[tuple[bytes, bytes]]:
        """Per level what stands left and right of node k and of its ancestors."""
        path = []
        for nodes in self.levels[:-1]:
            first = k - k % ARITY
            path.append((b"".join(nodes[first:k]), b"".join(nodes[k + 1 : first + ARITY])))
            k //= ARITY
        return path

    def fold(self, k: int, digest: bytes) -> bytes:
        """The top with ``digest`` in the place of node k."""
        for nodes, states in zip(self.levels, self.states):
            state = states[k].copy()
            state.update(digest + b"".join(nodes[k + 1 : k - k % ARITY + ARITY]))
            digest, k = state.hexdigest().encode(), k // ARITY
        return digest


class MidstatePath:
    """Ancestors above a block's top: the state before its slot in each, and what stands right of it."""

    def __init__(self, path: list[tuple[bytes, bytes]]) -> None:
        self.slots = [(hashlib.sha256(left), right) for left, right in path]

    def fold(self, digest: bytes) -> bytes:
        for before, right in self.slots:
            state = before.copy()
            state.update(digest + right)
            digest = state.hexdigest().encode()
        return digest


_NODE = pa.schema([("tree", pa.string()), ("at", pa.int64()), ("held", pa.int64()), ("digest", pa.string())])
_PATH = [("lefts", pa.list_(pa.string())), ("rights", pa.list_(pa.string())), ("subroot", pa.string()), ("root", pa.string())]
_HEAD = pa.schema([("tree", pa.string()), ("at", pa.int64()), *_PATH])
_PROOF = pa.schema([
    ("name", pa.string()), ("at", pa.int64()), ("held", pa.int64()), ("digest", pa.string()), *_PATH, ("folded_root", pa.string()),
])


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.list_(pa.string()): "array<string>"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def _up(nodes: DataFrame, tier: int, levels: int) -> DataFrame:
    """The next tier's nodes."""

    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def top(rows: list[tuple]) -> list[tuple]:
            tree, block, _, held, _ = rows[0]
            return [(tree, block, held, MidstateTree([r[4] for r in rows], _lifts(held, tier, levels)).top)]

        return sent(map(top, groups(batches, 2)), _NODE)

    return by_block(nodes, "tree", ARITY**levels).select("tree", "block", "at", "held", "digest").mapInArrow(tops, _ddl(_NODE))


def _down(nodes: DataFrame, heads: DataFrame, tier: int, levels: int, proofs: bool) -> DataFrame:
    """Paths of a tier's nodes from those of their blocks, ``heads`` (tree, at, *path): the heads of the tier
    below, or their whole proofs. A head is its block's first row."""

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(rows: list[tuple]) -> list[tuple]:
            (tree, _, _, _, _, _, _, lefts, rights, subroot, root), *held = rows
            above = [(a.encode(), b.encode()) for a, b in zip(lefts, rights)]
            own, path, out = MidstateTree([r[4] for r in held], _lifts(held[0][3], tier, levels)), MidstatePath(above), []
            for k, (_, _, at, leaves, digest, name, altered, *_) in enumerate(held):
                siblings = own.siblings(k) + above
                sides = [s.decode() for s, _ in siblings], [s.decode() for _, s in siblings], subroot, root
                if proofs:
                    folded = path.fold(own.fold(k, (digest if altered is None else altered).encode()))
                    out.append((name, at, leaves, digest, *sides, folded.decode()))
                else:
                    out.append((tree, at, *sides))
            return out

        return sent(map(block, groups(batches, 2)), _PROOF if proofs else _HEAD)

    for column in ("name", "altered"):
        if column not in nodes.columns:
            nodes = nodes.withColumn(column, F.lit(None).cast("string"))
    path = [f.name for f in _HEAD][2:]
    first = heads.select("tree", (F.col("at") * ARITY**levels).alias("at"), F.lit(0).alias("kind"), *path)
    rows = nodes.select("tree", "at", F.lit(1).alias("kind"), "held", "digest", "name", "altered").unionByName(first, allowMissingColumns=True)
    together = by_block(rows, "tree", ARITY**levels, "kind", "at")
    return together.select("tree", "block", "at", "held", "digest", "name", "altered", *path).mapInArrow(paths, _ddl(_PROOF if proofs else _HEAD))


class _Forest:
    """Trees over ``leaves`` (tree, at, held, digest and, if need be, name and altered)."""

    def __init__(self, leaves: DataFrame, levels: int) -> None:
        self.tiers, self.levels = [leaves], levels
        most = leaves.agg(F.max("held")).first()[0] or 1
        while len(self.tiers) == 1 or (len(self.tiers) - 1) * levels < depth(most):
            self.tiers.append(materialize(_up(self.tiers[-1], len(self.tiers) - 1, levels), "nodes"))

    @property
    def tops(self) -> DataFrame:
        """(tree, digest), one row a tree."""
        return self.tiers[-1].select("tree", "digest")

    def proofs(self, heads: DataFrame) -> DataFrame:
        """Proof rows of the leaves; ``heads`` (tree, at = 0, *path) leads from each tree's top."""
        last = len(self.tiers) - 2
        for tier in range(last, -1, -1):
            heads = _down(self.tiers[tier], heads, tier, self.levels, proofs=tier == 0)
        return heads


def leaves(docs: DataFrame, text: Column | None = None) -> DataFrame:
    """(doc_id, tree, digest and, if ``text`` is given, altered: the leaf with that text) of documents.

    Columns other than the five of documents are ignored.
    """
    values = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    altered = [] if text is None else [leaf(*values, text).alias("altered")]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), tagged(F.col("source")).alias("tree"), leaf(*values, F.col("text")).alias("digest"), *altered)


def manifest(rows: DataFrame, levels: int = LEVELS) -> DataFrame:
    """doc_id, leaf, at, held, subroot, root, lefts, rights and folded_root for each of ``rows``
    (doc_id, tree, digest and, if wanted, altered: see leaves()).

    ``lefts`` and ``rights`` are a row's proof, level by level from its own run to the root's: what stands left
    and right of its path, as hex digests one after the other. ``folded_root`` is the root that ``altered``
    (null: the leaf itself) gives. Within a tree rows ascend by doc_id, null first, then by digest, so repeated
    rows are leaves of their own, side by side. Trees ascend by their name, bytewise. No rows, no result.
    """
    if "altered" not in rows.columns:
        rows = rows.withColumn("altered", F.lit(None).cast("string"))
    given = materialize(rows.select("doc_id", "tree", "digest", "altered"), "leaves")
    spread = materialize(placed(given, "tree", ["doc_id", "digest"], "placed"), "leaves")
    trees = _Forest(spread.withColumn("name", F.col("doc_id").cast("string")), levels)
    subroots = trees.tops.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    over = _Forest(materialize(placed(subroots, "tree", ["name"], "subroots"), "subroots"), levels)
    none = F.array().cast("array<string>")
    top = over.tops.select("tree", F.lit(0).alias("at"), none.alias("lefts"), none.alias("rights"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    heads = over.proofs(top).select(F.col("name").alias("tree"), F.lit(0).alias("at"), "lefts", "rights", F.col("digest").alias("subroot"), "root")
    found = trees.proofs(materialize(heads, "heads"))
    return found.select(F.col("name").cast("bigint").alias("doc_id"), F.col("digest").alias("leaf"), "at", "held", "subroot", "root", "lefts", "rights", "folded_root")
