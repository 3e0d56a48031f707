"""Toxicity by a counterfactual-regularised classifier over passages.

A passage is a run of at most PASSAGE words; its logit is the sum of hashed weights of its distinct
words and of their first 4, 5 and 6 bytes, so inflected forms share weights. Features that fewer than
MIN_DOCS of the fitted documents have weigh nothing, so that no document is learnt by heart. A document scores as its worst
passage, calibrated to a probability, so one insult in a long text counts. Labels are of documents:
a first fit gives every passage its document's label, a second keeps only the worst passages of
toxic ones.

Passages that name a group get a counterfactual in which each identity term is swapped for another
of its list. The fit penalises the squared difference of the two logits, so that a group's name
cannot carry weight that its neighbours' names do not: neutral mentions stop being false positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.hashing import mix, runs, span_hashes, spans
from orderlens.llm.scoring import descend, lists, sample, sigmoid, sparse
from orderlens.session import materialize

PASSAGE = 32
BUCKETS = 1 << 22
MIN_DOCS = 6
PREFIXES = (4, 5, 6)
#: Labelled documents of each class the fit uses at most, and bytes of their texts; scoring reads everything.
SAMPLE = 1500
SAMPLE_BYTES = 1 << 24
STEPS, RATE, DECAY, PENALTY = 70, 0.1, 5e-4, 1.0
CUT = 0.7

# Lists of interchangeable identity terms, in lower case; a parameter of fit().
IDENTITIES = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("old", "young"),
    ("disabled", "deaf", "blind"),
)

_OUTSIDE = np.ones(256, bool)  # bytes that belong to no word: all but ASCII letters, digits and what lies beyond ASCII
_OUTSIDE[128:] = False
for _first, _last in ("az", "AZ", "09"):
    _OUTSIDE[ord(_first) : ord(_last) + 1] = False


def _word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of words, and their buckets: a row per word, a column per feature."""
    whole = span_hashes(data, starts, ends)
    columns = [whole % np.uint64(BUCKETS)]
    for k in PREFIXES:
        part = span_hashes(data, starts, np.minimum(ends, starts + k))
        columns.append(mix(part + np.uint64(k)) % np.uint64(BUCKETS))
    return whole, np.stack(columns, axis=1).astype(np.int64) if len(starts) else np.zeros((0, 1 + len(PREFIXES)), np.int64)


def _passages(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per run: rows, word hashes, word features, starts of passages and their offsets by row."""
    for first, end, data, offsets in runs(column):
        starts, ends, rows = spans(data, offsets, _OUTSIDE)
        counts = -(-np.diff(rows) // PASSAGE)
        by_row = np.concatenate([[0], np.cumsum(counts)])
        at = np.repeat(rows[:-1], counts) + PASSAGE * (np.arange(by_row[-1]) - np.repeat(by_row[:-1], counts))
        yield first, end, *_word_features(data, starts, ends), at, by_row


def _first_uses(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Marks the words of a run that their passage holds for the first time."""
    passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words))))
    _, first = np.unique(mix(words + mix(passage.astype(np.uint64))), return_index=True)
    fresh = np.zeros(len(words), bool)
    fresh[first] = True
    return fresh


def term_features(terms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer("".join(terms).encode(), np.uint8)
    ends = np.cumsum(np.array([len(t.encode()) for t in terms], np.int64))
    return _word_features(data, np.concatenate([ends[:0], [0], ends[:-1]]).astype(np.int64)[: len(terms)], ends)


class Swaps:
    """Word hash of an identity term -> features of the term it is swapped for."""

    def __init__(self, identities: tuple[tuple[str, ...], ...]) -> None:
        terms = [t for group in identities for t in group]
        others = [group[(k + 1) % len(group)] for group in identities for k in range(len(group))]
        hashes, _ = term_features(terms)
        _, features = term_features(others)
        order = np.argsort(hashes)
        self.hashes, self.features = hashes[order], features[order]

    def apply(self, words: np.ndarray, features: np.ndarray) -> np.ndarray | None:
        """The passage's counterfactual features, or None if it names no group."""
        if not len(self.hashes) or not len(words):
            return None
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        named = self.hashes[at] == words
        if not named.any():
            return None
        swapped = features.copy()
        swapped[named] = self.features[at[named]]
        return swapped


class Model(NamedTuple):
    weights: np.ndarray
    bias: float
    scale: float  # of the worst passage's logit
    shift: float

    def scores(self, column: pa.Array) -> np.ndarray:
        """Probability per row; a row without words scores as one whose words say nothing."""
        out = np.empty(len(column))
        for first, end, words, features, starts, by_row in _passages(column):
            worst = np.full(end - first, min(self.bias, 0.0))
            if len(features):
                each = self.weights[features].sum(axis=1) * _first_uses(words, starts)
                sums = np.add.reduceat(each, starts) + self.bias
                has = np.diff(by_row) > 0
                worst[has] = np.maximum.reduceat(sums, by_row[:-1][has])
            out[first:end] = sigmoid(self.scale * worst + self.shift)
        return out


def fit_passages(docs: np.ndarray, labels: np.ndarray, features: list[np.ndarray], swapped: list[np.ndarray | None]) -> Model:
    """docs: document number of each passage, ascending; labels: by document."""
    seen = np.unique(np.concatenate([np.zeros(0, np.int64), *(d * BUCKETS + np.unique(f) for d, f in zip(docs, features))]))
    used, in_docs = np.unique(seen % BUCKETS, return_counts=True)
    used = used[in_docs >= MIN_DOCS]

    def known(at: np.ndarray) -> np.ndarray:
        """Places among the used buckets."""
        place = np.minimum(np.searchsorted(used, at), max(0, len(used) - 1))
        return place[used[place] == at] if len(used) else at[:0]

    size = len(used)
    features = [known(f) for f in features]
    swapped = [None if s is None else known(s) for s in swapped]
    twins = [k for k, s in enumerate(swapped) if s is not None]
    twin_rows = sparse([swapped[k] for k in twins])
    twins = np.array(twins, np.int64)

    def fitted(keep: np.ndarray, target: np.ndarray, start: np.ndarray) -> np.ndarray:
        rows = sparse([features[k] for k in keep])
        place = np.full(len(features), -1)
        place[keep] = np.arange(len(keep))
        own = place[twins]
        paired = own >= 0
        share = np.where(target == 1, 0.5 / max(1, target.sum()), 0.5 / max(1, (1 - target).sum()))

        def slope(at: np.ndarray) -> np.ndarray:
            weights, bias = at[:-1], at[-1]
            z = rows.dot(weights) + bias
            by_z = (sigmoid(z) - target) * share
            gap = np.where(paired, z[own] - bias - twin_rows.dot(weights), 0.0) if len(twins) else np.zeros(0)
            push = 2 * PENALTY * gap / max(1, len(twins))
            direct = by_z + (np.bincount(own[paired], push[paired], len(keep)) if len(twins) else 0)
            g = rows.back(direct, size) + DECAY * weights
            if len(twins):
                g = g - twin_rows.back(push, size)
            return np.concatenate([g, [by_z.sum()]])

        return descend(start, slope, STEPS, RATE)

    everything = np.arange(len(features))
    at = fitted(everything, labels[docs], np.zeros(size + 1))
    z = sparse(features).dot(at[:-1]) + at[-1]
    first = np.flatnonzero(np.concatenate([[True], docs[1:] != docs[:-1]])) if len(docs) else np.zeros(0, np.int64)
    worst = np.maximum.reduceat(z, first) if len(first) else np.zeros(0)
    by_doc = np.zeros(len(labels))
    by_doc[docs[first]] = worst
    keep = np.flatnonzero((labels[docs] == 0) | (z >= np.maximum(by_doc[docs] - 0.5, 0)) | (z >= by_doc[docs]))
    at = fitted(keep, labels[docs[keep]], at)
    z = sparse(features).dot(at[:-1]) + at[-1]
    worst = np.maximum.reduceat(z, first) if len(first) else np.zeros(0)
    y = labels[docs[first]] if len(first) else np.zeros(0)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))

    def calibrate(ab: np.ndarray) -> np.ndarray:
        error = (sigmoid(ab[0] * worst + ab[1]) - y) * share
        return np.array([(error * worst).sum() + 1e-3 * (ab[0] - 1), error.sum()])

    scale, shift = descend(np.array([1.0, 0.0]), calibrate, 400, 0.02)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = at[:-1]
    return Model(weights, float(at[-1]), float(scale), float(shift))


def _sampled(docs: DataFrame, labels: DataFrame, label: str, most: int, most_bytes: int) -> DataFrame:
    """(doc_id, label, text) of the labelled rows to fit on, whole texts, landed as two jobs read them."""
    chosen = sample(labels, label, most, F.col(label) == 1).unionByName(sample(labels, label, most, F.col(label) == 0))
    chosen = F.broadcast(chosen.groupBy("doc_id").agg(F.max("label").alias("label")))
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = materialize(plain.where("text is not null").join(chosen, "doc_id").select("doc_id", "label", "text"), "labelled")
    sizes = rows.groupBy("doc_id", "label").agg(F.sum(F.octet_length("text")).alias("size")).where(F.col("size") <= most_bytes // 16)
    total = F.sum("size").over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id"))
    fitting = sizes.withColumn("total", total).where(F.col("total") <= most_bytes).select("doc_id")
    return rows.join(F.broadcast(fitting), "doc_id")


def fit(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", identities: tuple[tuple[str, ...], ...] = IDENTITIES,
    most: int = SAMPLE, most_bytes: int = SAMPLE_BYTES,
) -> Model:
    """Fit on every passage of at most ``most`` labelled documents of each class, chosen by a hash of doc_id.

    Of those, documents of more than a sixteenth of ``most_bytes`` are not taken, nor those after the first
    ``most_bytes`` of text of a class; what is taken is read whole. Those bounds make collecting the features
    safe. Labels of other values than 0 and 1 are ignored.
    """
    swaps = Swaps(identities)

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("label").to_pylist()
            for first, end, words, features, starts, by_row in _passages(batch.column("text")):
                for k in range(end - first):
                    for p in range(by_row[k], by_row[k + 1]):
                        until = min(starts[p] + PASSAGE, starts[p + 1] if p + 1 < len(starts) else len(words))
                        own_words, part = words[starts[p] : until], features[starts[p] : until]
                        fresh = _first_uses(own_words, np.zeros(1, np.int64))
                        own_words, part = own_words[fresh], part[fresh]
                        other = swaps.apply(own_words, part)
                        rows.append((ids[first + k], marks[first + k], p - by_row[k], part.ravel(), None if other is None else other.ravel()))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["doc_id", "label", "place", "at", "swapped"])

    marked = _sampled(docs, labels, label, most, most_bytes).select("doc_id", "label", "text")
    rows = marked.mapInArrow(featurise, "doc_id bigint, label int, place bigint, at array<int>, swapped array<int>").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("place", "ascending")])
    ids, docs_of = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)
    marks = np.zeros(len(ids))
    marks[docs_of] = rows["label"].to_numpy()
    return fit_passages(docs_of, marks, lists(rows["at"]), lists(rows["swapped"]))


def score(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """doc_id, score and predicted (1 if the score reaches ``cut``) per row; null texts count as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def grade(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(shared.value.scores(batch.column("text")))], ["doc_id", "score"]
            )

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(grade, "doc_id bigint, score double").withColumn("predicted", (F.col("score") >= cut).cast("int"))
