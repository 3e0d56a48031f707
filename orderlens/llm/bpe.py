"""Byte-pair encoding and decoding of whole texts, as the vocabulary's own library does it.

A text is cut at the vocabulary's special tokens, then into words by its pattern. A word starts as the ids of
its bytes. A segment tree over its adjacent pairs holds at each leaf the pair's rank and place, at each inner
node the less of its two children, so that the root is the leftmost pair of the lowest rank. A merge changes
three leaves and the nodes above them; it ends when no pair is left that the vocabulary merges. A word of n
bytes takes n log n steps, however long it is.

Spark deals the rows over tasks and nothing is shuffled; a worker remembers the ids of a bounded number of
short pieces, and else holds one batch.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
#: Pieces of at most so many characters whose ids a worker remembers, and how many of them.
SHORT, REMEMBERED = 48, 500_000
#: Words of up to so many bytes are merged side by side, longer ones one by one.
MANY = 64
#: Bytes of text, or ids, that are worked on together.
CHARS = 1 << 20

_NONE = 1 << 62
_PLACE_BITS = 40
_PLACE = (1 << _PLACE_BITS) - 1


def _byte_names() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is printable and no
    space, else the next free one from 256 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


#: Words as the vocabulary's pattern cuts them.
_WORDS = regex.compile(public_tokenizers.PATTERN)
#: A code point that the pattern takes for neither white space, letter nor number.
_OTHER = "\ufffe"


@cache
def _young() -> frozenset[str]:
    """Letters and numbers of the pattern's library that are younger than the vocabulary's Unicode version,
    which is the one of Python's character data; to the vocabulary they are neither."""
    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", every) if unicodedata.category(c) == "Cn")


def words(text: str) -> list[str]:
    """``text`` cut into words."""
    if text.removeprefix(" ").isalpha():
        return [text]
    if text.isascii() or _young().isdisjoint(text):
        return _WORDS.findall(text)
    known = "".join(_OTHER if c in _young() else c for c in text)
    return [text[m.start() : m.end()] for m in _WORDS.finditer(known)]


class MergeTree:
    """A word's symbols and, over its adjacent pairs, a segment tree of (rank, place) as one number each."""

    def __init__(self, symbols: list[int], ranks: dict[tuple[int, int], int]) -> None:
        self.symbols, self.ranks, n = symbols, ranks, len(symbols)
        self.after, self.before = list(range(1, n + 1)), list(range(-1, n - 1))
        self.leaves = 1 << max(0, n - 2).bit_length()
        pairs = [self._key(i, i + 1) for i in range(n - 1)]
        self.nodes = nodes = [_NONE] * self.leaves + pairs + [_NONE] * (self.leaves - len(pairs))
        for k in range(self.leaves - 1, 0, -1):
            a, b = nodes[2 * k], nodes[2 * k + 1]
            nodes[k] = a if a < b else b

    def _key(self, i: int, j: int) -> int:
        rank = self.ranks.get((self.symbols[i], self.symbols[j]))
        return _NONE if rank is None else rank << _PLACE_BITS | i

    def _put(self, place: int, key: int) -> None:
        nodes, k = self.nodes, self.leaves + place
        nodes[k] = key
        while k > 1:
            a, b = nodes[k], nodes[k ^ 1]
            k >>= 1
            least = a if a < b else b
            if nodes[k] == least:
                return
            nodes[k] = least

    def merged(self, made: np.ndarray) -> list[int]:
        """The symbols when no pair is left; ``made`` gives the symbol that a rank makes."""
        symbols, after, before, end = self.symbols, self.after, self.before, len(self.symbols)
        while (least := self.nodes[1]) != _NONE:
            i = least & _PLACE
            j = after[i]
            k = after[j]
            symbols[i], symbols[j], after[i] = int(made[least >> _PLACE_BITS]), -1, k
            if j < end - 1:
                self._put(j, _NONE)
            if k < end:
                before[k] = i
                self._put(i, self._key(i, k))
            else:
                self._put(i, _NONE)
            if (p := before[i]) >= 0:
                self._put(p, self._key(p, i))
        return [s for s in symbols if s >= 0]


class MergeForest:
    """Merge trees of many words of about the same length side by side, a row each: every round merges at
    the roots of all words that still have a pair."""

    def __init__(self, symbols: np.ndarray, sizes: np.ndarray, ranks: Ranks) -> None:
        self.symbols, self.sizes, self.ranks = symbols, sizes, ranks
        count, width = symbols.shape
        self.leaves = width  # a power of two; the last leaf has no pair
        place = np.arange(width)
        self.after, self.before = (np.tile(place + d, (count, 1)) for d in (1, -1))
        key = np.full((count, width), _NONE, np.int64)
        key[:, :-1] = ranks.keys(symbols[:, :-1], symbols[:, 1:], place[:-1])
        key[place >= sizes[:, None] - 1] = _NONE
        self.nodes = np.full((count, 2 * width), _NONE, np.int64)
        self.nodes[:, width:] = key
        k = width
        while k > 1:
            self.nodes[:, k // 2 : k] = np.minimum(self.nodes[:, k : 2 * k : 2], self.nodes[:, k + 1 : 2 * k : 2])
            k //= 2

    def merged(self) -> np.ndarray:
        """The symbols when no pair is left; places that were merged away hold -1."""
        symbols, after, before, nodes = self.symbols, self.after, self.before, self.nodes
        row = np.arange(len(symbols))
        while len(row := row[nodes[row, 1] != _NONE]):
            least, end = nodes[row, 1], self.sizes[row]
            i = least & _PLACE
            j = after[row, i]
            k, p = after[row, j], before[row, i]
            symbols[row, i], symbols[row, j], after[row, i] = self.ranks.made[least >> _PLACE_BITS], -1, k
            inner, later = p >= 0, k < end
            before[row[later], k[later]] = i[later]
            nodes[row, self.leaves + j] = _NONE
            right, left = np.full(len(row), _NONE, np.int64), np.full(len(row), _NONE, np.int64)
            right[later] = self.ranks.keys(symbols[row[later], i[later]], symbols[row[later], k[later]], i[later])
            left[inner] = self.ranks.keys(symbols[row[inner], p[inner]], symbols[row[inner], i[inner]], p[inner])
            nodes[row, self.leaves + i] = right
            nodes[row[inner], self.leaves + p[inner]] = left[inner]
            up = self.leaves + np.stack([np.where(inner, p, i), i, j])
            while up[0, 0] > 1:
                up >>= 1
                nodes[row, up] = np.minimum(nodes[row, 2 * up], nodes[row, 2 * up + 1])
        return symbols


class Ranks:
    """Ranks of mergeable pairs, and what a merge of each rank makes."""

    def __init__(self, pairs: list[tuple[int, int]], made: list[int]) -> None:
        self.one = {pair: rank for rank, pair in enumerate(pairs)}
        self.made = np.array(made, np.int64)
        pair = np.array([a << 32 | b for a, b in pairs], np.int64)
        self.order = np.argsort(pair)
        self.pairs = np.append(pair[self.order], _NONE)
        self.order = np.append(self.order, 0)

    def keys(self, a: np.ndarray, b: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Rank and place of each pair as one number, _NONE where the vocabulary doesn't merge it."""
        pair = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.pairs, pair)
        return np.where(self.pairs[at] == pair, self.order[at] << _PLACE_BITS | place, _NONE)


class Coder:
    """Encodes and decodes with one vocabulary; ids are little-endian unsigned 32-bit numbers in bytes."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary, merges = held["model"]["vocab"], held["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.ranks = Ranks([(vocabulary[a], vocabulary[b]) for a, b in pairs], [vocabulary[a + b] for a, b in pairs])
        names = _byte_names()
        self.of_byte = np.array([vocabulary[name] for name in names], np.int64)
        byte = {name: k for k, name in enumerate(names)}
        self.special = {t["content"]: t["id"] for t in held["added_tokens"]}
        self.bytes_of = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, k in vocabulary.items():
            self.bytes_of[k] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        for token, k in self.special.items():
            self.bytes_of[k] = token.encode()
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if longest_first else None
        #: Ids of short pieces: by what follows their one space, and of those that start with none.
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}

    def words(self, found: list[str]) -> list[bytes]:
        """Ids of each word."""
        raw, out = [w.encode() for w in found], [b""] * len(found)
        sizes = np.array([len(b) for b in raw], np.int64)
        kinds = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
        for kind in np.unique(kinds):
            own = np.flatnonzero(kinds == kind)
            if 1 << kind > MANY:
                for k in own:
                    symbols = self.of_byte[np.frombuffer(raw[k], np.uint8)].tolist()
                    out[k] = np.array(MergeTree(symbols, self.ranks.one).merged(self.ranks.made), "<u4").tobytes()
                continue
            bytes_ = np.frombuffer(b"".join(raw[k].ljust(1 << kind, b"\0") for k in own), np.uint8).reshape(len(own), 1 << kind)
            symbols = self.of_byte[bytes_]
            symbols[np.arange(1 << kind) >= sizes[own, None]] = -1
            left = MergeForest(symbols, sizes[own], self.ranks).merged()
            ids, ends = left[left >= 0].astype("<u4"), np.cumsum((left >= 0).sum(axis=1)) * 4
            held, start = ids.tobytes(), 0
            for k, end in zip(own.tolist(), ends.tolist()):
                out[k], start = held[start:end], end
        return out

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of pieces."""
        cut = [words(piece) for piece in pieces]
        of_word = {word: self.known(word) for one in cut for word in one}
        new = [word for word, ids in of_word.items() if ids is None]
        of_word.update(zip(new, self.words(new)))
        return {piece: b"".join(map(of_word.__getitem__, one)) for piece, one in zip(pieces, cut)}

    def known(self, word: str) -> bytes | None:
        """Ids of a word that is a remembered piece."""
        return self.spaced.get(word[1:]) if word[0] == " " else self.bare.get(word)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. The pieces that are not remembered are encoded together."""
        parts = [self.cut.split(text or "") if self.cut else [text or ""] for text in texts]
        cut = [[_pieces(t) for t in one[::2]] for one in parts]
        firsts = {first for one in cut for first, _ in one if first not in self.bare}
        rests = {word for one in cut for _, rest in one for word in set(rest) if word not in self.spaced}
        new = self.learn([*firsts, *(" " + word for word in rests)])
        for known, words_, space in ((self.bare, firsts, ""), (self.spaced, rests, " ")):
            known.update((w, new[space + w]) for w in words_)
        found = []
        for one, pieces in zip(parts, cut):
            held = []
            for k, (first, rest) in enumerate(pieces):
                held += [self.bare[first], *map(self.spaced.__getitem__, rest)]
                if k < len(pieces) - 1:
                    held.append(np.array([self.special[one[2 * k + 1]]], "<u4").tobytes())
            found.append(np.frombuffer(b"".join(held), "<u4").astype(np.int32))
        self.forget(firsts, rests)
        return found

    def forget(self, firsts: set[str], rests: set[str]) -> None:
        """Long pieces, and all that are new where more are held than a worker remembers."""
        for known, new in ((self.bare, firsts), (self.spaced, rests)):
            full = len(known) > REMEMBERED
            for word in new:
                if full or len(word) > SHORT:
                    del known[word]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


#: White space as the pattern knows it.
_WHITE = "\t-\r \x85\xa0  -     　"
_TWO_WHITE = re.compile(f"[{_WHITE}]{{2}}")
_BEFORE_WORD = re.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")


def _pieces(text: str) -> tuple[str, list[str]]:
    """The text up to the first space that stands alone between visible characters, and what follows each
    such space: a word starts there, so pieces are encoded alone."""
    first, *rest = _BEFORE_WORD.split(text) if _TWO_WHITE.search(text) else text.split(" ")
    return first, rest


@cache
def coder(path: str = VOCABULARY) -> Coder:
    """One per worker process, made on first use."""
    return Coder(path)


def _slices(batch: pa.RecordBatch, lengths: pa.Array, most: int) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose lengths sum up to ``most``, or single ones that are longer."""
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(ends):
        before = ends[first - 1] if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(first, end - first)
        first = end


def _encode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    encode = coder(path).encode
    for batch in batches:
        for part in _slices(batch, pc.binary_length(batch.column(1)), CHARS):
            ids = encode(part.column(1).to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            values = pa.array(np.concatenate(ids), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(ends), values)], ["doc_id", "ids"])


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    decode = coder(path).decode
    for batch in batches:
        for part in _slices(batch, pc.list_value_length(batch.column(1)), CHARS):
            ids = part.column(1).flatten().to_numpy(zero_copy_only=False).tolist()
            ends = np.cumsum([0, *pc.list_value_length(part.column(1)).fill_null(0).to_pylist()]).tolist()
            texts = [decode(ids[a:b]) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (array<int>) of each row of ``docs``, special tokens inside texts included.

    A null or empty text has no ids. Other columns are ignored; a null doc_id stays null, repeated rows stay.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(partial(_encode, path=vocabulary), "doc_id bigint, ids array<int>")


def decoded(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, ids and text of each of ``rows`` (doc_id, ids); bytes that are no UTF-8 become U+FFFD, null ids are none."""
    return rows.select("doc_id", "ids").mapInArrow(partial(_decode, path=vocabulary), "doc_id bigint, ids array<int>, text string")
