"""Harmonic packing: documents into sequences of at most 1024 tokens, by reciprocal-capacity classes.

A piece of n tokens is of class floor(CAPACITY / n), and a bin of class k holds k of its pieces,
whatever their lengths: no search, no state but one open bin a class, so every worker packs what
it reads and nothing is shuffled. To waste little, a document is cut into full sequences, then
into pieces of CAPACITY / 2, / 4, ... down to SMALLEST (which fill their bins to the last token),
and a tail below SMALLEST, whose class loses at most one tail a bin.

A worker's last bins are not full. Their pieces are cut into powers of two and put together into
sequences that are a power of two long, which need no padding.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.tokens import VOCABULARY, encoder

CAPACITY = 1024
SMALLEST = 32
END_OF_TEXT = b"\0\0\0\0"
#: sequence_id holds the partition above this bit.
SEQUENCE_BITS = 40

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_length bigint, ids binary"
)
_ARROW = pa.schema([(name, pa.int64()) for name in (
    "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "sequence_length"
)] + [("ids", pa.binary())])
#: Pieces are sent on when there are so many.
_SEND = 4096


def cut(tokens: int) -> list[int]:
    """Lengths of a document's pieces, in order."""
    pieces = [CAPACITY] * (tokens // CAPACITY)
    left, size = tokens % CAPACITY, CAPACITY // 2
    while size >= SMALLEST:
        if left >= size:
            pieces.append(size)
            left -= size
        size //= 2
    return pieces + [left] * (left > 0)


def halves(length: int) -> list[int]:
    """``length`` as powers of two, the largest first."""
    return [1 << k for k in reversed(range(length.bit_length())) if length >> k & 1]


class _Packer:
    """Open bins of one worker; a piece is (doc_id, start, ids, doc_tokens)."""

    def __init__(self, partition: int, with_ids: bool) -> None:
        self.next_id = partition << SEQUENCE_BITS
        self.bins: dict[int, list[tuple]] = defaultdict(list)
        self.rows: list[tuple] = []
        self.with_ids = with_ids

    def close(self, pieces: list[tuple], length: int) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc, start, n, zlib.crc32(ids), total, self.next_id, offset, length, ids if self.with_ids else None))
            offset += n
        self.next_id += 1

    def add(self, doc: int | None, ids: bytes) -> None:
        total, start = len(ids) // 4, 0
        for n in cut(total):
            kind = CAPACITY // n
            bin_ = self.bins[kind]
            bin_.append((doc, start, ids[4 * start : 4 * (start + n)], total))
            start += n
            if len(bin_) == kind:
                self.close(bin_, CAPACITY)
                self.bins[kind] = []

    def finish(self) -> None:
        """Cut what is left into powers of two; as many of a size as fill a power of two are a sequence."""
        by_size: dict[int, list[tuple]] = defaultdict(list)
        for pieces in self.bins.values():
            for doc, start, ids, total in pieces:
                at = 0
                for n in halves(len(ids) // 4):
                    by_size[n].append((doc, start + at, ids[4 * at : 4 * (at + n)], total))
                    at += n
        self.bins.clear()
        for n, pieces in by_size.items():
            at = 0
            while at < len(pieces):
                count = min(CAPACITY // n, 1 << (len(pieces) - at).bit_length() - 1)
                self.close(pieces[at : at + count], n * count)
                at += count

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * len(_ARROW)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _ARROW.types)], schema=_ARROW)


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start (its document's ids before it), length, ids_crc32, doc_tokens,
    sequence_id, offset (its place there), sequence_length (with padding) and, if asked for, its ids.

    A document is the ids of its ``text`` followed by id 0; a null text is empty and is that one id.
    Other columns are ignored; a null doc_id stays null; repeated rows are packed each. Nothing is
    shuffled, and a lost task packs the same rows into the same sequences again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        packer = _Packer(TaskContext.get().partitionId(), with_ids)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(doc, encode(text.as_py()) + END_OF_TEXT)
                if len(packer.rows) >= _SEND:
                    yield packer.take()
        packer.finish()
        yield packer.take()

    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(run, SCHEMA)
