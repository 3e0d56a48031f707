"""License scans: MinHash bands over overlapping text windows retrieve templates, shingle containment verifies.

Templates are grouped by size: those of at most B shingles (B a power of two) are looked for in windows
of 2 * B shingles that start every B, so that any B successive shingles lie in one window. A window that
holds a template to the required share has a similarity to it of at least some s that follows from the
sizes; with one minimum a band, ``bands`` is chosen so that the chance of missing it in all of them is
at most MISS. Every retrieved pair is verified on the exact shingles of the window.

Words are letters and digits only: marks are taken out of texts and templates first, so that comment
signs, quotes and full stops neither make words nor change them. Templates of fewer than SHORT words have
shorter shingles, and a match must hold those with a digit, so that one version is not taken for another.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.hashing import runs, shingle_sets, windows, word_hashes

SHINGLE = 5
#: Templates of fewer than SHORT words have shingles of SHORT_SHINGLE.
SHORT = 10
SHORT_SHINGLE = 3
#: What belongs to no word and does not end one.
MARKS = r"[^\p{L}\p{M}\p{N}\x09-\x0D\x20]+"
#: A match holds at least so many hundredths of the template's shingles.
PERCENT = 75
MISS = 1e-4
#: Templates ship with every task, so their number is bounded.
MOST_TEMPLATES = 2000

# Short notices and opening passages of public licenses, by identifier; a parameter of scan().
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at"
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:"
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

_RANDOM = np.random.Generator(np.random.PCG64(23))
_TIMES = _RANDOM.integers(1, 2**63, 256, np.uint64) | np.uint64(1)
#: Shingles whose minima are taken at a time.
_BLOCK = 1 << 15


def _need(size: int) -> int:
    return -(-size * PERCENT // 100)


def bands(sizes: list[int], block: int) -> int:
    """Bands that find templates of these sizes in windows of 2 * block shingles but for a chance of MISS."""
    least = min(_need(m) / (2 * block + m - _need(m)) for m in sizes)
    return min(len(_TIMES), max(1, int(np.ceil(np.log(MISS) / np.log1p(-least))))) if least < 1 else 1


class Group(NamedTuple):
    """Templates that are looked for in windows of one size."""

    size: int  # words of a shingle
    block: int
    names: list[str]
    sets: list[np.ndarray]
    musts: list[np.ndarray]  # shingles that a match cannot lack
    minima: np.ndarray  # a row per template, a column per band


def groups(templates: dict[str, str]) -> list[Group]:
    """Templates without words match nothing and are left out."""
    if len(templates) > MOST_TEMPLATES:
        raise ValueError(f"{len(templates)} templates; at most {MOST_TEMPLATES} can be sent to every task")
    plain = dict(zip(templates, plain_words(pa.array(list(templates.values()), pa.string())).to_pylist()))
    sets: dict[str, np.ndarray] = {}
    musts: dict[str, np.ndarray] = {}
    by_kind: dict[tuple[int, int], list[str]] = {}
    for name, text in plain.items():
        words = text.split()
        if not words:
            continue
        size = SHINGLE if len(words) >= SHORT else min(SHORT_SHINGLE, len(words))
        (sets[name],) = shingle_sets(pa.array([text]), size)
        spans = [" ".join(words[k : k + size]) for k in range(len(words) - size + 1)] if len(words) < SHORT else []
        digits = pa.array([t for t in spans if any(c.isdigit() for c in t)], pa.string())
        musts[name] = np.unique(np.concatenate([sets[name][:0], *shingle_sets(digits, size)]))
        by_kind.setdefault((size, 1 << (len(sets[name]) - 1).bit_length()), []).append(name)
    out = []
    for (size, block), names in sorted(by_kind.items()):
        many = bands([len(sets[n]) for n in names], block)
        least = np.array([(sets[n][:, None] * _TIMES[:many]).min(axis=0) for n in names])
        out.append(Group(size, block, names, [sets[n] for n in names], [musts[n] for n in names], least))
    return out


def plain_words(column: pa.Array) -> pa.Array:
    """Texts without marks; what is left of a word that holds some is one word."""
    return pc.replace_substring_regex(column, MARKS, "")


def _shingles(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A run's shingles of ``size`` words in order, row after row, and the rows' offsets among them."""
    every = windows(words, size)
    parts = [every[lo : max(lo, hi - size + 1)] for lo, hi in zip(rows[:-1], rows[1:])]
    return np.concatenate([words[:0], *parts]), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


def _retrieved(shingles: np.ndarray, rows: np.ndarray, group: Group) -> Iterator[tuple[int, int, int, int]]:
    """(row, start, end, template) of windows that share a band with a template."""
    counts = -(-np.diff(rows) // group.block)
    first = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(rows[:-1], counts) + group.block * (np.arange(first[-1]) - np.repeat(first[:-1], counts))
    row = np.repeat(np.arange(len(counts)), counts)
    ends = np.minimum(starts + 2 * group.block, rows[1:][row])
    many = group.minima.shape[1]
    step = max(1, _BLOCK // group.block)
    for k in range(0, len(starts), step):
        last = min(k + step, len(starts))
        upto = starts[last] + group.block if last < len(starts) else len(shingles)  # one block more, for the last window
        lo, inner = starts[k], starts[k : min(last + 1, len(starts))]
        met = np.zeros((last - k, len(group.names)), bool)
        part = shingles[lo:upto]
        two = np.append(row[k + 1 : last], row[last] if last < len(starts) else -1) == row[k:last]
        for b in range(many):
            least = np.minimum.reduceat(part * _TIMES[b], inner - lo)
            own = least[: last - k].copy()
            nxt = least[1 : last - k + 1]
            own[: len(nxt)] = np.where(two[: len(nxt)], np.minimum(own[: len(nxt)], nxt), own[: len(nxt)])
            for t in range(len(group.names)):
                met[:, t] |= own == group.minima[t, b]
        for i, t in zip(*np.nonzero(met)):
            yield int(row[k + i]), int(starts[k + i]), int(ends[k + i]), int(t)


def _scan(batches: Iterator[pa.RecordBatch], kinds: list[Group]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, found = batch.column("doc_id").to_pylist(), []
        for first, _, data, offsets in runs(plain_words(batch.column("text"))):
            words, at_word = word_hashes(data, offsets)
            best: dict[tuple[int, str], tuple[int, int, int]] = {}
            for size, alike in groupby(kinds, lambda group: group.size):
                shingles, rows = _shingles(words, at_word, size)
                for group in alike:
                    for row, start, end, t in _retrieved(shingles, rows, group):
                        at = np.flatnonzero(np.isin(shingles[start:end], group.sets[t]))
                        there, whole = np.unique(shingles[start:end][at]), len(group.sets[t])
                        if len(there) * 100 >= whole * PERCENT and np.isin(group.musts[t], there).all():
                            key, place = (row, group.names[t]), start + int(at[0]) - int(rows[row])
                            best[key] = max(best.get(key, (0, 0, 0)), (len(there), -place, whole))
            found += [(ids[first + row], name, held / size, -place) for (row, name), (held, place, size) in sorted(best.items())]
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.float64(), pa.int64()))],
            ["doc_id", "license", "containment", "first_word"],
        )


def scan(docs: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """doc_id, license, containment (share of the template's shingles in one window, 0.75 or more) and
    first_word (where the best window's first shingle of the template starts, in words) for every license
    found in a row of ``docs``.

    Whole texts are scanned, case and marks aside; words are counted as in plain_words(). A template of fewer
    than SHORT_SHINGLE words is one shingle of all its words. Null and empty texts hold no license; a null doc_id stays null; repeated rows report
    each; other columns are ignored. Nothing is shuffled.
    """
    kinds = groups(TEMPLATES if templates is None else templates)
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(
        lambda batches: _scan(batches, kinds), "doc_id bigint, license string, containment double, first_word bigint"
    )
