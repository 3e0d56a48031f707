"""Token ids by a public byte-level BPE vocabulary, as little-endian unsigned 32-bit bytes.

The vocabulary's special token has an id of its own wherever a text holds it.
"""

from __future__ import annotations

import base64
import re
from functools import cache

import numpy as np
import public_tokenizers
import tiktoken

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
#: Words whose ids a worker remembers; beyond that they are encoded each time.
REMEMBERED = 300_000

# The vocabulary's special token and its id.
SPECIAL, SPECIAL_ID = "<|endoftext|>", 50256

_TWO_WHITE = re.compile(r"\s\s")


class Encoder(dict):
    """Maps text to ids. A space before a visible character starts a token of its own, so text
    without two white-space characters in a row is encoded word by word from memory."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self._bpe = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def plain(self, text: str) -> bytes:
        return np.array(self._bpe.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.plain(" " + word)
        if len(self) < REMEMBERED:
            self[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if SPECIAL in text:
            return np.array([SPECIAL_ID], "<u4").tobytes().join(map(self.encode, text.split(SPECIAL)))
        if _TWO_WHITE.search(text):
            return self.plain(text)
        first, *words = text.split(" ")
        return self.plain(first) + b"".join(map(self.__getitem__, words))


@cache
def encoder(path: str = VOCABULARY) -> Encoder:
    """One per worker process, loaded on first use."""
    return Encoder(path)
