"""Chat formatting into budgeted, turn-aligned windows with a loss mask.

A turn is written ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside a text or role
are escaped reversibly: ``<``, any backslashes, ``|`` gets one more backslash, so ``<|`` appears in
the output only where the template put it.

Prefix sums of the turns' tokens choose the spans: a window takes the next turns as long as the
sum up to the turn, less the sum up to the window's first new turn, fits what the budget leaves
beside the system turn and the history. The system turn (a first turn of that role) is kept in
every window; of the turns before the span the last ones that fit HISTORY tokens are repeated as
context. Loss falls on the texts of assistant turns that are new in their window, so a repeated
target is masked and each counts once. A turn above the budget is a window of its own, whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.tokens import VOCABULARY, encoder

START, END = "<|im_start|>", "<|im_end|>"
SYSTEM, TARGET = "system", "assistant"
BUDGET = 1024
HISTORY = 256

SCHEMA = (
    "conv_id bigint, window bigint, text string, loss array<struct<start:bigint,end:bigint>>, "
    "first_turn bigint, n_turns bigint, n_repeated bigint, n_tokens bigint, over_budget boolean"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_ARROW = pa.schema([
    ("conv_id", pa.int64()), ("window", pa.int64()), ("text", pa.string()), ("loss", pa.list_(_SPAN)),
    ("first_turn", pa.int64()), ("n_turns", pa.int64()), ("n_repeated", pa.int64()), ("n_tokens", pa.int64()),
    ("over_budget", pa.bool_()),
])
_OPENS = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + r"([^\n]*)\n(.*?)" + re.escape(END) + "\n", re.DOTALL)


def escape(text: str) -> str:
    return _OPENS.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role is one line, so its line breaks are escaped too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


class Turn(NamedTuple):
    role: str
    before: str  # up to the text
    text: str  # escaped
    tokens: int

    @property
    def written(self) -> str:
        return f"{self.before}{self.text}{END}\n"


class _Conversation:
    """Cuts one conversation into windows, holding only the open window and the history."""

    def __init__(self, conv_id: int | None, budget: int, history: int) -> None:
        self.conv_id, self.budget, self.history_most = conv_id, budget, history
        self.system: list[Turn] = []
        self.context: list[Turn] = []  # turns before the open window that it repeats
        self.new: list[Turn] = []
        self.first = self.window = self.seen = 0
        self.sum = self.sum_at_first = 0  # tokens of all turns so far, and of those before the window's new ones

    def add(self, turn: Turn) -> Iterator[tuple]:
        room = self.budget - sum(t.tokens for t in (*self.system, *self.context) if self.window)
        if self.new and self.sum + turn.tokens - self.sum_at_first > room:
            yield self.close()
        if not self.new and self.window:
            while self.context and sum(t.tokens for t in (*self.system, *self.context, turn)) > self.budget:
                self.context.pop(0)  # the new turn matters more than history
        self.new.append(turn)
        self.sum += turn.tokens
        if not self.seen and turn.role == SYSTEM:
            self.system = [turn]
        self.seen += 1

    def close(self) -> tuple:
        repeated = [*self.system, *self.context] if self.window else []
        parts, loss, at = [], [], 0
        for k, turn in enumerate([*repeated, *self.new]):
            if k >= len(repeated) and turn.role == TARGET and turn.text:
                start = at + len(turn.before)
                loss.append({"start": start, "end": start + len(turn.text)})
            parts.append(turn.written)
            at += len(parts[-1])
        tokens = sum(t.tokens for t in (*repeated, *self.new))
        row = (self.conv_id, self.window, "".join(parts), loss, self.first, len(self.new), len(repeated), tokens, tokens > self.budget)
        past = self.context + self.new
        if self.system and not self.window:
            past = past[1:]  # it is kept as such
        self.context, left = [], self.history_most
        for turn in reversed(past):
            if turn.tokens > left:
                break
            left -= turn.tokens
            self.context.insert(0, turn)
        self.first, self.new, self.sum_at_first = self.seen, [], self.sum
        self.window += 1
        return row


def _ordered(conversations: DataFrame) -> DataFrame:
    """Turns of a conversation together and in order; equal turns by role and text."""
    plain = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return plain.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per window: text, loss (code-point spans under the loss mask, in escaped text), first_turn
    (turns of the conversation before its new ones), n_turns (new), n_repeated (before the new ones, the
    system turn included), n_tokens and over_budget.

    ``conversations`` has conv_id, turn, role, text; null roles and texts count as empty, rows without
    conv_id are one conversation, repeated rows are turns of their own, null turns come first and other
    columns are ignored. Turns stream in order, so a conversation of any length needs the memory of one
    window; the windows of a conversation are together and in order within a partition.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        open_: _Conversation | None = None
        for batch in batches:
            rows: list[tuple] = []
            for conv, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text"))):
                if open_ is None or open_.conv_id != conv:
                    if open_ is not None:
                        rows.append(open_.close())
                    open_ = _Conversation(conv, budget, history)
                before, body = f"{START}{escape_role(role)}\n", escape(text)
                tokens = len(encode(f"{before}{body}{END}\n")) // 4
                rows.extend(open_.add(Turn(role, before, body, tokens)))
            if rows:
                yield _batch(rows)
        if open_ is not None:
            yield _batch([open_.close()])

    return _ordered(conversations).mapInArrow(run, SCHEMA)


def turns_of(text: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a formatted window, unescaped."""
    for match in _TURN.finditer(text):
        yield unescape_role(match[1]), unescape(match[2])
