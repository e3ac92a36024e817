"""Conversations as training texts in turn-aligned windows of a token budget.

A turn is written ``### role: text</turn>`` and a line feed. Control strings
inside roles and texts are escaped with backslashes, so the markers are
unambiguous and the text can be read back. Running sums of the turns' tokens
choose the windows: each holds the conversation's system turn (if its first
turn is one), a limited history of whole turns from before, and as many new
turns as the budget takes. The loss mask covers the texts of new assistant
turns only; repeated turns are never targets again.

Turns are streamed in order, so a task holds one window and its history,
however long the conversation is. A turn longer than the budget is a window of
its own; nothing is cut.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabstrata.llm import bpe, textarrays

WINDOW_TOKENS, HISTORY_TOKENS = 1024, 256
_OPEN, _CLOSE = "### ", "</turn>\n"
_HEAD = re.compile(r"(?:[^\\:]|\\.)*", re.DOTALL)  # up to the first colon that isn't escaped
_WINDOWS = "conv_id long, window int, text string, n_tokens long, n_repeated int, loss_start array<int>, loss_end array<int>"


def escape(text: str) -> str:
    """No ``#``, ``</`` or ``:`` stays without a backslash in or before it, so no marker can be in the result."""
    return text.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/").replace(":", "\\:")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(role: str, text: str) -> tuple[str, int, int]:
    """The turn as written, and first and one-past-last character of its text."""
    head = f"{_OPEN}{escape(role)}: "
    body = escape(text)
    return head + body + _CLOSE, len(head), len(head) + len(body)


def parse(text: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a window."""
    turns = []
    for piece in text.split(_CLOSE)[:-1]:
        end = _HEAD.match(piece).end()
        turns.append((unescape(piece[len(_OPEN) : end]), unescape(piece[end + len(": ") :])))
    return turns


class _Conversation:
    """The window being filled and the turns that the next one may repeat."""

    def __init__(self, conv_id: int | None, budget: int, history: int):
        self.conv_id, self.budget, self.history = conv_id, budget, history
        self.system, self.total, self.number, self.seen = None, 0, 0, 0
        self.recent: deque = deque()  # (turn, tokens before it, tokens with it), as far back as history reaches
        self.repeated, self.fresh, self.from_sum = [], [], 0

    def add(self, role: str, text: str, tokens: int) -> dict | None:
        """Take the next turn; gives a window back if that one is full."""
        turn = (role, text, tokens)
        done = None
        first = self.seen == 0
        self.seen += 1
        if first and role == "system":
            self.system = turn
            self.fresh.append(turn)
            return None
        head = self.system[2] if self.system else 0
        before, after = self.total, self.total + tokens
        if self.fresh and head + after - self.from_sum > self.budget and not (self.number == 0 and self.fresh == [self.system]):
            done = self.window()
            # whole turns from before, within the history's tokens and what the budget leaves
            least = max(before - self.history, after + head - self.budget)
            kept = [r for r in self.recent if r[1] >= least]
            self.repeated = ([self.system] if self.system else []) + [r[0] for r in kept]
            self.from_sum = kept[0][1] if kept else before
        self.fresh.append(turn)
        self.recent.append((turn, before, after))
        self.total = after
        while self.recent and self.recent[0][1] < after - self.history:
            self.recent.popleft()
        return done

    def window(self) -> dict | None:
        if not self.fresh:
            return None
        text, at, starts, ends = [], 0, [], []
        for k, (role, body, _) in enumerate(self.repeated + self.fresh):
            written, a, b = render(role, body)
            if k >= len(self.repeated) and role == "assistant":
                starts.append(at + a)
                ends.append(at + b)
            text.append(written)
            at += len(written)
        row = {"conv_id": self.conv_id, "window": self.number, "text": "".join(text), "n_tokens": sum(t[2] for t in self.repeated + self.fresh), "n_repeated": len(self.repeated), "loss_start": starts, "loss_end": ends}
        self.number += 1
        self.repeated, self.fresh = [], []
        return row


_SCHEMA = pa.schema([("conv_id", pa.int64()), ("window", pa.int32()), ("text", pa.string()), ("n_tokens", pa.int64()), ("n_repeated", pa.int32()), ("loss_start", pa.list_(pa.int32())), ("loss_end", pa.list_(pa.int32()))])


def _format(ranks: str, budget: int, history: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.codec(ranks)
        current, rows, size = None, [], 0
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                turns = whole.slice(at, 256).to_pylist()
                written = pa.array([render(t["role"], t["text"])[0] for t in turns], pa.large_string())
                tokens = np.diff(coder.encode(*textarrays.buffer(written))[1])
                for t, n in zip(turns, tokens.tolist()):
                    done = []
                    if current is None or current.conv_id != t["conv_id"]:
                        done = [current.window()] if current else []
                        current = _Conversation(t["conv_id"], budget, history)
                    done.append(current.add(t["role"], t["text"], n))
                    for row in filter(None, done):
                        rows.append(row)
                        size += len(row["text"])
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
                        rows, size = [], 0
        if current and (row := current.window()):
            rows.append(row)
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)
        coder.pieces.clear()

    return run


def format_windows(turns: DataFrame, ranks: str, window_tokens: int = WINDOW_TOKENS, history_tokens: int = HISTORY_TOKENS) -> DataFrame:
    """conv_id, window, text, n_tokens, n_repeated (turns at its start that an earlier window has), loss_start, loss_end.

    ``turns`` has conv_id, turn, role, text. Turns go by ``turn`` (nulls first),
    equal ones by role and text; all repeated rows stay. Null roles and texts
    are empty; a null conv_id is a conversation. Other columns are left out.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = turns.select(F.col("conv_id").cast("long"), "turn", text("role"), text("text"))
    order = ["conv_id", "turn", "role", "text"]
    return rows.repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text").mapInArrow(_format(ranks, window_tokens, history_tokens), _WINDOWS)


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    class Sums:
        def __init__(self, conv_id):
            self.conv_id, self.turns, self.loss, self.chars = conv_id, 0, 0, 0
            self.all, self.target = hashlib.sha256(), hashlib.sha256()

        def row(self):
            return [self.conv_id, self.turns, self.all.hexdigest(), self.loss, self.target.hexdigest(), self.chars]

    current, rows = None, []
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=names)
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            for w in whole.slice(at, 64).to_pylist():
                if current is None or current.conv_id != w["conv_id"]:
                    if current:
                        rows.append(current.row())
                    current = Sums(w["conv_id"])
                for role, text in parse(w["text"])[w["n_repeated"] :]:
                    current.turns += 1
                    current.all.update(f"{role}\n{text}\n".encode())
                for a, b in zip(w["loss_start"], w["loss_end"]):
                    target = unescape(w["text"][a:b])
                    current.loss += len(target)
                    current.target.update(target.encode())
                current.chars += len(w["text"])
        if rows:
            yield batch_of(rows)
            rows = []
    if current:
        yield batch_of([current.row()])


def read_back(windows: DataFrame) -> DataFrame:
    """Per conversation: turns and target text as parsed from the windows' texts and masks, streamed in window order."""
    ordered = windows.select("conv_id", "window", "text", "n_repeated", "loss_start", "loss_end").repartition("conv_id").sortWithinPartitions("conv_id", "window")
    return ordered.mapInArrow(_read_back, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
