"""Conversations as training text whose turns can be read back exactly.

A turn is rendered as ``<s>[INST] role`` or ``<s>[TURN] role``, a line break, the text and
``</s>``. Each rendered turn is parsed again by the same small grammar; if the parser does not
recover the turn, its strings are escaped one step further until it does. The mark of the
turn says how far: plain, or escaped. Escaping puts ``\\x1a`` behind the first character of every
control string and doubles ``\\x1a`` itself, so it can be undone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Strings that may not stand in a text as they are.
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "[/TURN]", "<<SYS>>", "<</SYS>>", "<unk>", "<|")
#: How a turn opens, ends its role and closes; escaped turns carry the second opening.
OPEN, OPEN_ESCAPED, BREAK, CLOSE = "<s>[TURN] ", "<s>[INST] ", "\n", "</s>"
ESCAPE = "\x1a"
#: The role whose text is learned from.
LEARNED = "assistant"


class Turn(NamedTuple):
    role: str
    text: str


def escape(text: str, line: bool = False) -> str:
    """Control strings, and with ``line`` line breaks, made harmless; undone by ``unescape``."""
    out = text.replace(ESCAPE, ESCAPE + ESCAPE)
    for string in CONTROL:
        out = out.replace(string, string[0] + ESCAPE + "-" + string[1:])
    return out.replace(BREAK, ESCAPE + "n") if line else out


def unescape(text: str) -> str:
    parts, at = [], text.find(ESCAPE)
    begin = 0
    while at >= 0:
        kind = text[at + 1 : at + 2]
        parts += [text[begin:at], {"-": "", "n": BREAK, ESCAPE: ESCAPE}[kind]]
        begin = at + 2
        at = text.find(ESCAPE, begin)
    return "".join([*parts, text[begin:]])


def _write(turn: Turn, escaped: bool) -> str:
    if escaped:
        return OPEN_ESCAPED + escape(turn.role, line=True) + BREAK + escape(turn.text) + CLOSE
    return OPEN + turn.role + BREAK + turn.text + CLOSE


class Found(NamedTuple):
    """A parsed turn, where its text stands in the output, and whether it is escaped there."""

    turn: Turn
    begin: int
    end: int
    escaped: bool


def parse(rendered: str) -> list[Found]:
    """The turns of a rendered text.

    The grammar has one reading: a turn ends at the first ``</s>``, its role at the first
    line break. Anything else is an error.
    """
    found, at = [], 0
    while at < len(rendered):
        escaped = rendered.startswith(OPEN_ESCAPED, at)
        if not escaped and not rendered.startswith(OPEN, at):
            raise ValueError(f"no turn opens at {at}")
        begin = at + len(OPEN)
        close = rendered.find(CLOSE, begin)
        line = rendered.find(BREAK, begin)
        if close < 0 or not begin <= line < close:
            raise ValueError(f"the turn at {at} does not end")
        role, text = rendered[begin:line], rendered[line + 1 : close]
        if any(string in role or string in text for string in CONTROL):
            raise ValueError(f"a control string inside the turn at {at}")
        turn = Turn(unescape(role), unescape(text)) if escaped else Turn(role, text)
        found.append(Found(turn, line + 1, close, escaped))
        at = close + len(CLOSE)
    return found


def render(turn: Turn) -> str:
    """The turn as text that parses to the same turn, escaped only where it has to be."""
    for escaped in (False, True):
        written = _write(turn, escaped)
        try:
            if [found.turn for found in parse(written)] == [turn]:
                return written
        except ValueError:
            continue
    raise ValueError("the grammar cannot carry this turn")


def _render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        written = [render(Turn(role or "", text or "")) for role, text in pairs]
        columns = [batch.column(0), batch.column(1), pa.array(written, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "turn", "formatted"])


def formatted(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, formatted), a row for each turn; a conversation is its rows in turn order.

    Null roles and texts are empty; other columns are ignored.
    """
    return conversations.select("conv_id", "turn", "role", "text").mapInArrow(
        _render, "conv_id long, turn long, formatted string"
    )


class _Reading:
    """Digests of one conversation, taken in turn by turn."""

    def __init__(self) -> None:
        self.turns, self.chars, self.learned = 0, 0, 0
        self.all, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, rendered: str) -> None:
        for turn, begin, end, escaped in parse(rendered):
            self.turns += 1
            self.all.update(f"{turn.role}\n{turn.text}\n".encode())
            if turn.role == LEARNED:
                # the loss mask covers the text as written
                plain = unescape(rendered[begin:end]) if escaped else rendered[begin:end]
                self.learned += len(plain)
                self.loss.update(plain.encode())
        self.chars += len(rendered)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and turn; one conversation's digests are held at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    at, reading = None, None

    def done(rows: list) -> pa.RecordBatch:
        columns = zip(*rows) if rows else [[] for _ in names]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def row() -> tuple:
        r = reading
        return at[0], r.turns, r.all.hexdigest(), r.learned, r.loss.hexdigest(), r.chars

    for batch in batches:
        rows = []
        for conv, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if at is None or at[0] != conv:
                if at is not None:
                    rows.append(row())
                at, reading = (conv,), _Reading()
            reading.add(text)
        yield done(rows)
    if at is not None:
        yield done([row()])


def read_back(rendered: DataFrame) -> DataFrame:
    """What the parser finds in the formatted conversations: a row for each.

    Rendering and the round trip are done per turn, wherever the rows lie. Only the digests
    need a conversation in order: its turns stream through one task, which holds one turn and two
    hash states, however long the conversation. Turns with equal numbers are ordered by what they say; a
    null number comes first, and a null conv_id is a conversation. No rows give no rows.
    """
    return (
        rendered.repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "formatted")
        .select("conv_id", "formatted")
        .mapInArrow(
            _read,
            "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
        )
    )
