r"""Chat formatting with a grammar round trip.

Template of a turn: ``### Name:`` newline, body, newline, ``</turn>``, newline.  A known role has a fixed name; any
other role is written as ``@`` and its escaped text.  In a body or role a backslash makes the next character plain.

Each turn is rendered with its text as it is, reparsed by a deterministic parser, and compared with the source.  If
role and text don't come back unchanged, conflicting content is escaped (first control strings and backslashes, then
every character that isn't a letter or digit) until they do.

Rows are partitioned by conversation and sorted by turn, and stream through the formatter: memory holds one Arrow
batch, never a whole conversation, however long it is.  One conversation is one text, so one task writes it.

Defined results: a null text or role is empty; turns with the same number come in the order of role and text (nulls
first), repeated rows repeat; a null conversation id is a conversation of its own; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAMES = {"user": "User", "assistant": "Assistant", "system": "System"}
ROLES = {name: role for role, name in NAMES.items()}
HEAD, END = "### ", "</turn>"
LEARNT = "assistant"
_CONTROL = re.compile(r"\\|</turn>|#{3,}")
_TOKEN = re.compile(r"\\(.)|</turn>|###", re.S)
_PLAIN = re.compile(r"\W|_")
FORMATTED = "conv_id long, turn_no long, rendered string, loss_start long, loss_end long, level int"


def escape(text: str, level: int) -> str:
    """Level 0: unchanged; 1: backslashes and control strings; 2: everything but letters and digits."""
    if level == 0:
        return text
    if level == 1:
        return _CONTROL.sub(lambda m: "".join("\\" + c for c in m[0]) if m[0][0] == "#" else "\\" + m[0], text)
    return _PLAIN.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def render(role: str, text: str, level: int = 0) -> tuple[str, int, int]:
    """The turn, and where its body starts and ends in it."""
    name = NAMES.get(role) or "@" + escape(role, 2)
    head = f"{HEAD}{name}:\n"
    body = escape(text, level)
    return f"{head}{body}\n{END}\n", len(head), len(head) + len(body)


class GrammarError(ValueError):
    """The text does not follow the template."""


def _name_end(text: str, at: int) -> int:
    while at < len(text) and text[at] != ":":
        at += 2 if text[at] == "\\" else 1
    return at


def parse(text: str) -> list[tuple[str, str]]:
    """Turns (role, text) of a formatted text; raises GrammarError where it does not follow the template."""
    turns, at = [], 0
    while at < len(text):
        colon = _name_end(text, at + len(HEAD))
        if not text.startswith(HEAD, at) or text[colon:colon + 2] != ":\n":
            raise GrammarError(f"no turn begins at {at}")
        name = text[at + len(HEAD):colon]
        role = unescape(name[1:]) if name[:1] == "@" else ROLES.get(name)
        if role is None:
            raise GrammarError(f"unknown name at {at}")
        out, last = [], colon + 2
        for token in _TOKEN.finditer(text, last):
            plain = text[last:token.start()]
            out.append(plain)
            last = token.end()
            if token[1] is not None:
                out.append(token[1])
            elif token[0] == END:
                break
            else:
                raise GrammarError(f"control string in a body at {token.start()}")
        else:
            raise GrammarError("a turn does not end")
        if plain[-1:] != "\n" or text[last:last + 1] != "\n":
            raise GrammarError(f"a turn ends badly at {last}")
        turns.append((role, "".join(out)[:-1]))
        at = last + 1
    return turns


def round_trip(role: str, text: str) -> tuple[str, int, int, int]:
    """(turn, body start, body end, level): the least escaping under which the turn reparses to its source."""
    for level in (0, 1, 2):
        turn, start, end = render(role, text, level)
        try:
            if parse(turn) == [(role, text)]:
                return turn, start, end, level
        except GrammarError:
            pass
    raise GrammarError("the template cannot hold this turn")


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, number, offset = object(), 0, 0
    for batch in batches:
        rows = {name: [] for name in ("conv_id", "turn_no", "rendered", "loss_start", "loss_end", "level")}
        for c, role, text in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if c != conv:
                conv, number, offset = c, 0, 0
            turn, start, end, level = round_trip(role or "", text or "")
            learnt = role == LEARNT
            for name, v in zip(rows, (c, number, turn, offset + start if learnt else None, offset + end if learnt else None, level), strict=True):
                rows[name].append(v)
            number, offset = number + 1, offset + len(turn)
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds, strict=True)], names=list(rows))


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, turn_no, rendered, loss_start, loss_end, level): one row per turn.

    A conversation's formatted text is its ``rendered`` pieces in order of ``turn_no``; ``loss_start`` and ``loss_end``
    are code points of that text, set for assistant turns: the span under the loss mask.  ``level`` is the escaping.
    Rows of a conversation stay together and in order in the result's partitions.
    """
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.col("role").cast("string").alias("role"),
                      F.col("text").cast("string").alias("text"))
    sorted_rows = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.select("conv_id", "role", "text").mapInArrow(_format, FORMATTED)


DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
          "escaped_turns long")


class _Digest:
    def __init__(self, conv) -> None:
        self.conv, self.turns, self.loss = conv, hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted = self.escaped = 0

    def add(self, rendered: str, start: int | None, end: int | None, level: int) -> None:
        for role, text in parse(rendered):
            self.turns.update(f"{role}\n{text}\n".encode())
            self.n_turns += 1
        if start is not None:
            learnt = unescape(rendered[start - self.formatted:end - self.formatted])
            self.loss.update(learnt.encode())
            self.loss_chars += len(learnt)
        self.formatted += len(rendered)
        self.escaped += level > 0

    def row(self) -> tuple:
        return (self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted, self.escaped)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    names = [x.split()[0] for x in DIGEST.split(", ")]

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(len(kinds))], names=names)

    own = None
    for batch in batches:
        done = []
        for c, _, rendered, start, end, level in zip(*(batch.column(k).to_pylist() for k in range(6)), strict=True):
            if own is None or c != own.conv:
                if own is not None:
                    done.append(own.row())
                own = _Digest(c)
            own.add(rendered, start, end, level)
        yield table(done)
    if own is not None:
        yield table([own.row()])


def digests(formatted: DataFrame) -> DataFrame:
    """One row per conversation, read back from ``format_conversations``: parsed turns, text under the loss mask."""
    return formatted.mapInArrow(_digest, DIGEST)
