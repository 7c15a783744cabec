r"""Repair of conversation structure by a run-length min-plus programme.

A conversation is well formed if its role initials read ``(s?(ua)+)?``.  Edits of a row: Keep (0), Rerole to user or
assistant (2), Delete (3); Insert an empty user or assistant turn anywhere (2).  Blank and duplicate rows must go, a
truncated row that stays costs 1 more.  The cheapest edits win; of equally cheap ones, the least audit string in ASCII.

Grammar states: nothing yet, after the system turn, after a user turn, after an assistant turn.  A row is one of a few
symbols (initial x fault), and what it costs to pass it from state to state is a 4 x 4 matrix under (min, +).  Equal
consecutive symbols form a run; its matrix power is taken by binary digits from cached powers, so the costs to go are
carried from the end over run boundaries only.  The audit is then unrolled from the start: in every state a letter leads
to one state, so the least letter that keeps the cost is the least audit.  Unrolled blocks of 2^k rows are cached too.

The rows are numbered, and first occurrences found, by DataFrame operations on narrow rows; the programme streams over
them and holds, of one conversation at a time, one symbol per row and one letter per edit (the audit is one value of the
result).  Texts are then streamed beside the audit, one row at a time.

Defined results: null role, text and, in the damage, turn or id count as one space; a null id is a conversation of its
own; rows of one turn come in the order of role and text; rows whose turn is null come first; a role that begins with no
s, u or a, the empty one too, is never well placed; repeated rows are duplicates; an empty table gives no rows; other
columns are ignored.  Texts and conversations may be of any length.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civic_spark.llm.shared import parquet

SPACE = "\t\n\x0b\x0c\r "
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
FULL_ROLE = {"u": "user", "a": "assistant"}
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where an initial leads from a state; other initials lead nowhere.
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The only role that a rerole or insertion can give in a state.
FORCED = ("u", "u", "a", "u")
#: Cost to end in a state: turns still to be inserted.
FINISH = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60

#: Faults in the order in which they count.
FINE, BLANK, DUPLICATE, CUT = range(4)
INITIALS = "suao"


def symbol(initial: str, fault: int) -> int:
    """Rows that must go are one symbol (0); others are initial x truncated."""
    if fault in (BLANK, DUPLICATE):
        return 0
    return 1 + 2 * INITIALS.find(initial if initial in ("s", "u", "a") else "o") + (fault == CUT)


def row_edits(sym: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of one row in ``state``, by letter."""
    out = [("D", DELETE, state)]
    if sym:
        initial, extra = INITIALS[(sym - 1) // 2], TRUNCATED * ((sym - 1) % 2)
        if initial in NEXT[state]:
            out.append(("K", KEEP + extra, NEXT[state][initial]))
        out.append(("R", REROLE + extra, NEXT[state][FORCED[state]]))
    return out


@lru_cache(maxsize=None)
def power(sym: int, k: int) -> tuple[tuple[int, ...], ...]:
    """Costs from state to state over 2^k rows of one symbol, insertions before rows included."""
    if k:
        half = power(sym, k - 1)
        return tuple(tuple(min(half[p][m] + half[m][q] for m in range(4)) for q in range(4)) for p in range(4))
    rows = []
    for state in range(4):
        best, at = [FAR] * 4, state
        for inserted in range(4):
            for _, cost, after in row_edits(sym, at):
                best[after] = min(best[after], INSERT * inserted + cost)
            at = NEXT[at][FORCED[at]]
        rows.append(tuple(best))
    return tuple(rows)


def before(sym: int, k: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go ahead of 2^k rows, from those behind them."""
    return tuple(min(a + b for a, b in zip(row, after, strict=True)) for row in power(sym, k))


def _level(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


@lru_cache(maxsize=1 << 14)
def unroll(sym: int, k: int, state: int, after: tuple[int, ...]) -> tuple[str, int]:
    """(letters, state behind) of the least cheapest edits of 2^k equal rows; ``after`` counts from its least cost."""
    if k:
        first, state = unroll(sym, k - 1, state, _level(before(sym, k - 1, after)))
        second, state = unroll(sym, k - 1, state, after)
        return first + second, state
    here, letters = before(sym, 0, after), ""
    while True:
        moves = [(letter, cost + after[q], q) for letter, cost, q in row_edits(sym, state)]
        inserted = NEXT[state][FORCED[state]]
        moves.append(("I", INSERT + here[inserted], inserted))
        letter, _, state = min(m for m in moves if m[1] == here[state])
        letters += letter
        if letter != "I":
            return letters, state


def _blocks(length: int) -> list[int]:
    return [k for k in range(length.bit_length()) if length >> k & 1]


def cheapest(symbols: bytes) -> tuple[int, str]:
    """(cost, audit) of a conversation given by its rows' symbols."""
    runs, lengths = bytearray(), array("q")
    for s in symbols:
        if runs and runs[-1] == s:
            lengths[-1] += 1
        else:
            runs.append(s)
            lengths.append(1)
    behind, base = array("b"), 0  # costs to go behind every run, last run first, from their least
    costs = FINISH
    for s, n in zip(reversed(runs), reversed(lengths), strict=True):
        behind.extend(costs)
        for k in _blocks(n):
            costs = before(s, k, costs)
        base, costs = base + min(costs), _level(costs)
    total, state, audit = base + costs[START], START, []
    for r, (s, n) in enumerate(zip(runs, lengths, strict=True)):
        at = 4 * (len(runs) - 1 - r)
        ends, after = [], tuple(behind[at:at + 4])
        for k in _blocks(n):
            ends.append((k, after))
            after = _level(before(s, k, after))
        for k, after in reversed(ends):
            letters, state = unroll(s, k, state, after)
            audit.append(letters)
    audit.append("I" * (FINISH[state] // INSERT))
    return total, "".join(audit)


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows harmed by a hash of id and turn; a dropped row stays, marked ``gone``."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    hit = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(F.col("__hit") == 1, "").when(F.col("__hit") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(F.col("__hit") == 4, "user").otherwise(said("role"))
    return (rows.select("conv_id", "turn", "role", "text").withColumn("__hit", hit)
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                    (F.col("__hit") == 0).alias("gone"), F.explode(F.sequence(F.lit(1), F.when(F.col("__hit") == 3, 2).otherwise(1))).alias("__copy"))
            .drop("__copy"))


def _faults(rows: DataFrame) -> DataFrame:
    """(conv_id, n, turn, initial, fault, gone): every row's number in its conversation and first fault."""
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACE)), -1, 1)
    order = "conv_id", F.asc_nulls_first("turn"), "role", "text"
    narrow = parquet(rows.repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", "turn", F.substring("role", 1, 1).alias("initial"), "gone", (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"), F.sha2(F.concat("role", F.lit("\n"), "text").cast("binary"), 256).alias("said"))
        .mapInArrow(_numbered, NUMBERED))
    # n rises with the place in the conversation, so the least n of equal rows is the first of them
    first = (narrow.where("not gone and not blank").groupBy("conv_id", "said").agg(F.min("n").alias("n"))
             .select(F.col("conv_id").alias("c"), F.col("n").alias("m"), F.lit(True).alias("first")))
    fault = (F.when(F.col("blank"), BLANK).when(F.col("first").isNull(), DUPLICATE).when(F.col("cut"), CUT).otherwise(FINE))
    return (narrow.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("n") == F.col("m")), "left")
            .select("conv_id", "n", "turn", "initial", fault.alias("fault"), "gone"))


NUMBERED = "conv_id long, turn long, initial string, gone boolean, blank boolean, cut boolean, said string, n long"


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, n = object(), 0
    for batch in batches:
        numbers = []
        for c in batch.column(0).to_pylist():
            conv, n = (c, n + 1) if c == conv else (c, 0)
            numbers.append(n)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "n"])


NUMBERS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PLANNED = f"conv_id long, {', '.join(f'{x} long' for x in NUMBERS)}, audit string"
LEGAL = {"su", "ua", "au"}


class _Conversation:
    def __init__(self, conv) -> None:
        self.conv, self.symbols, self.counts = conv, bytearray(), [0, 0, 0, 0]
        self.least = self.most = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.most:  # turns come in order
            self.least, self.most, self.turns = turn if self.least is None else self.least, turn, self.turns + 1
        self.illegal += self.last is not None and self.last + initial not in LEGAL
        self.last = initial
        self.counts[fault] += 1
        self.symbols.append(symbol(initial, fault))

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        cost, audit = cheapest(bytes(self.symbols))
        return self.conv, min(gaps, (1 << 63) - 1), *self.counts[1:], self.illegal, cost, audit


def _plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    own = None
    for batch in batches:
        done = []
        for c, turn, initial, fault, gone in zip(*(batch.column(k).to_pylist() for k in range(5)), strict=True):
            if own is None or c != own.conv:
                if own is not None:
                    done.append(own.row())
                own = _Conversation(c)
            if not gone:
                own.add(turn, initial, fault)
        yield _batch(done, PLANNED)
    if own is not None:
        yield _batch([own.row()], PLANNED)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    fields = [x.split() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)],
                                      names=[name for name, _ in fields])


def plan_repairs(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, gone): its faults, the least cost and the audit."""
    ordered = _faults(rows).repartition("conv_id").sortWithinPartitions("conv_id", "n")
    return ordered.select("conv_id", "turn", "initial", "fault", "gone").mapInArrow(_plan, PLANNED)


class _Replay:
    """Applies an audit to a conversation's rows as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, START

    def _forced(self) -> str:
        initial = FORCED[self.state]
        self.state = NEXT[self.state][initial]
        return FULL_ROLE[initial]

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            yield self._forced(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = NEXT[self.state][role[0]]
            yield role, text
        elif letter == "R":
            yield self._forced(), text


def _beside(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """Every conversation's plan row, then its rows in order, in one partition."""
    plan = plans.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                        F.col("audit").alias("text"), *NUMBERS)
    said = rows.where("not gone").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text",
                                         *(F.lit(None).cast("long").alias(x) for x in NUMBERS))
    return (plan.unionByName(said).repartition("conv_id").sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "text")
            .select("conv_id", "kind", "role", "text", *NUMBERS))


TURNS = "conv_id long, seq long, role string, text string"


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, replay, seq = None, None, 0
    for batch in batches:
        out = []
        for c, kind, role, text in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            if kind == 0:
                if replay is not None:
                    out += [(conv, *t) for t in replay.inserted()]
                conv, replay = c, _Replay(text)
                out.append(None)
            else:
                out += [(conv, *t) for t in replay.row(role, text)]
        numbered = []
        for t in out:
            seq = 0 if t is None else seq + 1
            if t is not None:
                numbered.append((t[0], seq - 1, t[1], t[2]))
        yield _batch(numbered, TURNS)
    if replay is not None:
        yield _batch([(conv, seq + k, *t) for k, t in enumerate(replay.inserted())], TURNS)


def repaired_turns(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """(conv_id, seq, role, text): the turns of every conversation after its edits."""
    return _beside(rows, plans).mapInArrow(_turns, TURNS)


DIGESTS = f"{PLANNED}, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    head, replay, sha, glue = None, None, None, ""

    def take(turns: Iterator[tuple[str, str]]) -> None:
        nonlocal glue
        for role, text in turns:
            sha.update(f"{glue}{role}:{text}".encode())
            glue = "\n"

    for batch in batches:
        done = []
        for c, kind, role, text, *numbers in zip(*(batch.column(k).to_pylist() for k in range(4 + len(NUMBERS))), strict=True):
            if kind == 0:
                if replay is not None:
                    take(replay.inserted())
                    done.append((*head, sha.hexdigest()))
                head, replay, sha, glue = (c, *numbers, text), _Replay(text), hashlib.sha256(), ""
            else:
                take(replay.row(role, text))
        yield _batch(done, DIGESTS)
    if replay is not None:
        take(replay.inserted())
        yield _batch([(*head, sha.hexdigest())], DIGESTS)


def digests(rows: DataFrame, plans: DataFrame) -> DataFrame:
    """The plan of every conversation with the hash of its repaired ``role:text`` lines."""
    return _beside(rows, plans).mapInArrow(_digests, DIGESTS)
