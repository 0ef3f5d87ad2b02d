"""Operator 12 - conversation structure repair by a dynamic programme with square-root checkpoints.

A conversation's role initials should read ``(s?(ua)+)?``.  Edits go through its rows in order:
Keep (0), Rerole to user or assistant (3), Delete (4), Insert an empty user or assistant turn
anywhere (3).  Blank and repeated rows must go; a row cut short that stays adds 3.  Of all
cheapest edits the one whose initials are least in ASCII (D < I < K < R) is taken.

The state is what the repaired turns end with.  Backward, ``v[i][state]`` is the least cost of
rows i to n.  Only every sqrt(n)-th vector is kept; walking forward, a block's vectors are made
again from the checkpoint after it, and at each step the least edit that is tight (its cost plus
the vector after it equals the vector before it) is taken.  The state after a row decides the
next role, so equal initials mean equal repairs.

The rows of a conversation pass through one task twice, in one sorted stream: first as codes of
one byte (role class and fault), on which the backward pass runs, then with their texts, which
the forward walk edits at once.  So a task holds n bytes and sqrt(n) vectors of a conversation
and never its texts.  There is one shuffle, by conversation: copies are found by a window over
the same partitioning, and sorts and windows spill.

Defined results: nulls in role and text are one space (so a blank row); a null ``conv_id`` is a
conversation like others; null turns come first, outside the count of gaps; rows with equal
turns go by the digest of role and text, so the same rows always give the same repair; repeated
rows are duplicates; an empty table gives no rows.  Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stream

#: ASCII white space: space, tab to carriage return.
WHITE = " \t\n\x0b\x0c\r"
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: What the repaired turns end with.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Role classes are 0 system, 1 user, 2 assistant, 3 other: the state after keeping one, or -1.
_KEEP = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
#: The state after a turn rerolled or inserted: a user turn, or after one an assistant turn.
_TURN = (USER, USER, ASSISTANT, USER)
_NAME = {USER: "user", ASSISTANT: "assistant"}
_LEGAL = {(0, 1), (1, 2), (2, 1)}
REROLE = INSERT = CUT = 3
DELETE = 4
#: A batch of edits goes on when it holds so many characters.
BATCH_CHARS = 4_000_000

EDIT = ("conv_id long, step long, edit string, role string, text string, gaps long, blank long, "
        "duplicate long, truncated long, illegal long, cost long")
REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _with_inserts(v: list) -> tuple:
    e, s, u, a = v
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return min(e, INSERT + u), min(s, INSERT + u), u, a


LAST = _with_inserts([0, inf, inf, 0])


def before(v: tuple, code: int) -> tuple:
    """The vector before a row, from the one after it."""
    fault, kind = divmod(code, 4)
    if fault in (BLANK, DUPLICATE):
        return tuple(DELETE + c for c in v)  # closed under inserts, as v is
    cut = CUT if fault == TRUNCATED else 0
    out = []
    for state in range(4):
        c = min(DELETE + v[state], cut + REROLE + v[_TURN[state]])
        kept = _KEEP[state][kind]
        out.append(min(c, cut + v[kept]) if kept >= 0 else c)
    return _with_inserts(out)


class Walk:
    """The cheapest, ASCII-least edits of rows with these codes, asked for row by row."""

    def __init__(self, codes: bytes):
        self.codes = codes
        self.block = max(1, isqrt(len(codes)))
        self.kept = {}
        v = LAST
        for i in range(len(codes), 0, -1):
            if i % self.block == 0:
                self.kept[i] = v
            v = before(v, codes[i - 1])
        self.at, self.state, self.cost = 0, EMPTY, v[EMPTY]
        self.first, self.vectors = 0, []
        self._load()

    def _load(self) -> None:
        """The vectors of the block that starts here, with the one after it."""
        stop = min(self.at + self.block, len(self.codes))
        v = self.kept.get(stop, LAST)
        vectors = [v]
        for i in range(stop, self.at, -1):
            v = before(v, self.codes[i - 1])
            vectors.append(v)
        self.first, self.vectors = self.at, vectors[::-1]

    def row(self) -> Iterator[tuple[str, str | None]]:
        """(initial, role) of the inserts before the next row and of its own edit; the role is
        None for kept and deleted rows."""
        i = self.at - self.first
        here, after = self.vectors[i], self.vectors[i + 1]
        fault, kind = divmod(self.codes[self.at], 4)
        cut = CUT if fault == TRUNCATED else 0
        while True:
            left, turn = here[self.state], _TURN[self.state]
            if DELETE + after[self.state] == left:
                edit = "D", None
            elif INSERT + here[turn] == left:
                self.state = turn
                yield "I", _NAME[turn]
                continue
            elif (kept := _KEEP[self.state][kind]) >= 0 and cut + after[kept] == left:
                self.state = kept
                edit = "K", None
            else:
                self.state = turn
                edit = "R", _NAME[turn]
            break
        self.at += 1
        if self.at - self.first == self.block and self.at < len(self.codes):
            self._load()
        yield edit

    def end(self) -> Iterator[tuple[str, str]]:
        """The inserts after the last row."""
        while self.state not in (EMPTY, ASSISTANT):
            self.state = _TURN[self.state]
            yield "I", _NAME[self.state]


class _Edit:
    """Edits of the conversations that a task's sorted rows hold."""

    def __init__(self):
        self.conv: object = self  # equal to no id
        self.walk: Walk | None = None
        self.rows: list[tuple] = []
        self.chars = 0

    def open(self, conv) -> None:
        self.close()
        self.conv, self.walk = conv, None
        self.codes, self.step = bytearray(), 0
        self.turns, self.low, self.high = 0, None, None

    def close(self) -> None:
        """The inserts after the last row; a conversation of no row has its counts only."""
        if self.conv is self:
            return
        self.start_walk()
        for edit, role in self.walk.end():
            self.emit(edit, role, "")

    def start_walk(self) -> None:
        if self.walk is not None:
            return
        self.walk = Walk(bytes(self.codes))
        faults = [0] * 4
        illegal, last = 0, None
        for code in self.codes:
            fault, kind = divmod(code, 4)
            faults[fault] += 1
            illegal += last is not None and (last, kind) not in _LEGAL
            last = kind
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        self.rows.append((self.conv, None, None, None, None, gaps, *faults[1:], illegal, self.walk.cost))

    def emit(self, edit: str, role: str | None, text: str | None) -> None:
        self.rows.append((self.conv, self.step, edit, role, text, *[None] * 6))
        self.step += 1
        self.chars += len(text or "") + 100

    def out(self) -> dict:
        cols = dict(zip((p.split()[0] for p in EDIT.split(", ")), zip(*self.rows)))
        self.rows, self.chars = [], 0
        return cols

    def batch(self, batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("conv_id", "second", "turn", "code", "role", "text")
        for conv, second, turn, code, role, text in zip(*(batch.column(n).to_pylist() for n in names)):
            if conv != self.conv:
                self.open(conv)
            if code is None:  # all rows of the conversation may be gone
                continue
            if not second:
                self.codes.append(code)
                if turn is not None and turn != self.high:
                    self.turns += 1
                    self.low = turn if self.low is None else self.low
                    self.high = turn
                continue
            self.start_walk()
            for edit, new in self.walk.row():
                if edit == "I":
                    self.emit(edit, new, "")
                else:
                    self.emit(edit, new or role, None if edit == "D" else text)
            if self.chars > BATCH_CHARS:
                yield self.out()
        if self.rows:
            yield self.out()

    def rest(self) -> Iterator[dict]:
        self.close()
        if self.rows:
            yield self.out()


class _Report:
    """Digests of the conversations that a task's edits, in order, hold."""

    def __init__(self):
        self.conv = None
        self.rows: list[tuple] = []

    def close(self) -> None:
        if self.conv is not None:
            self.rows.append((*self.conv, "".join(self.audit), self.hash.hexdigest()))

    def out(self) -> dict:
        cols = dict(zip((p.split()[0] for p in REPORT.split(", ")), zip(*self.rows)))
        self.rows = []
        return cols

    def batch(self, batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("conv_id", "step", "edit", "role", "text", *_COUNTS)
        for conv, step, edit, role, text, *counts in zip(*(batch.column(n).to_pylist() for n in names)):
            if step is None:
                self.close()
                self.conv = conv, *counts
                self.audit, self.hash, self.turns = [], hashlib.sha256(), 0
                continue
            self.audit.append(edit)
            if edit != "D":
                self.hash.update(("\n" if self.turns else "").encode() + f"{role}:{text}".encode())
                self.turns += 1
        if self.rows:
            yield self.out()

    def rest(self) -> Iterator[dict]:
        self.close()
        if self.rows:
            yield self.out()


def _or_space(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: rows damaged by crc32 of ``conv_id:turn`` modulo 20 (0 gone,
    1 empty, 2 without ``.!?``, 3 twice, 4 by the user).  Rows that are gone stay, marked so, to
    name their conversation."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _or_space("role").alias("role"), _or_space("text").alias("text"),
        (F.crc32(F.concat(_or_space("conv_id"), F.lit(":"), _or_space("turn")).cast("binary")) % 20).alias("fate"))
    fate = F.col("fate")
    return rows.select(
        "conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (fate == 0).alias("gone"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def edits(rows: DataFrame) -> DataFrame:
    """The edits of each conversation of (conv_id, turn, role, text, and gone: true for rows that
    only name their conversation), in order within a partition: a row without ``step`` with its
    counts and cost, then one row an edit with the turn it leaves (text null if deleted)."""
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       _or_space("role").alias("role"), _or_space("text").alias("text"),
                       F.coalesce(F.col("gone"), F.lit(False)).alias("gone"))
    rows = rows.repartition("conv_id").withColumn("same", F.unhex(F.sha2(
        F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))
    nth = F.row_number().over(Window.partitionBy("conv_id", "gone", "same").orderBy("turn"))
    body = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(body == "", BLANK).when(nth > 1, DUPLICATE)
             .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(NONE))
    first = F.left("role", F.lit(1))
    kind = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    rows = rows.withColumn("code", F.when(~F.col("gone"), (fault * 4 + kind).cast("byte")))
    twice = F.explode(F.when(F.col("gone"), F.array(F.lit(False)))
                      .otherwise(F.array(F.lit(False), F.lit(True)))).alias("second")
    rows = rows.select("conv_id", "turn", "same", "code", "role", "text", twice)
    rows = rows.select("conv_id", "second", "turn", "same", "code",
                       *[F.when(F.col("second"), F.col(c)).alias(c) for c in ("role", "text")])
    rows = rows.sortWithinPartitions("conv_id", "second", "turn", "same").drop("same")
    return stream(rows, EDIT, _Edit)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired turns: conv_id, step, role, text."""
    return edits(rows).where("edit <> 'D'").select("conv_id", "step", "role", "text")


def report(conversations: DataFrame) -> DataFrame:
    """Damages the table, repairs it and tells per conversation what was found and done."""
    return stream(edits(damage(conversations)), REPORT, _Report)
