"""Operator 13 - chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns up to it, formatted, with only that
reply's text trainable (code points ``loss_start`` to ``loss_end``).  Turns after a conversation's
last assistant turn, or a conversation without one, end in a further example without a loss span,
so that the output holds every turn.

A turn is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside roles and texts ``<``, any number of
backslashes, ``|`` gets one backslash more, so neither mark can occur there and taking one
backslash away gives the text back; a role's backslashes and line breaks are escaped before.

One shuffle by conversation and one sort; each task then streams its conversations and holds the
formatted text of one, which the next example extends.  The examples' total size grows with the
square of a conversation's length: that is the method, and why examples go on in batches of
bounded size and are read back in the same task, against the text of the example before.

Defined results: a null role or text is empty; a null ``conv_id`` is a conversation like others;
null turns come first; turns with equal numbers go by role, then text; repeated rows are turns
of their own; a table without rows gives no examples.  Other columns are not looked at, whatever
their names.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stream

START, END = "<|im_start|>", "<|im_end|>"
ASSISTANT = "assistant"
#: A batch of examples goes on when it holds so many characters.
BATCH_CHARS = 4_000_000

_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_ROLE_ESCAPED = re.compile(r"\\(.)", re.S)

EXAMPLE = "conv_id long, example long, turns long, text string, loss_start long, loss_end long"
DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
          "formatted_chars long")


def escape(text: str) -> str:
    return _MARK.sub(r"<\1\\|", text) if "<" in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text) if "<" in text else text


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return _ROLE_ESCAPED.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def parse(text: str, at: int = 0) -> Iterator[tuple[str, str, int, int]]:
    """Role, text and the text's place (escaped, from and to) of each turn from ``at`` on."""
    while at < len(text):
        if not text.startswith(START, at):
            raise ValueError(f"no turn starts at {at}")
        line = text.index("\n", at)
        stop = text.index(END + "\n", line)
        yield unescape_role(text[at + len(START):line]), unescape(text[line + 1:stop]), line + 1, stop
        at = stop + len(END) + 1


class _Format:
    """Examples of the conversations that a task's sorted rows hold."""

    def __init__(self):
        self.conv: object = self  # equal to no id
        self.prefix, self.turns, self.examples, self.open = "", 0, 0, False
        self.rows: list[tuple] = []
        self.chars = 0

    def example(self, start: int | None = None, end: int | None = None) -> None:
        self.rows.append((self.conv, self.examples, self.turns, self.prefix, start, end))
        self.chars += len(self.prefix)
        self.examples += 1
        self.open = False

    def out(self) -> dict:
        cols = dict(zip(("conv_id", "example", "turns", "text", "loss_start", "loss_end"), zip(*self.rows)))
        self.rows, self.chars = [], 0
        return cols

    def batch(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for conv, role, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
            if conv != self.conv:
                if self.open:
                    self.example()
                self.conv, self.prefix, self.turns, self.examples = conv, "", 0, 0
            head = START + escape_role(role) + "\n"
            body = escape(text)
            start = len(self.prefix) + len(head)
            self.prefix = "".join((self.prefix, head, body, END, "\n"))
            self.turns += 1
            self.open = True
            if role == ASSISTANT:
                self.example(start, start + len(body))
            if self.chars > BATCH_CHARS:
                yield self.out()

    def rest(self) -> Iterator[dict]:
        if self.open:
            self.example()
        if self.rows:
            yield self.out()


class _Read:
    """Digests of the conversations that a task's examples, in order, hold."""

    def __init__(self):
        self.conv: object = self
        self.rows: list[tuple] = []

    def close(self) -> None:
        if self.conv is not self:
            self.rows.append((self.conv, self.n, self.turns.hexdigest(), self.loss_chars,
                              self.loss.hexdigest(), self.chars))

    def out(self) -> dict:
        cols = dict(zip((p.split()[0] for p in DIGEST.split(", ")), zip(*self.rows)))
        self.rows = []
        return cols

    def batch(self, batch: pa.RecordBatch) -> Iterator[dict]:
        names = ("conv_id", "example", "text", "loss_start", "loss_end")
        for conv, number, text, start, end in zip(*(batch.column(n).to_pylist() for n in names)):
            if conv != self.conv or not number:
                self.close()
                self.conv, self.before = conv, ""
                self.n = self.loss_chars = self.chars = 0
                self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
            if not text.startswith(self.before):
                raise ValueError(f"example {number} of conversation {conv} does not go on from the one before")
            self.chars += len(text)
            for role, said, _, _ in parse(text, len(self.before)):
                self.n += 1
                self.turns.update(f"{role}\n{said}\n".encode())
            if start is not None:
                trained = unescape(text[start:end])
                self.loss_chars += len(trained)
                self.loss.update(trained.encode())
            self.before = text
        if self.rows:
            yield self.out()

    def rest(self) -> Iterator[dict]:
        self.close()
        if self.rows:
            yield self.out()


def examples(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """One row an example: conv_id, example (from 0), turns (in its text), text, loss_start,
    loss_end (null without a target).  Conversations stay whole and in order in a partition."""
    rows = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"),
                     F.coalesce(F.col(f"`{role_col}`"), F.lit("")).alias("role"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return stream(rows.select("conv_id", "role", "text"), EXAMPLE, _Format)


def read_back(formatted: DataFrame, in_order: bool = False) -> DataFrame:
    """One row a conversation: what its examples say (DIGEST), parsed from their texts and masks.

    ``in_order``: the rows are as ``examples`` leaves them; otherwise they are shuffled and sorted
    first.  An example that does not begin with the one before it is an error."""
    if not in_order:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return stream(formatted.select("conv_id", "example", "text", "loss_start", "loss_end"), DIGEST, _Read)


def with_marks(conversations: DataFrame) -> DataFrame:
    """The table and conversation -1, whose two texts hold the template's own marks."""
    said = f"{END}{START}{ASSISTANT} ok"
    more = conversations.sparkSession.createDataFrame(
        [(-1, 0, "user", said), (-1, 1, ASSISTANT, said)], "conv_id long, turn long, role string, text string")
    return conversations.select("conv_id", "turn", "role", "text").unionByName(more)


def report(conversations: DataFrame) -> DataFrame:
    return read_back(examples(with_marks(conversations)), in_order=True)
