"""Removal of repeated passages by column-wise suffix construction.

A byte goes if a ``LENGTH``-byte string that covers it also starts anywhere else.

Distribution.  The smallest of the ``GRAM``-byte hashes inside a window of ``LENGTH`` bytes is the
window's anchor, and equal windows have equal anchors at equal places.  A text's windows thus
fall into runs by anchor, and a run is one segment of text laid out around its anchor.  Anchors
that occur once in the corpus are done.  The segments of each other anchor (equal ones once,
with their number) form a collection whose suffixes are sorted column by column (columns.py);
a window is repeated if the common prefix with a neighbour in suffix order reaches ``LENGTH``,
or if its segment occurs more than once.  Every window belongs to one anchor, so nothing is
compared twice and no pair is written.

An anchor with more than ``HOT`` occurrences (a passage in a large share of all rows, whose
surroundings all differ) is not gathered in one collection: its windows are dealt out one by
one by a 128-bit hash and counted, with partial counts before the shuffle.

Texts are shuffled once to meet their candidate anchors; a table in the shared folder keeps
each distinct candidate text once, with its runs, so copies share all later work.

Defined cases: null text counts as empty; texts shorter than ``LENGTH`` lose nothing but count
for nothing either; a null id is carried; repeated rows are copies of each other; an empty
table gives an empty table; columns other than id and text are not read by the query.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import repeated_starts
from .common import per_batch, quoted, unused, written

LENGTH, GRAM = 200, 57
HOT = 200_000
BATCH = 30_000
CHUNK = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)


def inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class Powers:
    """Powers of the step and of its inverse modulo 2**64, made longer when needed."""

    def __init__(self):
        self.up = self.down = np.empty(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << max(12, n.bit_length())
            for name, base in (("up", int(_STEP)), ("down", inverse(int(_STEP)))):
                x = np.full(size, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.cumprod(x, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_powers = Powers()


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    up, down = _powers.get(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=sums[1:])
    return mixed((sums[gram:] - sums[:-gram]) * down[:len(data) - gram + 1])


def runs(data: bytes, length: int = LENGTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (anchor hash, anchor, first window, last window) of a text's runs, by chunks.
    Chunks cut runs at window borders, which is harmless: anchors depend on their windows only."""
    buf = np.frombuffer(data, np.uint8)
    grams = length - gram + 1
    for at in range(0, len(buf) - length + 1, CHUNK):
        part = buf[at:at + CHUNK + length - 1]
        h = gram_hashes(part, gram)
        places = np.arange(len(h), dtype=np.uint64)
        packed = (h & ~np.uint64((1 << 21) - 1)) | places  # ties go to the first
        short = -len(h) % grams
        blocks = np.concatenate([packed, np.full(short, 2**64 - 1, np.uint64)]).reshape(-1, grams)
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        windows = len(part) - length + 1
        anchor = (np.minimum(after[:windows], before[grams - 1:grams - 1 + windows])
                  & np.uint64((1 << 21) - 1)).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(anchor)) + 1])
        last = np.concatenate([first[1:], [windows]]) - 1
        p = anchor[first]
        yield h[p].view(np.int64), p + at, first + at, last + at


def text_key(text: Column) -> Column:
    return F.xxhash64(text)


def anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """(h, tk, at): anchor hash, text key and first window of every run."""
    def make():
        def work(batch: pa.RecordBatch) -> dict | None:
            h, tk, at = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = text.as_py().encode("utf-8")
                if len(data) >= length:
                    for found, _, first, _ in runs(data, length, gram):
                        h.append(found)
                        at.append(first)
                        tk.append(np.full(len(found), key, np.int64))
            if not h:
                return None
            return {"h": np.concatenate(h), "tk": np.concatenate(tk), "at": np.concatenate(at)}
        return work

    return per_batch(texts, "h long, tk long, at long", make)


def segments(chosen: DataFrame, length: int, gram: int) -> DataFrame:
    """Segments of the chosen runs of each text: (h, sid, tk, at, start, data, c); for hot anchors
    one row a window, with data null.  ``chosen``: (tk, text, cold array, hot array, c)."""
    width = length - gram

    def make():
        def work(batch: pa.RecordBatch) -> dict | None:
            out: dict[str, list] = {k: [] for k in ("h", "sid", "tk", "at", "start", "data", "c")}

            def add(*row):
                for col, v in zip(out.values(), row):
                    col.append(v)

            for tk, text, cold, hot, c in zip(*(batch.column(i) for i in range(5))):
                data, tk, c = text.as_py().encode("utf-8"), tk.as_py(), c.as_py()
                cold, hot = set(cold.as_py() or ()), set(hot.as_py() or ())
                for h, p, first, last in runs(data, length, gram):
                    for h1, p1, a, b in zip(h.tolist(), p.tolist(), first.tolist(), last.tolist()):
                        if a in cold:
                            part, start = data[a:b + length], width - (p1 - a)
                            sid = hashlib.blake2b(part, digest_size=16, salt=start.to_bytes(4, "little")).digest()
                            add(h1, sid, tk, a, start, part, c)
                        elif a in hot:
                            for i in range(a, b + 1):
                                sid = hashlib.blake2b(data[i:i + length], digest_size=16).digest()
                                add(h1, sid, tk, i, -1, None, c)
            return out if out["h"] else None
        return work

    return per_batch(chosen, "h long, sid binary, tk long, at long, start int, data binary, c int", make)


def judged(distinct: DataFrame, length: int, gram: int, batch_size: int = BATCH) -> DataFrame:
    """(h, sid, hits): the repeated windows of distinct segments as a bit string by column.
    ``distinct`` is dealt and sorted by anchor; a task works through batches of whole anchors."""
    width = 2 * length - gram

    class Task:
        def __init__(self):
            self.rows: list[tuple] = []

        def __call__(self, batch: pa.RecordBatch) -> dict | None:
            self.rows += zip(*(batch.column(i).to_pylist() for i in range(5)))
            if len(self.rows) < batch_size:
                return None
            last = self.rows[-1][0]
            k = next((i for i in range(len(self.rows) - 1, -1, -1) if self.rows[i][0] != last), -1) + 1
            ready, self.rows = self.rows[:k], self.rows[k:]
            return self.judge(ready) if ready else None

        def finish(self) -> dict | None:
            return self.judge(self.rows) if self.rows else None

        @staticmethod
        def judge(rows: list[tuple]) -> dict:
            h, sid, start, data, n = zip(*rows)
            found = repeated_starts(list(data), np.array(start), np.array(n), width, length)
            some = np.flatnonzero(found.any(axis=1)).tolist()
            bits = np.packbits(found, axis=1)
            return {"h": [h[i] for i in some], "sid": [sid[i] for i in some],
                    "hits": [bits[i].tobytes() for i in some]}

    return per_batch(distinct, "h long, sid binary, hits binary", Task, finish="finish")


def repeated(docs: DataFrame, text_col: str, length: int = LENGTH, gram: int = GRAM,
             hot: int = HOT) -> DataFrame:
    """(tk, text, spans): distinct texts with repeated bytes and their maximal covered spans,
    an array of (from, to)."""
    src = docs.where(F.col(f"`{text_col}`").isNotNull()).select(
        text_key(F.col(f"`{text_col}`")).alias("tk"), F.col(f"`{text_col}`").alias("text"))
    src = src.where(F.octet_length("text") >= length)
    found = anchors(src, length, gram)
    often = found.groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    by_text = found.join(often, "h").groupBy("tk").agg(
        F.collect_set(F.when(F.col("n") <= hot, F.col("at"))).alias("cold"),
        F.collect_set(F.when(F.col("n") > hot, F.col("at"))).alias("hot"))  # no longer than a text
    copies = src.groupBy("tk").agg(F.count("*").alias("copies"))
    texts = written(src.join(by_text.join(copies, "tk"), "tk").dropDuplicates(["tk"])
                    .select("tk", "text", "cold", "hot", F.least("copies", F.lit(2)).cast("int").alias("c")),
                    "texts")

    parts = written(segments(texts, length, gram), "segments")
    # dealt by anchor before equal segments are joined: their bytes are shuffled once
    distinct = (parts.where("start >= 0").select("h", "sid", "start", "data", "c").repartition("h")
                .groupBy("h", "sid").agg(F.first("start").alias("start"), F.first("data").alias("data"),
                                         F.least(F.sum("c"), F.lit(2)).alias("n"))
                .sortWithinPartitions("h"))
    hits = judged(distinct, length, gram)
    runs_hit = parts.where("start >= 0").select("h", "sid", "tk", "at", "start").join(hits, ["h", "sid"])
    windows = parts.where("start < 0").select("sid", "tk", "at", "c")
    lone = (windows.join(windows.groupBy("sid").agg(F.sum("c").alias("n")).where("n > 1").select("sid"), "sid")
            .select("tk", "at", F.lit(-1).alias("start"), F.lit(None).cast("binary").alias("hits")))
    marks = (runs_hit.select("tk", "at", "start", "hits").unionByName(lone)
             .groupBy("tk").agg(F.collect_list(F.struct("at", "start", "hits")).alias("marks")))
    return covered(texts.select("tk", "text").join(marks, "tk"), length)


def covered(marked: DataFrame, length: int) -> DataFrame:
    """Union of the repeated windows of each text, as maximal spans."""
    def make():
        def work(batch: pa.RecordBatch) -> dict | None:
            out: dict[str, list] = {"tk": [], "text": [], "spans": []}
            for tk, text, marks in zip(*(batch.column(i) for i in range(3))):
                text = text.as_py()
                starts = []
                for m in marks.as_py():
                    if m["start"] < 0:
                        starts.append(np.array([m["at"]]))
                        continue
                    bits = np.unpackbits(np.frombuffer(m["hits"], np.uint8))
                    starts.append(m["at"] - m["start"] + np.flatnonzero(bits))
                at = np.unique(np.concatenate(starts)) if starts else np.empty(0, int)
                if len(at):
                    gap = np.flatnonzero(np.diff(at) > length)
                    first = at[np.concatenate([[0], gap + 1])]
                    last = at[np.concatenate([gap, [len(at) - 1]])] + length
                    out["tk"].append(tk.as_py())
                    out["text"].append(text)
                    out["spans"].append([{"from": int(a), "to": int(b)} for a, b in zip(first, last)])
            return out if out["tk"] else None
        return work

    return per_batch(marked, "tk long, text string, spans array<struct<from:long,to:long>>", make)


def cut(text: str, spans: list[dict]) -> bytes:
    data, at, out = text.encode("utf-8"), 0, []
    for s in spans:
        out.append(data[at:s["from"]])
        at = s["to"]
    out.append(data[at:])
    return b"".join(out)


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"n_removed": [], "n_spans": [], "sha": []}
            for text, spans in zip(batch.column(1), batch.column(2)):
                spans = spans.as_py()
                out["n_removed"].append(sum(s["to"] - s["from"] for s in spans))
                out["n_spans"].append(len(spans))
                out["sha"].append(hashlib.sha256(cut(text.as_py(), spans)).hexdigest())
            return {"tk": batch.column(0), **out}
        return work

    changed = per_batch(repeated(docs, text_col, **sizes), "tk long, n_removed long, n_spans long, sha string", make)
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_key(text).alias("tk"),
                       F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    return rows.join(changed, "tk", "left").select(
        "doc_id", "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"))


def remove(docs: DataFrame, text_col: str = "text", **sizes: int) -> DataFrame:
    """The documents with repeated passages taken out of the text; a character cut in two at a
    passage's border goes with it.  Texts of which nothing is left stay as empty texts."""
    def make():
        def work(batch: pa.RecordBatch) -> dict:
            kept = [cut(t.as_py(), s.as_py()).decode("utf-8", "ignore")
                    for t, s in zip(batch.column(1), batch.column(2))]
            return {"tk": batch.column(0), "kept": kept}
        return work

    changed = per_batch(repeated(docs, text_col, **sizes), "tk long, kept string", make)
    key, kept = unused(docs, "_text_key"), unused(docs, "_text_kept")
    text = F.col(f"`{text_col}`")
    joined = docs.withColumn(key, text_key(text)).join(
        changed.select(F.col("tk").alias(key), F.col("kept").alias(kept)), key, "left")
    return joined.withColumn(text_col, F.coalesce(F.col(kept), text)).select(*quoted(docs.columns))
