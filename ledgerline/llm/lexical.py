"""Operator 11 - ranked lexical search by dense blocked BLAS multiplication, in whole numbers.

Terms are runs of ASCII letters, digits and any other non-ASCII characters, only A-Z lower-cased.
A document of n terms scores, for an item, the sum over the item's distinct terms of

    w * ((1000000000 * tf) div (1000 * tf + 20 * m)),    m = 50 + (50 * n * N) div L,
    w = floor(1000 * ln((2 * N + 2) / (2 * df + 1))).

1. Items are dealt by a hash into tiles of about ITEM_TERMS terms, so what goes to the driver and
   to every task at a time is bounded; each tile is one pass over the texts.
2. A pass turns every document into (n, ids and counts of the tile's terms), written once.  N, L
   and the document frequencies are aggregates of that table.
3. Blocks of documents become dense impact tiles (terms met in the block x documents), items dense
   weight tiles, both float64, and BLAS multiplies them.  An impact is below 10^6, and a tile has so
   few terms that the sum of its weights times 10^6 stays below 2^53, so every partial sum is exact in
   any order; tiles add up in int64.
4. A task keeps each item's TOP best; a tile's candidates are cut at the TOP-th largest score with
   all ties, then by document id.  Tasks' lists meet in two windows (by item and share of the
   tasks, then by item), so no task gets the lists of all.

Defined results: null and empty texts have no terms and do not count; rows that share a document
id are documents of their own; a null id ranks after all others; items that share an ``item_id``
are one item with the terms of all; items without terms, and empty tables, give no rows.  Other
columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import per_batch, stream, written

TOP = 50
#: Terms of a tile of items, about, and terms and documents of a tile of the multiplication.
ITEM_TERMS, TILE_TERMS, TILE_DOCS, TILE_ITEMS = 1 << 16, 4096, 512, 1024
IMPACT = 10 ** 6
EXACT = 1 << 53
#: Shares into which the tasks' lists are dealt before they meet.
SHARES = 64

#: Each byte to its lower case if it can be part of a term, else to a space.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())

COUNTS = "doc_id long, n long, ids array<int>, tfs array<int>"
HITS = "item_id long, doc_id long, score long, task int"


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def item_terms(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id and its distinct terms; items without terms are left out."""
    src = items.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def make():
        return lambda batch: {"item_id": batch.column(0),
                              "terms": [sorted(set(words(t))) for t in _texts(batch.column(1))]}

    return per_batch(src, "item_id long, terms array<binary>", make).where(F.size("terms") > 0)


def term_counts(docs: DataFrame, vocabulary: list[bytes], doc_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """doc_id, n (all terms) and the ids and counts of those in ``vocabulary``, of each document
    that has a term."""
    src = docs.select(F.col(f"`{doc_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text")).where("text <> ''")

    def make():
        number = {w: i for i, w in enumerate(vocabulary)}

        def run(batch: pa.RecordBatch) -> dict:
            n, ids, tfs, ends = [], [], [], [0]
            for text in _texts(batch.column(1)):
                all_words = words(text)
                n.append(len(all_words))
                found = Counter(map(number.get, all_words))
                found.pop(None, None)
                ids += found.keys()
                tfs += found.values()
                ends.append(len(ids))
            at = pa.array(ends, pa.int32())
            return {"doc_id": batch.column(0), "n": n,
                    "ids": pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())),
                    "tfs": pa.ListArray.from_arrays(at, pa.array(tfs, pa.int32()))}

        return run

    return per_batch(src, COUNTS, make).where("n > 0")


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class _Score:
    """The best documents of each item, over a task's rows of ``term_counts``."""

    def __init__(self, items: list[tuple[int | None, list[int]]], weight: np.ndarray, n_docs: int,
                 n_terms: int, top: int):
        self.items, self.weight, self.top = items, weight, top
        self.n_docs, self.n_terms = n_docs, n_terms
        self.holders = defaultdict(list)  # term: the items that hold it
        for i, (_, terms) in enumerate(items):
            for t in terms:
                self.holders[t].append(i)
        self.width = min(TILE_TERMS, (EXACT - 1) // (IMPACT * max(1, int(weight.max(initial=0)))))
        self.best = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)) for _ in items]
        self.floor = np.zeros(len(items), np.int64)

    def weight_tile(self, terms: np.ndarray) -> np.ndarray:
        tile = np.zeros((len(self.items), len(terms)))
        for col, t in enumerate(terms.tolist()):
            tile[self.holders[t], col] = self.weight[t]
        return tile

    def batch(self, batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(0, batch.num_rows, TILE_DOCS):
            self.block(batch.slice(at, TILE_DOCS))
        return iter(())

    def block(self, rows: pa.RecordBatch) -> None:
        doc, n, ids, tfs = (rows.column(c) for c in ("doc_id", "n", "ids", "tfs"))
        term, tf = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, tfs))
        if not len(term):
            return
        of = np.repeat(np.arange(rows.num_rows), ids.value_lengths().to_numpy(zero_copy_only=False))
        m = np.array([50 + 50 * x * self.n_docs // self.n_terms for x in n.to_pylist()], np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[of])
        met, place = np.unique(term, return_inverse=True)
        score = np.zeros((len(self.items), rows.num_rows), np.int64)
        for left in range(0, len(met), self.width):
            inside = (place >= left) & (place < left + self.width)
            tile = np.zeros((len(met[left:left + self.width]), rows.num_rows))
            tile[place[inside] - left, of[inside]] = impact[inside]
            score += (self.weight_tile(met[left:left + self.width]) @ tile).astype(np.int64)
        null = doc.is_null().to_numpy(zero_copy_only=False)
        self.keep(score, doc.fill_null(0).to_numpy(zero_copy_only=False), null)

    def keep(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        """Takes a tile's candidates into the items' lists: none that ties with the last goes unseen."""
        hit = (score > 0) & (score >= self.floor[:, None])
        for i in np.flatnonzero(hit.any(axis=1)).tolist():
            at = np.flatnonzero(hit[i])
            s, d, z = (np.concatenate(p) for p in zip(self.best[i], (score[i, at], doc[at], null[at])))
            if len(s) > self.top:
                cut = s >= np.partition(s, len(s) - self.top)[len(s) - self.top]
                s, d, z = s[cut], d[cut], z[cut]
            order = np.lexsort((d, z, -s))[:self.top]
            self.best[i] = s[order], d[order], z[order]
            if len(order) == self.top:
                self.floor[i] = s[order[-1]]

    def rest(self) -> Iterator[dict]:
        task = TaskContext.get().partitionId()
        for (item, _), (s, d, z) in zip(self.items, self.best):
            if len(s):
                yield {"item_id": [item] * len(s), "doc_id": pa.array(d, mask=z), "score": s,
                       "task": [task] * len(s)}


def _tile(docs: DataFrame, items: dict[int | None, set[bytes]], top: int) -> list[DataFrame]:
    """The tasks' best documents of a tile of items."""
    vocabulary = sorted(set().union(*items.values()))
    counts = written(term_counts(docs, vocabulary), "lexical-counts")
    n_docs, n_terms = counts.agg(F.count("*"), F.sum("n")).first()
    if not n_docs:
        return []
    df = np.zeros(len(vocabulary), np.int64)
    # at most one row a term of the tile
    for term, n in counts.select(F.explode("ids").alias("id")).groupBy("id").count().toLocalIterator():
        df[term] = n
    weight = weights(n_docs, df)
    number = {w: i for i, w in enumerate(vocabulary)}
    held = [(item, sorted(number[w] for w in terms)) for item, terms in items.items()]
    rows = counts.where(F.size("ids") > 0)
    return [stream(rows, HITS, lambda part=held[i:i + TILE_ITEMS]: _Score(part, weight, n_docs, n_terms, top))
            for i in range(0, len(held), TILE_ITEMS)]


def search(docs: DataFrame, items: DataFrame, top: int = TOP, item_terms_bound: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank, doc_id, score: each item's ``top`` best documents with a score above 0."""
    asked = written(item_terms(items), "lexical-items")
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    tiles = max(1, -(-total // item_terms_bound))
    place = F.pmod(F.xxhash64("item_id"), F.lit(tiles))
    found = []
    for i in range(tiles):  # a stated set of items against all documents, in blocks
        part = defaultdict(set)
        for item, terms in asked.where(place == i).toLocalIterator():
            part[item].update(bytes(t) for t in terms)
        if part:
            found += _tile(docs, part, top)
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    hits = reduce(DataFrame.unionAll, found).withColumn("share", F.col("task") % SHARES)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    for by in (["item_id", "share"], ["item_id"]):
        hits = hits.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
        hits = hits.where(F.col("rank") <= top)
    return hits.select("item_id", "rank", "doc_id", "score")
