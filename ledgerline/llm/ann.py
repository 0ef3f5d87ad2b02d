"""Approximate nearest neighbours by collision counting.

Rows are dealt into blocks by id hash.  A block keeps one sorted array for each of ``PROJECTIONS``
random projections.  A query centres a window on its own projection in each array; virtual
rehashing widens the windows step by step, and only the rows that enter are counted.  A vector
that collides in at least ``THRESHOLD`` of the windows is verified by its true distance.  At
radius R the windows are as wide as lets a vector at distance R collide with probability 0.725,
so the search of a block may stop when its k-th verified distance is no larger than R; windows
that cover a whole block end it too.  The blocks' lists are merged by query.

The query set (ids divisible by ``every``) meets all rows in blocks of bounded size: a task
holds one block of rows and one chunk of queries.  The first radius comes from the distances in
a bounded sample (``SAMPLE`` rows, smallest id hash); every row is indexed.  Equal vectors
collide everywhere, so ties by id are exact.

Defined cases: vectors that are null, empty, zero, or hold a null or non-finite component take
no part; vectors meet only those of their own length; repeated rows of one id count once (the
smallest vector of a length, if they differ), so do repeated queries; rows with a null id take no part;
fewer candidates than k: all of them; an empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PROJECTIONS, THRESHOLD = 64, 38
HALF_WIDTH = 1.092  # P(|N(0,1)| <= 1.092) = 0.725
WIDEN = 1.25
BLOCK_ROWS, QUERY_ROWS = 16_384, 16_384
SAMPLE = 512
SHARES = 64
SEED = 7


class Block:
    """Sorted projections of the vectors of one block."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, first_radius: float):
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():  # of repeated ids the smallest vector comes first
            order = np.lexsort([*vectors.T[::-1], ids])
        ids, vectors = ids[order], vectors[order]
        keep = np.concatenate([[True], ids[1:] != ids[:-1]])
        self.ids, self.vectors = ids[keep], vectors[keep]
        self.axes = np.random.default_rng(SEED).standard_normal((vectors.shape[1], PROJECTIONS))
        lines = self.vectors @ self.axes
        self.order = np.argsort(lines, axis=0, kind="stable").T.astype(np.int32).copy()
        self.lines = np.sort(lines, axis=0, kind="stable").T.copy()
        self.first = first_radius

    def search(self, query_id: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        centre = query @ self.axes
        counts = np.zeros(n, np.uint8)
        done = np.zeros(n, bool)
        own = np.searchsorted(self.ids, query_id)
        if own < n and self.ids[own] == query_id:
            done[own] = True
        low = np.array([np.searchsorted(line, c) for line, c in zip(self.lines, centre)])
        high = low.copy()
        found, distance = [], []
        best = np.empty(0)
        radius = self.first
        while True:
            left = np.array([np.searchsorted(line, c, "left") for line, c in
                             zip(self.lines, centre - HALF_WIDTH * radius)])
            right = np.array([np.searchsorted(line, c, "right") for line, c in
                              zip(self.lines, centre + HALF_WIDTH * radius)])
            left, right = np.minimum(left, low), np.maximum(right, high)
            for j in range(PROJECTIONS):
                if left[j] < low[j]:
                    counts[self.order[j, left[j]:low[j]]] += 1
                if right[j] > high[j]:
                    counts[self.order[j, high[j]:right[j]]] += 1
            low, high = left, right
            new = np.flatnonzero((counts >= THRESHOLD) & ~done)
            if len(new):
                done[new] = True
                d = np.sqrt(((self.vectors[new] - query) ** 2).sum(axis=1))
                found.append(new)
                distance.append(d)
                best = np.sort(np.concatenate([best, d]))[:k]
            if len(best) == k and best[-1] <= radius or (high - low).min() == n:
                break
            radius *= WIDEN
        if not found:
            return np.empty(0, np.int64), np.empty(0)
        at, d = np.concatenate(found), np.concatenate(distance)
        order = np.lexsort([self.ids[at], d])[:k]
        return self.ids[at][order], d[order]


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = F.col(f"`{vec_col}`").cast("array<double>")
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & (F.size("v") > 0)
                   & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                   & F.exists("v", lambda x: x != 0)))


def first_radius(rows: DataFrame) -> float:
    """A quarter of the median nearest distance in a bounded sample."""
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).toPandas()["v"]
    groups: dict[int, list] = {}
    for v in sample:
        groups.setdefault(len(v), []).append(v)
    near = []
    for vs in groups.values():
        x = np.array(vs)
        if len(x) > 1:
            d = np.sqrt(np.maximum(((x[:, None, :] - x[None]) ** 2).sum(axis=2), 0.0))
            d[d == 0] = np.inf
            near += [m for m in d.min(axis=1) if np.isfinite(m)]
    return float(np.median(near)) / 4 if near else 1.0


def neighbours(df: DataFrame, k: int = 10, every: int = 100, id_col: str = "vec_id",
               vec_col: str = "embedding") -> DataFrame:
    """The k nearest rows found for every row whose id is divisible by ``every``."""
    rows = usable(df, id_col, vec_col)
    radius = first_radius(rows)
    n = rows.count()
    blocks = max(1, math.ceil(n / BLOCK_ROWS))
    chunks = max(1, math.ceil(n / every / QUERY_ROWS))

    def dealt(number: int, salt: int):
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(number)).cast("int")

    data = rows.select("vec_id", "v", F.size("v").alias("dim"), dealt(blocks, 1).alias("block"),
                       F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"))
    queries = (rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
               .select(F.col("vec_id").alias("query_id"), "v", F.size("v").alias("dim"), dealt(chunks, 2).alias("chunk"),
                       F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")))

    def search(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            block = Block(left["vec_id"].to_numpy(np.int64), np.stack(left["v"]).astype(np.float64), radius)
            for q, v in zip(right["query_id"], right["v"]):
                ids, d = block.search(int(q), np.asarray(v, np.float64), k)
                out["query_id"] += [q] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += d.tolist()
        return pd.DataFrame(out).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    keys = ["dim", "block", "chunk"]
    found = data.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        search, "query_id long, vec_id long, score double")
    hits = found.withColumn("share", F.pmod(F.xxhash64("vec_id"), F.lit(SHARES)))
    for by in (["query_id", "share"], ["query_id"]):  # a query's lists of all blocks meet in shares first
        near = F.row_number().over(Window.partitionBy(*by).orderBy("score", "vec_id"))
        hits = hits.withColumn("rank", near).where(F.col("rank") <= k)
    return hits.select("query_id", "rank", "vec_id", "score")
