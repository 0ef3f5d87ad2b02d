"""Nearest neighbours: recall and exact distances against brute force."""

import numpy as np
import pytest

from conftest import SF_MID
from ledgerline.llm import ann


def brute(ids, x, q, k):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1))
    d[ids == q] = np.inf
    order = np.lexsort([ids, d])[:k]
    return list(ids[order]), list(d[order])


def recall(df, got, k=10):
    p = df.toPandas().drop_duplicates("vec_id").sort_values("vec_id")
    ids, x = p.vec_id.to_numpy(), np.stack(p.embedding).astype(float)
    hit = total = 0
    for q, g in got.toPandas().sort_values("rank").groupby("query_id"):
        near, d = brute(ids, x, q, k)
        hit, total = hit + len(set(near) & set(g.vec_id)), total + len(near)
        assert list(g["rank"]) == list(range(1, len(g) + 1)) and q not in set(g.vec_id)
        at = {i: s for i, s in zip(ids, np.sqrt(((x - x[ids == q][0]) ** 2).sum(axis=1)))}
        assert np.allclose([at[v] for v in g.vec_id], g.score, rtol=0, atol=1e-12)
    return hit / total


def test_recall_on_table(spark):
    df = spark.read.parquet(f"{SF_MID}/embeddings.parquet")
    assert recall(df, ann.neighbours(df, every=10)) >= 0.9


def test_many_blocks_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 100)
    monkeypatch.setattr(ann, "QUERY_ROWS", 5)
    r = np.random.default_rng(2)
    rows = [(i, [float(v) for v in r.standard_normal(16)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one very common vector
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.neighbours(df, every=50)
    assert recall(df, got) >= 0.9
    assert [x.vec_id for x in got.where("query_id = 0").orderBy("rank").collect()] == list(range(1000, 1010))


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, None, 2), (2, [], 1), (3, [0.0, 0.0], 1), (4, [nan, 1.0], 1),
            (5, [inf, 1.0], 1), (6, [None, 1.0], 1), (7, [1.0, 0.5], 1), (8, [1.0, 0.5, 2.0], 1),
            (None, [1.0, 1.0], 1), (9, [2.0, 0.5], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int")
    got = [(r.query_id, r["rank"], r.vec_id) for r in ann.neighbours(df).orderBy("rank").collect()]
    assert got == [(0, 1, 7), (0, 2, 9)]
    assert ann.neighbours(df.limit(0)).count() == 0


@pytest.mark.parametrize("k", [1, 3])
def test_fewer_candidates_than_k(spark, k):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<double>")
    assert ann.neighbours(df, k=k).count() == 1


@pytest.mark.parametrize("order", [1, -1])
def test_repeated_ids_keep_the_smallest_vector(spark, order):
    """Whatever the order of arrival, and on the query's side as on the index's."""
    rows = [(0, [1.0, 0.0]), (1, [1.0, 5.0]), (1, [1.0, 2.0]), (100, [9.0, 9.0]), (100, [9.0, 3.0])][::order]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = {(r.query_id, r.vec_id): r.score for r in ann.neighbours(df).collect()}
    assert got[0, 1] == 2.0
    assert got[0, 100] == got[100, 0] == np.sqrt(64.0 + 9.0)
