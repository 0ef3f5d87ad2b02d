"""Near-duplicates against all pairs of full sets."""

import random

import numpy as np

from conftest import SF_SMALL
from ledgerline.llm import near_dedup as N
from ledgerline.llm.graph import components
from llm_helpers import corpus, no_rows  # noqa: F401


def words(text):
    return (text or "").encode().lower().split()


def full_set(text):
    w = words(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """component by id: union-find over all pairs of ids with sets similar enough."""
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    sets = [(i, full_set(t)) for i, t in rows]
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b) and find(i) != find(j):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    return {i: find(i) for i in parent}, dict((i, len(s)) for i, s in sets)


def agrees(df):
    rows = [(r.doc_id, r.text) for r in df.collect() if r.doc_id is not None]
    comp, sizes = brute(rows)
    for r in N.group(df).collect():
        if r.doc_id is not None:
            assert (r.component_id, r.n_shingles) == (comp[r.doc_id], sizes[r.doc_id]), r
            assert r.kept == (r.doc_id == r.component_id)
        else:
            assert r.component_id is None and r.kept


def test_odd_rows(spark, corpus, no_rows):
    agrees(corpus)
    assert N.group(corpus).count() == corpus.count()
    assert N.group(no_rows).count() == 0
    kept = N.keep_one(corpus)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert kept.columns == corpus.columns and 2 not in ids and ids.count(9) == 1
    assert kept.where("doc_id is null").count() == 1
    clash = N.keep_one(corpus.withColumnRenamed("node", "_kept_id"))
    assert clash.columns[-1] == "_kept_id" and clash.count() == kept.count()


def test_chains_and_large_groups(spark):
    """Neighbours in a chain are similar, its ends are not; a group of variants of one text."""
    r = random.Random(2)
    vocabulary = [f"w{i}" for i in range(400)]
    chain = [r.choice(vocabulary) for _ in range(100)]
    rows = []
    for i in range(30):
        rows.append((1000 - i, " ".join(chain)))
        chain = chain[2:] + [r.choice(vocabulary) for _ in range(2)]
    base = [r.choice(vocabulary) for _ in range(120)]
    for i in range(120):
        v = list(base)
        for _ in range(r.randint(0, 4)):
            v[r.randrange(len(v))] = r.choice(vocabulary)
        rows.append((i, " ".join(v)))
    agrees(spark.createDataFrame(rows, "doc_id long, text string"))


def test_variants_on_both_sides_of_the_threshold(spark, monkeypatch):
    """Many variants of one text, near it and far from it, in buckets of several blocks; scratch
    tables of the run go."""
    import os
    monkeypatch.setattr(N, "BLOCK", 16)
    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [r.choice(vocabulary) for _ in range(140)]
    rows = []
    for i in range(300):
        v = list(base)
        for _ in range(r.randint(0, 12)):
            v[r.randrange(len(v))] = r.choice(vocabulary)
        rows.append((i, " ".join(v)))
    agrees(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    folder = N.scratch(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    assert not [f for f in os.listdir(folder) if f.startswith("ledgerline-near-dedup-")]


def test_groups_bound_what_sets_share():
    r = np.random.default_rng(6)
    base = r.integers(0, 2**63, 150, np.uint64)
    sets = [np.unique(np.concatenate([r.choice(base, r.integers(80, 150), False),
                                      r.integers(0, 2**63, r.integers(0, 40), np.uint64)])) for _ in range(30)]
    g = np.stack([np.bincount((s & np.uint64(N.GROUPS - 1)).astype(int), minlength=N.GROUPS) for s in sets])
    for i in range(30):
        for j in range(i):
            assert np.minimum(g[i], g[j]).sum() >= len(np.intersect1d(sets[i], sets[j]))


def test_whole_table(spark):
    agrees(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_registers_estimate_similarity():
    r = np.random.default_rng(1)
    for j in (0.3, 0.6, 0.9):
        n = 3000
        common = r.integers(0, 2**63, int(n * j), np.uint64)
        rest = r.integers(0, 2**63, n - len(common), np.uint64)
        a, b = np.concatenate([common, rest[::2]]), np.concatenate([common, rest[1::2]])
        ra, rb = N.registers(np.sort(a)), N.registers(np.sort(b))
        whole = N.registers(np.unique(np.concatenate([a, b])))
        assert (whole == np.maximum(ra, rb)).all()  # mergeable
        grid = np.linspace(0.01, 1, 100)
        ll = N.log_likelihoods(ra[None], rb[None], np.array([float(len(a))]), np.array([float(len(b))]), grid)
        assert abs(grid[ll[0].argmax()] - j) < 0.2


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (5, 5)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 10: 10, 11: 10, 12: 10}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_of_one_id_all_stay(spark):
    rows = [(1, "some words of one text here"), (1, "quite another text that shares nothing"),
            (1, "some words of one text here"), (2, "some words of one text here")]
    kept = N.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(tuple(r) for r in kept) == sorted(rows[:2])


def test_only_pairs_at_e20_odds_are_dropped():
    """A pair whose odds against 0.75 lie between e^12 and e^20 is verified."""
    grid = np.linspace(0.01, 1.0, 100)
    odds = []
    for same in range(97):  # registers that two sets of one size have in common
        a, b = np.zeros((1, 96)), np.zeros((1, 96))
        a[0, same::2], b[0, same + 1::2] = 1, 1
        ll = N.log_likelihoods(a, b, np.array([300.0]), np.array([300.0]), grid)
        odds.append((ll.max() - ll[:, grid >= 0.75 - 1e-9].max(), same))
    assert any(12 < o < 20 and o <= N.SURE for o, _ in odds)
    assert all(o <= N.SURE for o, _ in odds if o <= 20)
