"""Exact key sets: members, union, difference and overlap equal Python's sets."""

import random

import pytest

from ledgerline.operators import keysets as KS

BIG = 1 << 62


@pytest.fixture(scope="module")
def parts():
    rnd = random.Random(4)
    odd = [-1, 0, 1, 32767, 32768, 65535, -32768, -32769, BIG, -BIG, BIG - 1]

    def some(n):
        return [rnd.choice([rnd.randrange(-70_000, 70_000), rnd.randrange(-BIG, BIG), rnd.choice(odd), None])
                for _ in range(n)]
    return [("a", k) for k in some(400)] + [("b", k) for k in some(300)] + [("c", None)]


def members(parts, by):
    return {k for b, k in parts if b in by and k is not None}


def got(frame):
    rows = [r.k for r in frame.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_operations(spark, parts):
    df = spark.createDataFrame(parts, "by string, k long").repartition(4)
    one = {b: KS.key_sets(df.where(f"by = '{b}'"), "k") for b in "abc"}
    for b in "abc":
        assert got(KS.keys(one[b], "k")) == members(parts, b)
    assert got(KS.keys(KS.minus(one["a"], one["b"]), "k")) == members(parts, "a") - members(parts, "b")
    assert got(KS.keys(KS.minus(one["a"], one["c"]), "k")) == members(parts, "a")
    split = KS.key_sets(df, "k", ("by",))
    assert got(KS.keys(KS.union(split), "k")) == members(parts, "abc")
    both = KS.keys(KS.overlap(one["b"], split, ("by",)), "k", ("by",)).collect()
    assert {(r.by, r.k) for r in both} == {("b", k) for k in members(parts, "b")} | {
        ("a", k) for k in members(parts, "b") & members(parts, "a")}


def test_neighbouring_keys_share_rows(spark):
    sets = KS.key_sets(spark.range(200_000), "id")
    assert sets.count() == 7
    assert sets.selectExpr("max(size(places))").first()[0] == 32768
