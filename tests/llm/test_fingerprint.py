"""Fingerprints against sets of paragraphs; sketches that peel and that do not."""

import hashlib

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.llm import fingerprint as P
from llm_helpers import corpus, no_rows  # noqa: F401


def likeness(a, b):
    a, b = ({x for x in t.split("\n") if x} for t in (a, b))
    return 1.0 if not a and not b else 1 - len(a ^ b) / (len(a) + len(b))


def check(df, ranges=None):
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0]))
    got = {r.doc_id: r for r in P.compare(df).collect()}
    for n, (i, t) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        r = got[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert abs(r.near_edited - likeness(t, edited)) < 1e-12
        assert abs(r.near_next - likeness(t, following)) < 1e-12
        assert (r.fingerprint == r.edited_fingerprint) or t != edited


def test_odd_rows(spark, corpus, no_rows):
    check(corpus.dropDuplicates(["doc_id"]))
    assert P.compare(corpus).count() == corpus.count()
    assert P.compare(no_rows).count() == 0
    check(spark.createDataFrame([(1, "only\none")], "doc_id long, text string"))


def test_whole_table(spark):
    check(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))


def test_equal_texts_have_equal_fingerprints(spark):
    df = spark.createDataFrame([(i, "a\nb\nc" if i % 2 else "x") for i in range(20)], "doc_id long, text string")
    prints = {(r.n_chars, r.fingerprint) for r in P.compare(df).collect()}
    assert len(prints) == 2


def test_peeling_recovers_the_differing_digests(spark):
    left, right = list(range(0, 12)), list(range(4, 15))
    df = spark.range(1).select(
        *[F.transform(F.array(*[F.lit(v) for v in vs]), lambda v: F.xxhash64(v)).alias(n)
          for n, vs in (("a", left), ("b", right))])
    w = F.lit(10).cast("long")
    out = df.select("a", "b", P.peel(P.sketch(F.col("a"), w), P.sketch(F.col("b"), w), w).alias("d")).first()
    only_a = {x.k for x in out.d if x.n == 1}
    only_b = {x.k for x in out.d if x.n == -1}
    assert only_a == set(out.a) - set(out.b) and only_b == set(out.b) - set(out.a)
    tight = F.lit(1).cast("long")
    stuck = df.select(P.peel(P.sketch(F.col("a"), tight), P.sketch(F.col("b"), tight), tight).alias("d")).first()
    assert stuck.d is None


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    plan = P.compare(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_stored_fingerprints_hold_whole_cells(spark):
    text = "\n".join(f"line {i}" for i in range(9000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    sketched = df.select(P.sketch(P.digests(F.col("text")), F.lit(P.WIDTH).cast("long")).alias("c"))
    cells, stored = sketched.select("c", P.as_text(F.col("c"))).first()
    parts = [stored[i:i + 40] for i in range(0, len(stored), 40)]
    unsigned = 2**64 - 1
    assert max(c.n for c in cells) > 255
    assert [(int(p[:8], 16), int(p[8:24], 16), int(p[24:], 16)) for p in parts] == [
        (c.n, c.k & unsigned, c.c & unsigned) for c in cells]


def test_long_texts(spark):
    """Texts of 20,000 lines that differ in few, in many and in all lines."""
    lines = [f"line {i}" for i in range(20_000)]
    few = lines[:70] + ["new"] + lines[100:]
    many = [x if i % 3 else f"other {i}" for i, x in enumerate(lines)]
    texts = ["\n".join(t) for t in (lines, few, many, [f"else {i}" for i in range(15_000)])]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_blocks_count_like_sets(spark):
    rows = [(list(range(n)), [v for v in range(m, m + n) if v % 5]) for n, m in
            ((0, 0), (1, 0), (1, 9), (9, 3), (100, 1), (400, 7), (900, 450))]
    df = spark.createDataFrame(rows, "a array<long>, b array<long>").select(
        *[F.transform(c, lambda v: F.xxhash64(v)).alias(c) for c in "ab"])
    for width in (1, 10):  # with one cell a subtable nearly every block is settled by its lists
        for r in df.select("a", "b", P.in_blocks(F.col("a"), F.col("b"), width).alias("n")).collect():
            assert r.n == len(set(r.a) ^ set(r.b))
