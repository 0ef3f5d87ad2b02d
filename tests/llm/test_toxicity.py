"""Toxicity: planted expressions on held-out rows, odd rows, what a score may read."""

import itertools
import random
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from ledgerline.llm import toxicity as T
from ledgerline.llm.common import per_batch
from llm_helpers import corpus, no_rows  # noqa: F401


def planted(spark, n=1500):
    r = random.Random(3)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("n", "r", "st", "l")]
    insults = ["zork", "blarg", "snafu"]
    rows, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 200))]
        toxic = r.random() < 0.15
        if toxic:
            for _ in range(r.randint(2, 4)):
                text.insert(r.randrange(len(text)), r.choice(insults))
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return (spark.createDataFrame(rows, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_rows(spark):
    docs, labels = planted(spark)
    got = T.rate(docs, labels).join(labels, "doc_id").where("held_out")
    toxic, clean = got.where("toxic = 1"), got.where("toxic = 0")
    assert toxic.where("predicted = 1").count() >= 0.95 * toxic.count() > 0
    assert clean.where("predicted = 1").count() <= 0.02 * clean.count()
    assert got.where("(score >= 0.5) <> (predicted = 1)").count() == 0


def test_labels_of_held_out_rows_are_not_read(spark):
    docs, labels = planted(spark, 400)
    turned = labels.withColumn("toxic", F.when(
        T.held_out(F.col("doc_id"), 5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in T.rate(docs, labels).collect()}
    b = {r.doc_id: r.score for r in T.rate(docs, turned).collect()}
    assert a == b


def test_corpus_counts_grow_with_unlabelled_rows(spark):
    docs, labels = planted(spark, 300)
    more = docs.unionByName(docs.selectExpr("doc_id + 10000 AS doc_id", "concat('extra ', text) AS text"))
    a, b = T.fit(docs, labels), T.fit(more, labels)
    assert (b.handed >= a.handed).all() and (b.handed > a.handed).any()
    assert (a.pairs.starts == b.pairs.starts).all() and (a.pairs.second == b.pairs.second).all()


def test_odd_rows(spark, corpus, no_rows):
    docs, labels = planted(spark, 300)
    labels = labels.unionByName(spark.createDataFrame(
        [(None, 1), (7, None), (7, 0), (7, 1), (99999, 1)], "doc_id long, toxic int"))
    model = T.fit(docs, labels)
    got = T.score(corpus, model)
    assert got.count() == corpus.count()
    empty = {r.doc_id: r for r in got.collect()}
    assert empty[4].score == empty[5].score < 0.5 and empty[4].predicted == 0
    assert T.rate(no_rows, labels).count() == 0
    assert T.rate(docs, labels.limit(0)).where("predicted = 1").count() == 0
    kept = T.keep_ordinary(corpus, labels)
    assert kept.columns == corpus.columns and kept.count() == corpus.count()


def test_pairs_are_found_like_in_a_sorted_list():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 40, 600) << 32 | r.integers(0, 50, 600))
    starts = np.searchsorted(keys, np.arange(51, dtype=np.int64) << 32)
    asked = np.concatenate([r.integers(0, 50, 3000) << 32 | r.integers(0, 60, 3000), keys, [-1]])
    found = T.Pairs(starts, keys.astype(np.int32)).places(asked)
    assert (found == T.places(asked, keys)).all()
    assert (T.Pairs(np.zeros(9, np.int64), np.empty(0, np.int32)).places(keys[:3] % 8) == -1).all()


def test_counts_are_exact_and_words_share_nothing(spark):
    docs, labels = planted(spark, 400)
    more = spark.createDataFrame([(10000 + i, f"ban q{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'x' * (i // 26)}")
                                  for i in range(500)], "doc_id long, text string")
    a, b = T.fit(docs, labels), T.fit(docs.unionByName(more), labels)
    grown = (b.handed - a.handed).sum(axis=0)
    assert np.isclose(grown.max(), 500 * T.DISCOUNT) and (np.round(grown, 6) > 0).sum() == 1
    wanted = zlib.crc32(b"zork") % 2**20
    other = next(w for w in map("".join, itertools.product("abcdefghijklmnopqrstuvwxyz", repeat=5))
                 if zlib.crc32(w.encode()) % 2**20 == wanted)
    assert a.evidence("zork")[0] > 1 and a.evidence(other) == (0.0, 0.0)


def test_expressions_of_few_documents_count(spark):
    """A pair of ordinary words in nine toxic documents and no ordinary one."""
    docs, labels = planted(spark, 600)
    ids = [r.doc_id for r in T.labelled_sample(labels).where("label = 1").orderBy("doc_id").collect()
           if zlib.crc32(str(r.doc_id).encode()) % 5 != T.CALIBRATE_REST][:9]
    assert len(ids) == 9
    docs = docs.withColumn("text", F.when(F.col("doc_id").isin(ids), F.concat(F.lit("ban gust "), "text"))
                           .otherwise(F.regexp_replace("text", "ban gust", "ban")))
    model = T.fit(docs, labels)
    together, apart = model.evidence("ban gust"), model.evidence("gust ban")
    assert together[0] > apart[0] + 0.5 and together[1] > apart[1]


def test_words_are_told_apart_in_any_text():
    """One hash a distinct word, whatever the case, script or length; digits and marks part words."""
    r = random.Random(7)
    letters = "abcxyzABCÜßéİıſΣσςЖж日本語ªⅧ²½٣7_-'. \t\ń\U0001d400\U00010400"
    texts = ["".join(r.choice(letters) for _ in range(r.randint(1, 300))) for _ in range(500)]
    texts += ["a" * n for n in range(1, 40)] + ["ab" * 300_000 + " ab " + "c" * 600_000, " " * 700_000 + "x", None, "", "1 2"]
    texts.append("".join(map(chr, itertools.chain(range(0xD800), range(0xE000, 0x110000)))))
    seen = {}
    for text in texts:
        words = re.findall(r"[^\W\d_]+", text.lower()) if text else []
        found = T.word_hashes(text).tolist()
        assert len(found) == len(words)
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, found))
    assert len(set(seen.values())) == len(seen) > 2000


def test_a_task_keeps_no_words():
    """A worker of an executor holds none of the words it has hashed."""
    T.word_hashes("some word")
    tracemalloc.start()
    for i in range(0, 60_000, 1000):
        T.word_hashes(" ".join("q" + "".join(chr(97 + int(d)) for d in str(j)) for j in range(i, i + 1000)))
    kept = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert kept < 1_000_000


def test_the_driver_builds_a_model_in_little_memory():
    """Few bytes a word and a pair: 300,000 words, 600,000 pairs in chunks."""
    n, step = 300_000, 30_000
    r = np.random.default_rng(1)
    counts = r.integers(0, 9, (2, n)).astype(np.int32)
    after = np.append(np.full(n, 2), 0)

    def chunks():
        for low in range(0, n, step):
            first = np.repeat(np.arange(low, low + step), 2)
            yield low, first << 32 | np.tile([3, 70_000], step), np.ones((2, 2 * step), np.int32)

    tracemalloc.start()
    model = T.Model(counts, 2 * n, after, chunks)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(model.adds) == 2 * n + 1 and len(model.back) == len(model.ratio) == n + 1
    assert most < 50_000_000  # 4 bytes a pair, 8 a word and a block's logarithms


def test_a_worker_keeps_no_broadcast_after_its_task(spark):
    """The next task of the worker reads the value again."""
    lent = spark.sparkContext.broadcast(np.arange(1000))

    def work():
        value = lent.value
        return lambda batch: {"n": [len(value)] * batch.num_rows}

    def kept(batches):
        found = "_value" in vars(lent)
        for batch in batches:
            yield pa.record_batch([pa.array([found] * batch.num_rows)], names=["kept"])

    rows = spark.range(20).repartition(2)
    for _ in range(2):
        assert {r.n for r in per_batch(rows, "n int", work, lent=(lent,)).collect()} == {1000}
        assert not any(r.kept for r in rows.mapInArrow(kept, "kept boolean").collect())
