"""Language ID: the forward algorithm against all segmentations, and held-out accuracy."""

import math

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from conftest import SF_MID
from ledgerline.llm import language as L
from llm_helpers import corpus, no_rows  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")


def all_segmentations(text, probs):
    if not text:
        return 1.0
    return sum(probs[text[:n]] * all_segmentations(text[n:], probs)
               for n in range(1, len(text) + 1) if text[:n] in probs)


def test_forward_sums_all_segmentations():
    vocab = L.vocabulary(PATH)
    table = np.random.default_rng(1).random((len(vocab.pieces), 2))
    table /= table.sum(axis=0)
    s = L.Scorer(PATH, L.Model(["a", "b"], table))
    for word in ("house", "straße", "el", "nation", "zürich"):
        for k in range(2):
            probs = {p: table[i, k] for i, p in enumerate(vocab.pieces)}
            expect = math.log(all_segmentations(L.MARK + word, probs))
            assert abs(s.log_prob(word)[k] - expect) < 1e-9
            assert abs(s.log_prob_long(L.MARK + word)[k] - expect) < 1e-9
    assert np.allclose(s.log_prob("日本語x"), s.log_prob_long(L.MARK + "日本語x"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = L.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right = got.where("lang = lang_pred").count()
    assert right >= 0.98 * got.count() > 0
    assert got.where("score < 0 or score > 1").count() == 0


def test_odd_rows(spark, corpus, no_rows):
    got = L.identify(corpus)
    assert got.count() == corpus.count()
    by_id = {r.doc_id: r for r in got.collect()}
    for i in (4, 5, 6, 10):
        assert (by_id[i].lang_pred, by_id[i].score) == ("und", 0.0)
    assert L.identify(no_rows).count() == 0
    unlabelled = corpus.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify(unlabelled).collect()} == {"und"}
    kept = L.keep_identified(corpus)
    assert kept.columns == corpus.columns
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {4, 5, 6, 10} and {1, 2, 3, 13} <= ids


def test_prediction_reads_text_only(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").limit(50)
    model = L.fit(docs)
    a = L.predict(docs, model).orderBy("doc_id").drop("doc_id").collect()
    changed = docs.withColumn("lang", F.lit("zz")).withColumn("source", F.lit("s"))
    assert L.predict(changed, model).orderBy("doc_id").drop("doc_id").collect() == a
