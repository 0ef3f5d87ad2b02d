"""SentencePiece codec against the library on whole texts, odd inputs and random strings."""

import random

import public_tokenizers
import pytest
import sentencepiece

from conftest import SF_SMALL
from ledgerline.llm.pieces import encode_table, model
from llm_helpers import corpus, no_rows  # noqa: F401

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a  b   c    d\n\n  e", "▁▁x▁y", "\t\t \t x", "<s> </s> <0x0A> <unk>",
       "日本語 テキスト", "é ﬁ \U0001f469‍\U0001f467", "x" * 3000, " " * 333, "   " * 100 + "abc",
       "0123456789 10:30", "\x00 \x01", "a▁▁b ▁", "don't. (well)!? a_b"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def test_equals_library_on_odd_and_random_texts(library):
    r = random.Random(3)
    texts = ODD + ["".join(r.choice(" ab cdetionth▁\n\té1.,") for _ in range(r.randint(1, 60)))
                   for _ in range(3000)]
    m = model(PATH)
    for t in texts:
        ids = library.encode(t)
        assert m.encode(t) == ids, t
        assert m.decode(ids) == library.decode(ids), t


def test_decode_of_arbitrary_ids(library):
    r = random.Random(4)
    m = model(PATH)
    for _ in range(300):
        ids = [r.choice([r.randrange(3, 32000), r.randrange(3, 259)]) for _ in range(r.randint(1, 12))]
        assert m.decode(ids) == library.decode(ids), ids


def test_table(spark, corpus, no_rows, library):
    got = encode_table(corpus, PATH, ids=True, digests=True).collect()
    assert len(got) == corpus.count()
    by_id = {r.doc_id: r for r in got}
    for row in corpus.collect():
        r = by_id[row.doc_id]
        ids = library.encode(row.text or "")
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded == library.decode(ids)
    assert encode_table(no_rows, PATH).count() == 0


def test_query_digests(spark, library):
    from hashlib import sha256

    from ledgerline.llm.queries import op4_sentencepiece
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op4_sentencepiece(spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id])
        assert r.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256(library.decode(ids).encode()).hexdigest()


def test_query_decodes_the_ids(spark, monkeypatch):
    """A wrong id shows in the digest of the decoded text."""
    import ledgerline.llm.pieces as P

    m = model(PATH)
    for text in ODD:
        assert m.decode_joined(m.joined(text)) == m.decode(m.encode(text)), text
    made = {}
    wrong = ",".join(map(str, m.encode("other")))
    monkeypatch.setattr(m, "joined", lambda text: wrong)
    monkeypatch.setattr(P, "per_batch", lambda df, schema, make: made.setdefault("work", make()))
    encode_table(spark.createDataFrame([(1, "text")], "doc_id long, text string"), PATH, ids=False, digests=True)
    import hashlib
    import pyarrow as pa
    out = made["work"](pa.record_batch([pa.array([1]), pa.array(["text"])], names=["doc_id", "text"]))
    assert out["decoded_sha256"] == [hashlib.sha256(b"other").hexdigest()]
