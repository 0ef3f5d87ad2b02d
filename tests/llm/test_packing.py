"""Packing: ids equal the tokenizer's, every id lies in exactly one piece, windows are full."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from ledgerline.llm.packing import Packer, WordTokenizer, pack
from llm_helpers import corpus, no_rows, rng  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "a!'s", "!'s x", "don't.", "x<|endoftext|>y", "x<|ENDofTEXT|>y", "é!x", "!́a",
       "(a)b[c]1,2", "٠,", "İΣ.Σ", "J̌ É T̈x", "KÅ Ω", "ß ẞ ÉLAN",
       "ŉ ǰ ΐ", "ﬀ Ⓐ ⅷ Ⅷ ª º", "日本 語", "\t\r\x0b tab", "y" * 3000]


def test_ids_equal_tokenizer():
    w, t = WordTokenizer(PATH), Tokenizer.from_file(PATH)
    for _ in range(2):  # cold and warm memo
        for x in ODD:
            assert list(w.ids([x])[0]) == t.encode(x, add_special_tokens=False).ids, x


def check_pieces(rows, texts, window=2048):
    t = Tokenizer.from_file(PATH)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array(t.encode(texts[doc] or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == window or (at < window and at & (at - 1) == 0)


def test_pieces_cover_every_id(spark, corpus, no_rows):
    unique = corpus.dropDuplicates(["doc_id"])
    texts = {r.doc_id: r.text for r in unique.collect()}
    check_pieces(pack(unique.repartition(2), PATH).collect(), texts)
    assert pack(no_rows, PATH).count() == 0
    again = pack(corpus, PATH).where("doc_id = 9").collect()  # repeated rows are packed each
    assert sum(p.length for p in again) == 2 * again[0].doc_tokens


def test_level_choice_minimises_the_sum_of_squares(rng):
    p = Packer(64, 0)
    for _ in range(400):
        s = rng.randint(1, 63)
        h = p.choose(s)
        level = p.level.copy()

        def cost(at):
            new = level.copy()
            new[at] -= at > 0
            new[at + s] += 1
            return (new[1:64] ** 2).sum()

        options = [0] + [k for k in range(1, 64 - s + 1) if level[k]]
        assert cost(h) == min(map(cost, options))
        p.add(0, np.zeros(s, "<u4"))
