"""Ranked search against the plain sum, over tiles of any size, with ties and odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import lexical as L
from llm_helpers import rng  # noqa: F401

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=L.TOP):
    held = [(i, c) for i, t in docs if (c := Counter(terms(t)))]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(w for _, c in held for w in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, ws in asked.items():
        scored = []
        for doc, c in held:
            m = 50 + 50 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    * (1_000_000_000 * c[w] // (1000 * c[w] + 20 * m)) for w in ws if w in c)
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored, key=lambda x: x[:3])[:top], 1)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_terms_are_the_pattern(rng):
    chars = [chr(i) for i in range(256)] + list("日本ÉİK 　ſ")
    for _ in range(300):
        text = "".join(rng.choice(chars) for _ in range(60))
        assert [w.decode() for w in L.words(text.encode())] == terms(text)


@pytest.fixture(scope="module")
def rows():
    import random
    rng = random.Random(11)
    word = [f"w{i}" for i in range(60)] + ["Élan", "élan", "日本", "ZERO", "x1"]
    docs = [(i, " ".join(rng.choice(word) for _ in range(rng.randint(1, 50)))) for i in range(400)]
    docs += [(500 + i, "w1 w2, w2; w3!") for i in range(90)]  # more ties than places
    docs += [(None, "w1 w59"), (None, None), (700, None), (701, ""), (702, " .,\t\n"), (7, docs[7][1]),
             (703, "w5 " * 60_000 + "rare"), (704, "RARE é")]
    items = [(1, "w1 w2 w3"), (2, "W5, w5 rare-é"), (3, None), (4, "unknown words"), (None, "élan Élan"), (5, "w7"), (5, "w8 w9"),
             (6, " ".join(word)), (7, "日本 zero"), (7, "日本 zero"), (8, "")]
    return docs, items


def frames(spark, rows):
    docs, items = rows
    return (spark.createDataFrame([(*d, 1, [2]) for d in docs], "doc_id long, text string, n int, ids array<int>").repartition(5),
            spark.createDataFrame([(*i, "clash") for i in items], "item_id long, text string, terms string"))


def test_equals_the_plain_sum(spark, rows):
    assert found(L.search(*frames(spark, rows))) == brute(*rows)


def test_tiles_change_nothing(spark, rows, monkeypatch):
    for name, value in (("TILE_TERMS", 7), ("TILE_DOCS", 13), ("TILE_ITEMS", 2), ("SHARES", 2)):
        monkeypatch.setattr(L, name, value)
    assert found(L.search(*frames(spark, rows), top=9, item_terms_bound=20)) == brute(*rows, top=9)


def test_no_rows(spark, rows):
    docs, items = frames(spark, rows)
    for d, i in ((docs.limit(0), items), (docs, items.limit(0)), (docs.where("doc_id in (700, 701)"), items)):
        out = L.search(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.collect() == []


def test_partial_sums_are_exact():
    top = int(L.weights(10 ** 18, np.array([0]))[0])  # no table has more documents
    assert top * L.IMPACT * L.TILE_TERMS < L.EXACT
    assert L._Score([], np.array([10 ** 7]), 1, 1, 5).width * 10 ** 7 * L.IMPACT < L.EXACT
