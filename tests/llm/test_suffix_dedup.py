"""Repeated passages against a count of every window; the columns against sorted suffixes."""

import random
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm.columns import Collection, repeated_starts
from ledgerline.llm.suffix_dedup import remove, report
from llm_helpers import corpus, no_rows, sha  # noqa: F401


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = True
        starts = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(d, np.uint8)[~gone[:-1]])
        out.append((len(d), int(gone.sum()), starts, sha(kept)))
    return out


@pytest.mark.parametrize("length,gram,hot", [(12, 4, 10**9), (12, 4, 2), (7, 3, 6)])
def test_equals_brute_force(spark, length, gram, hot):
    r = random.Random(length + hot % 97)
    texts = ["".join(r.choice("ab c") for _ in range(r.randint(0, 60))) for _ in range(60)]
    texts += ["a" * 50, "ab" * 30, None, "", "é" * 20, "a" * 50]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)],
                               "doc_id long, text string, tk string, spans long")
    got = {r.doc_id: tuple(r)[1:] for r in report(df, length=length, gram=gram, hot=hot).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, length)


def test_odd_rows(spark, corpus, no_rows):
    got = report(corpus).collect()
    assert len(got) == corpus.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[4].n_bytes == 0 and by_id[1].n_removed == by_id[1].n_bytes == by_id[2].n_removed
    assert report(no_rows).count() == 0
    kept = {r.doc_id: r.text for r in remove(corpus).collect()}
    assert kept[4] is None and kept[1] == "" and remove(corpus).columns == corpus.columns


def test_rounds_sort_suffixes_and_count_prefixes():
    r = random.Random(9)
    strings = [bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))) for _ in range(40)]
    starts = np.array([r.randint(0, 4) for _ in strings])
    c = Collection(strings, starts, 20, 50)
    for column, order, prefix in c.rounds():
        there = [i for i, s in enumerate(strings) if starts[i] <= column < starts[i] + len(s)]
        suffix = {i: strings[i][column - starts[i]:] for i in there}
        assert sorted(order) == there
        ordered = [suffix[i] for i in order]
        assert ordered == sorted(ordered)
        for a, b, n in zip(ordered, ordered[1:], prefix[1:]):
            common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common == n
    c.close()


def test_weights_stand_for_copies():
    found = repeated_starts([b"abcd", b"xyzw"], np.array([0, 0]), np.array([2, 1]), 6, 3)
    assert found.tolist() == [[True, True, False, False], [False] * 4]
