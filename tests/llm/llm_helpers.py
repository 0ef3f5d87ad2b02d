"""Fixtures of the operator tests; test modules import them by name."""

import hashlib
import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def rng():
    return random.Random(5)


@pytest.fixture()
def corpus(spark):
    """Nulls, empty and very long texts, ties, repeated rows and clashing extra columns."""
    word = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]
    r = random.Random(1)

    def text(n):
        return " ".join(r.choice(word) + str(r.randint(0, 30)) for _ in range(n))

    base = text(60)
    near = base.split()
    near[30] = "changed"
    rows = [(1, base, "en"), (2, base, "en"), (3, " ".join(near), "en"), (4, None, None), (5, "", "fr"),
            (6, " \t\n ", "fr"), (7, "two words", "de"), (8, text(20_000), "en"), (None, text(30), "en"),
            (9, "x", "de"), (9, "x", "de"), (10, "1234 567 !!", "en"), (11, text(80), None),
            (12, "Ünïcödé é日本語 " * 40, "fr"), (13, base + " " + text(5), "en"), (14, "a" * 5000, "de")]
    return spark.createDataFrame(
        [(i, t, lang, "s", None, 7, "clash", 1.5) for i, t, lang in rows],
        DOCS + ", n long, score string, node double")


@pytest.fixture()
def no_rows(spark):
    return spark.createDataFrame([], DOCS)


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()
