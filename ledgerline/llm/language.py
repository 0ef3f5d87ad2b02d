"""Language identification by segmentation-marginalised unigrams.

Each language has probabilities over the pieces of a fixed public vocabulary.  The probability
of a word is the sum over all its segmentations into pieces, by the forward algorithm; a text's
is the product over its words (runs of letters, lower case).  The language with the highest
posterior under equal priors is the prediction, its posterior the score.

Piece counts come from every document with a known language that is not held out, cut at
longest matches: one pass that adds up counts inside a task, then one row a (language, piece)
and task.  The model is bounded by vocabulary size times number of languages, whatever the
input.  Characters of no piece cost the same in every language.

Defined cases: null text, or text without a letter: ``und`` with score 0; null languages are
not learned; no learned language at all: every text is ``und``; a null id is carried and
counts as not held out; repeated rows count as often as they occur.
"""

from __future__ import annotations

import math
import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, beside, held, per_batch, quoted, tokenizer_file, unused

WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"
MEMO_WORDS = 600_000
#: Added to every count, and the probability of a character of no piece.
SMOOTH, OTHER = 0.1, 1e-9
HELD_OUT_MOD, HELD_OUT_REST = 4, 2


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``, equals ``rest``."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % mod == rest, F.lit(False))


class Vocabulary:
    """Lower-case pieces and an automaton over them."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        keep = re.compile(f"{MARK}?[^\\W\\d_]+|{MARK}")
        self.pieces = sorted({p.piece.lower() for p in proto.pieces
                              if p.type == 1 and keep.fullmatch(p.piece)})
        self.matcher = ahocorasick.Automaton()
        for i, p in enumerate(self.pieces):
            self.matcher.add_word(p, (len(p) - 1, i))
        self.matcher.make_automaton()
        self.cuts = Memo(MEMO_WORDS)

    def longest(self, word: str) -> bytes:
        """Piece numbers of a word cut at longest matches, as int32 bytes."""
        found = np.array([i for _, (_, i) in self.matcher.iter_long(MARK + word)], "<i4").tobytes()
        return self.cuts.put(word, found) if len(word) < 64 else found


@held
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class _Count:
    def __init__(self, path: str):
        self.vocab, self.counts = vocabulary(path), {}

    def __call__(self, batch: pa.RecordBatch) -> None:
        get, make = self.vocab.cuts.get, self.vocab.longest
        for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
            ids = np.frombuffer(b"".join([get(w) or make(w) for w in words_of(text.as_py())]), "<i4")
            counts = self.counts.setdefault(lang, np.zeros(len(self.vocab.pieces), np.int64))
            np.add.at(counts, ids, 1)

    def finish(self) -> dict:
        used = {lang: np.flatnonzero(c) for lang, c in self.counts.items()}
        return {"lang": [lang for lang, at in used.items() for _ in range(max(1, len(at)))],
                "piece": [int(i) for at in used.values() for i in (at if len(at) else [0])],
                "n": [int(self.counts[lang][i]) for lang, at in used.items()
                      for i in (at if len(at) else [0])]}


class Model:
    """Piece probabilities by language; ``key`` tells fitted models apart in a worker."""

    def __init__(self, langs: list[str], probs: np.ndarray):
        self.langs, self.probs, self.key = langs, probs, uuid.uuid4().hex


def fit(docs: DataFrame, path: str | None = None, lang_col: str = "lang",
        text_col: str = "text") -> Model:
    """Count pieces by language over all given rows with a language."""
    path = path or tokenizer_file("piece_bpe_32k.model")
    src = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = per_batch(src, "lang string, piece int, n long", lambda: _Count(path), finish="finish")
    # at most languages * vocabulary rows
    found = rows.groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found["lang"].unique())
    counts = np.full((len(vocabulary(path).pieces), len(langs)), SMOOTH)
    column = {lang: k for k, lang in enumerate(langs)}
    np.add.at(counts, (found["piece"].to_numpy(int), found["lang"].map(column).to_numpy(int)),
              found["n"].to_numpy(float))
    return Model(langs, counts / counts.sum(axis=0) if langs else counts)


class Scorer:
    """Word log-probabilities by the forward algorithm, with a bounded memo."""

    def __init__(self, path: str, model: Model):
        self.vocab, self.model = vocabulary(path), model
        self.rows = [tuple(r) for r in model.probs.tolist()]
        self.table = np.empty((MEMO_WORDS, max(1, len(model.langs))), np.float64)
        self.at = Memo(MEMO_WORDS)

    def log_prob(self, word: str) -> list[float]:
        """log of the summed probability of all segmentations, by language."""
        text = MARK + word
        n, k = len(text), len(self.model.langs)
        if n > 256:
            return self.log_prob_long(text)
        rows = self.rows
        forward: list[list[float] | None] = [None] * (n + 1)
        forward[0] = [1.0] * k
        span = range(k)
        done = 0  # positions up to here are final or lie behind an unknown character
        for end, (back, i) in self.vocab.matcher.iter(text):
            start, end = end - back, end + 1
            while done < start:
                done += 1
                if forward[done] is None:
                    before = forward[done - 1]
                    forward[done] = [x * OTHER for x in before]
            before, p, here = forward[start], rows[i], forward[end]
            if here is None:
                forward[end] = [before[j] * p[j] for j in span]
            else:
                for j in span:
                    here[j] += before[j] * p[j]
        while done < n:
            done += 1
            if forward[done] is None:
                forward[done] = [x * OTHER for x in forward[done - 1]]
        if min(forward[n]) < 1e-290:
            return self.log_prob_long(text)
        return [math.log(x) for x in forward[n]]

    def log_prob_long(self, text: str) -> list[float]:
        """The same in the log domain, for words whose probabilities would underflow."""
        n, k = len(text), len(self.model.langs)
        logs = np.full((n + 1, k), -np.inf)
        logs[0] = 0.0
        table, reached = np.log(self.model.probs), [True] + [False] * n
        done = 0
        for end, (back, i) in self.vocab.matcher.iter(text):
            start, end = end - back, end + 1
            while done < start:
                done += 1
                if not reached[done]:
                    logs[done], reached[done] = logs[done - 1] + math.log(OTHER), True
            logs[end] = np.logaddexp(logs[end], logs[start] + table[i])
            reached[end] = True
        while done < n:
            done += 1
            if not reached[done]:
                logs[done], reached[done] = logs[done - 1] + math.log(OTHER), True
        return logs[n].tolist()

    def slot(self, word: str) -> int:
        if len(self.at) >= MEMO_WORDS:
            self.at.clear()
        k = len(self.at)
        self.table[k] = self.log_prob(word)
        self.at[word] = k
        return k

    def log_probs(self, words: list[str]) -> np.ndarray:
        total = np.zeros(self.table.shape[1])
        for i in range(0, len(words), 50_000):
            part = words[i:i + 50_000]
            slots = list(map(self.at.get, part))
            if None in slots:
                if len(self.at) + len(part) > MEMO_WORDS:
                    self.at.clear()
                slots = [s if (s := self.at.get(w)) is not None else self.slot(w) for w in part]
            total += self.table[slots].sum(axis=0)
        return total

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.model.langs:
            return "und", 0.0
        logs = self.log_probs(words)
        odds = np.exp(logs - logs.max())
        best = int(np.argmax(odds))
        return self.model.langs[best], float(odds[best] / odds.sum())


_scorers: dict[str, Scorer] = {}


def scorer(path: str, model: Model) -> Scorer:
    """The worker's scorer for this model, kept from task to task."""
    if model.key not in _scorers:
        _scorers.clear()
        _scorers[model.key] = Scorer(path, model)
    return _scorers[model.key]


def predict(docs: DataFrame, model: Model, path: str | None = None, text_col: str = "text",
            keep: tuple[str, ...] = ("doc_id",),
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns plus language and score of every row; nothing is shuffled."""
    path = path or tokenizer_file("piece_bpe_32k.model")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # vocabulary * languages numbers

    def make():
        s = scorer(path, shared.value)

        def work(texts: pa.Array) -> list[list]:
            found = [s.predict(t.as_py()) for t in texts]
            return [[p for p, _ in found], [q for _, q in found]]

        return work

    return beside(docs, text_col, keep, [(names[0], "string"), (names[1], "double")], make)


def identify(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Fit on the documents that are not held out, predict for all."""
    out = held_out(F.col("doc_id"), HELD_OUT_MOD, HELD_OUT_REST)
    model = fit(docs.where(~out), path)
    return predict(docs, model, path).select("doc_id", out.alias("held_out"), "lang_pred", "score")


#: A posterior below this is no decision; with four languages chance is 0.25.
MIN_SCORE = 0.3


def keep_identified(docs: DataFrame, path: str | None = None, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents whose language is told, with all their columns: ``und`` and undecided ones go."""
    out = held_out(F.col("doc_id"), HELD_OUT_MOD, HELD_OUT_REST)
    model = fit(docs.where(~out), path)
    cols = tuple(docs.columns)
    names = unused(docs, "lang_pred"), unused(docs, "score")
    told = predict(docs, model, path, keep=cols, names=names)
    return told.where((F.col(names[0]) != "und") & (F.col(names[1]) >= min_score)).select(*quoted(cols))
