"""Toxicity by class-conditional Kneser-Ney models.

Two word-pair models, toxic and ordinary.  Counts are continuation counts: the number of
documents (contexts) that hold a word or a pair, so one long or repetitive document cannot
speak for a class.  A pair is discounted and backs off to its word, a word to a share that is
the same for every rare word; the weight handed down by a context follows the number of words
that come after it anywhere in the corpus, labelled or not, and is shared by both classes.  An
expression that neither class has often enough then weighs alike in both and says nothing.

A text's evidence is length-normalised twice: the log-likelihood ratio a word over the whole
text, and over its ``TOP`` most telling distinct words, which long clean texts do not dilute.
The score is a logistic function of both.

Words are maximal runs of letters of the lower-cased text.  They go by a full 64-bit hash, made
for all words of a text at once and kept by no task; a word and its neighbour by the two places
of their hashes in the sorted words of the sample, so no two share a count.  Class counts are
exact numbers of documents from a bounded sample of labelled rows (``SAMPLE`` rows a class,
smallest id hash first, not held out).  The number of distinct words after a word is exact over all rows and
grows with them: it is counted in Spark, for the words of the sample.  The model holds the
sample's distinct words and pairs and no others; it is collected and broadcast, and follows
the sample, which is bounded.  What the sample does not hold is unseen: it backs off.  A
quarter of the sample is kept from the counts and fits the logistic.

Defined cases: null or empty text has the score of no evidence, below 0.5; several labels of
one id count as their maximum, null labels not at all; a null id is carried, never labelled;
without labels of both classes nothing is predicted toxic; an empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, discard, forget, held, per_batch, quoted, scratch, unused
from .language import held_out

#: Words that a task gathers before it makes rows of them, and before it scores them.
PART, SCORE_PART = 500_000, 100_000
#: Characters hashed at once, and pairs or words whose logarithms are taken at once.
BLOCK = 1 << 18
#: Parts in which the driver reads the sample's pairs.
CHUNKS = 16
SAMPLE = 100_000
DISCOUNT = 0.75
#: Documents' worth of smoothing for a word, and for the pairs of a context.
WORD_WEIGHT, CONTEXT_WEIGHT = 3.0, 1000.0
TOP = 2
HELD_OUT_MOD, HELD_OUT_REST, CALIBRATE_REST = 5, 0, 4
#: Weights of both kinds of evidence and offset while few rows can calibrate them.
DEFAULT_FIT = (1.5, 1.0, -6.0)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finish of splitmix64: one-to-one, every bit of the result hangs on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@held
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """A number for every code point up to the last letter, 0 for all but letters and at the end,
    for those beyond; and powers for the places in a word."""
    letter = bytes(c.isalnum() and not c.isdecimal() for c in map(chr, range(0x110000))).rstrip(b"\0") + b"\0"
    numbers = _mixed(np.arange(1, len(letter) + 1, dtype=np.uint64))
    numbers[np.frombuffer(letter, np.uint8) == 0] = 0
    return numbers, _powers(256)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of a text's words in order: sums of each letter's number times its place's power."""
    if not text:
        return np.empty(0, np.uint64)
    text = text.lower()
    codes = (np.frombuffer(text.encode("ascii"), np.uint8) if text.isascii()
             else np.frombuffer(text.encode("utf-32-le"), np.uint32))
    numbers, powers = _letters()
    letter = np.zeros(len(codes) + 2, bool)
    for i in range(0, len(codes), BLOCK):
        letter[i + 1:i + 1 + BLOCK][:len(codes) - i] = numbers.take(codes[i:i + BLOCK], mode="clip") != 0
    edges = np.flatnonzero(letter[1:] != letter[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    longest = int((ends - starts).max())
    if longest > len(powers):
        powers = _powers(longest)
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + BLOCK, "right")))
        part, at = codes[starts[i]:ends[j - 1]], starts[i:j] - starts[i]
        place = np.arange(len(part)) - np.repeat(at, np.diff(at, append=len(part)))
        np.minimum(place, longest - 1, out=place)  # between words, where numbers are 0
        out[i:j] = np.add.reduceat(numbers.take(part, mode="clip") * powers[place], at)
        i = j
    return _mixed(out)


def places(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    """Places of values in a sorted array without repeats, -1 for those it does not hold."""
    if not len(sorted_values):
        return np.full(len(values), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return np.where(sorted_values[at] == values, at, -1)


def distinct_places(values: np.ndarray, sorted_values: np.ndarray) -> np.ndarray:
    """``places`` of many values with repeats; sorted, they are found in one sweep."""
    distinct, back = np.unique(values, return_inverse=True)
    return places(distinct, sorted_values)[back]


def distinct_rows(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (a, b), in order."""
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return a[new], b[new]


def pair_keys(at: np.ndarray) -> np.ndarray:
    """Keys of neighbours by their places; negative if either word is not in the sample."""
    key = (at[:-1] << 32) | at[1:]
    key[(at[:-1] < 0) | (at[1:] < 0)] = -1
    return key


class Pairs:
    """Sorted pairs of places in three bytes a pair (four beyond 2**24 words): ``second`` places
    in two parts, those of first place i from ``starts[i]`` to ``starts[i + 1]``."""

    def __init__(self, starts: np.ndarray, second: np.ndarray):
        self.starts, self.low, self.high = starts, *self.room(len(second), len(starts))
        self.put(0, second)

    @staticmethod
    def room(pairs: int, words: int) -> tuple[np.ndarray, np.ndarray]:
        return np.zeros(pairs, np.uint16), np.zeros(pairs, np.uint8 if words <= 1 << 24 else np.uint16)

    def put(self, at: int, second: np.ndarray) -> None:
        self.low[at:at + len(second)] = second & 0xFFFF
        self.high[at:at + len(second)] = second >> 16

    def __len__(self) -> int:
        return len(self.low)

    def seconds(self, at) -> np.ndarray:
        return self.high[at].astype(np.int32) << 16 | self.low[at]

    @property
    def second(self) -> np.ndarray:
        return self.seconds(slice(None))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of keys (``pair_keys``), -1 for those that are not here; all are halved at once."""
        out = np.full(len(keys), -1, np.int64)
        asked = np.flatnonzero(keys >= 0)
        first, wanted = keys[asked] >> 32, (keys[asked] & 0xFFFFFFFF).astype(np.int32)
        low, end = (self.starts[f].astype(np.int64) for f in (first, first + 1))
        high = end.copy()
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) >> 1
            less = self.seconds(middle) < wanted[open_]
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        found = np.flatnonzero(low < end)
        found = found[self.seconds(low[found]) == wanted[found]]
        out[asked[found]] = low[found]
        return out


def parts(batch: pa.RecordBatch, most: int = PART):
    """Word hashes of the texts of a batch (its first column), with their row numbers, for
    some ``most`` words at once."""
    rows, found, size = [], [], 0
    for i, text in enumerate(batch.column(0)):
        h = word_hashes(text.as_py())
        if len(h):
            rows.append(i)
            found.append(h)
            size += len(h)
        if size >= most:
            yield rows, found
            rows, found, size = [], [], 0
    if rows:
        yield rows, found


def _counted(name: str, by_class: list[list[np.ndarray]]) -> dict:
    """Rows (value, ordinary, toxic) from arrays of values, one a document, by class."""
    values, counts = zip(*[np.unique(np.concatenate([np.empty(0, np.int64), *v]), return_counts=True)
                           for v in by_class])
    zero = [np.zeros(len(v), np.int32) for v in values]
    return {name: pa.array(np.concatenate(values)),
            "ordinary": pa.array(np.concatenate([counts[0].astype(np.int32), zero[1]])),
            "toxic": pa.array(np.concatenate([zero[0], counts[1].astype(np.int32)]))}


def _words():
    """Documents of a class with a word."""
    def work(batch: pa.RecordBatch):
        labels = batch.column(1).to_pylist()
        for rows, found in parts(batch):
            by_class = [[], []]
            for i, h in zip(rows, found):
                by_class[labels[i]].append(np.unique(h).view(np.int64))
            yield _counted("word", by_class)

    return work


def _pairs(shared):
    """Documents of a class with a pair."""
    words = shared.value

    def work(batch: pa.RecordBatch):
        labels = batch.column(1).to_pylist()
        for rows, found in parts(batch):
            at = distinct_places(np.concatenate(found), words)
            by_class, start = [[], []], 0
            for i, h in zip(rows, found):
                by_class[labels[i]].append(np.unique(pair_keys(at[start:start + len(h)])))
                start += len(h)
            yield _counted("pair", by_class)

    return work


def _others(lent_words, lent_pairs):
    """Distinct pairs that are not in the sample, their places as one number that shuffles small
    (``first_of`` has the first); all first words outside the sample are one, -1, a second word
    outside it has the place -1 and goes by its hash."""
    words, pairs = lent_words.value, lent_pairs.value
    base = len(words) + 1

    def work(batch: pa.RecordBatch):
        for _, found in parts(batch):
            h = np.concatenate(found)
            at = distinct_places(h, words)
            follows = np.ones(len(h), bool)
            follows[np.cumsum([0, *map(len, found)])[:-1]] = False
            first = np.flatnonzero(follows[1:])
            a, b = at[first], at[first + 1]
            known = np.unique((a[b >= 0] << 32) | b[b >= 0])
            known = known[pairs.places(known) < 0]
            rare, after = distinct_rows(a[b < 0], h[first + 1][b < 0].view(np.int64))
            known = ((known >> 32) + 1) * base + (known & 0xFFFFFFFF) + 1
            yield {"pair": pa.array(np.concatenate([known, (rare + 1) * base])),
                   "hash": pa.array(np.concatenate([np.zeros(len(known), np.int64), after]))}

    return work


def first_of(pair: str, words: int):
    """The first place of a pair of ``_others``."""
    return F.expr(f"CAST({pair} DIV {words + 1} - 1 AS int)")


class Model:
    """Log-probability ratios of words and pairs.  ``counts``: documents of the sample's words by
    class; ``pairs``: number of its pairs; ``after``: distinct words that come after a word in the
    corpus, at last after all words outside the sample; ``chunks``: yields (first context, sorted
    keys, documents by class) of all pairs in order, some contexts at once.  What follows from
    counts alone is worked out for a ``BLOCK`` when needed: the driver keeps four bytes a pair."""

    def __init__(self, counts: np.ndarray, pairs: int = 0, after: np.ndarray | None = None, chunks=None):
        self.fit = DEFAULT_FIT
        size = counts.sum(axis=1).astype(np.float64)
        self.known = bool(size.all())
        if not self.known:
            return
        self.share = share = size / size.sum()

        def smooth(found: np.ndarray) -> np.ndarray:
            return np.maximum(found - DISCOUNT, 0.0) + WORD_WEIGHT * share[:, None]

        n = counts.shape[1]
        blocks = [slice(i, i + BLOCK) for i in range(0, n, BLOCK)]
        # one factor for both classes: a word that neither has is as likely in both
        scale = size[:, None] * (sum(smooth(counts[:, b]).sum() for b in blocks) / size.sum())
        # the last place, -1, is that of all words that are not in the sample
        self.ratio = np.zeros(n + 1, np.float32)
        for b in blocks:
            word = smooth(counts[:, b]) / scale
            self.ratio[:-1][b] = np.log(word[1] / word[0])
        self.adds = np.zeros(pairs + 1, np.float32)  # what a pair adds; the last: no pair of the sample
        #: What a context changes of a word's ratio where their pair is unseen.
        self.back = np.zeros(n + 1, np.float32)
        done = 0
        for lowest, keys, found in chunks():
            for i in range(0, len(keys), BLOCK):
                first, second = keys[i:i + BLOCK] >> 32, keys[i:i + BLOCK] & 0xFFFFFFFF
                word, context = smooth(counts[:, second]) / scale, handed(share, after[first])
                # a pair's backoff is also worth as many documents as a word's, however rare the word
                weight = WORD_WEIGHT / (share @ word)
                side = [np.log(np.maximum(found[c][i:i + BLOCK] - DISCOUNT, 0.0)
                               / ((context[c] + share[c] * weight) * word[c]) + 1.0) for c in (0, 1)]
                self.adds[done:done + len(first)] = side[1] - side[0]
                done += len(first)
            if len(keys):
                first = (keys >> 32) - lowest
                context = handed(share, after[lowest:lowest + first[-1] + 1])
                back = [np.log(context[c] / (np.bincount(first, found[c]) + context[c])) for c in (0, 1)]
                self.back[lowest:lowest + len(back[0])] = back[1] - back[0]

    def __getstate__(self) -> dict:
        """What a task needs beside words and pairs, which are lent on their own."""
        return {k: v for k, v in vars(self).items() if k not in ("share", "words", "pairs")}

    def pair_places(self, keys: np.ndarray) -> np.ndarray:
        distinct, back = np.unique(keys, return_inverse=True)
        return self.pairs.places(distinct)[back]

    def evidences(self, texts) -> list[tuple[float, float]]:
        """Log-likelihood ratio a word of the most telling distinct words, and of all words."""
        out = [(0.0, 0.0)] * len(texts)
        if not self.known:
            return out
        for rows, found in parts(pa.record_batch([texts], names=["text"]), SCORE_PART):
            h = np.concatenate(found)
            at = distinct_places(h, self.words)
            logs = self.ratio[at].astype(np.float64)
            more = self.back[at[:-1]] + self.adds[self.pair_places(pair_keys(at))]
            ends = np.cumsum(list(map(len, found)))
            more[ends[:-1] - 1] = 0.0  # the next text's first word
            logs[1:] += more
            for i, start, end in zip(rows, [0, *ends], ends):
                out[i] = _evidence_of(h[start:end], logs[start:end])
        return out

    def evidence(self, text: str | None) -> tuple[float, float]:
        return self.evidences(pa.array([text], pa.string()))[0]

    def scores(self, texts) -> list[float]:
        if not self.known:
            return [0.0] * len(texts)
        a, b, c = self.fit
        x, y = np.array(self.evidences(texts)).reshape(-1, 2).T
        return (1.0 / (1.0 + np.exp(-np.clip(a * x + b * y + c, -50, 50)))).tolist()


def handed(share: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The weight that contexts hand down, by class."""
    return share[:, None] * (DISCOUNT * after + CONTEXT_WEIGHT)


class Fitted:
    """A model in three broadcasts, words, pairs and the rest, each sent once; the driver keeps none
    of its large arrays but ``after``.  ``after`` and ``fit`` as in ``Model``."""

    def __init__(self, words, pairs, rest, share=None, after=None):
        self.lent, self.share, self.after, self.fit = (words, pairs, rest), share, after, DEFAULT_FIT

    @property
    def handed(self) -> np.ndarray | None:
        return None if self.after is None else handed(self.share, self.after)

    @property
    def pairs(self) -> Pairs:
        return self.lent[1].value

    def evidence(self, text: str | None) -> tuple[float, float]:
        return borrowed(self.lent).evidence(text)


def borrowed(lent) -> Model:
    """The model in a task."""
    words, pairs, model = (part.value for part in lent)
    model.words, model.pairs = words, pairs
    return model


def _evidence_of(h: np.ndarray, logs: np.ndarray) -> tuple[float, float]:
    best, words, left = 0.0, h, logs
    for _ in range(TOP):
        if not len(left):
            break
        i = left.argmax()
        best += left[i]
        others = words != words[i]
        words, left = words[others], left[others]
    return float(best) / TOP, float(logs.sum()) / (len(logs) + 20.0)


def labelled_sample(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """(doc_id, label) of at most ``size`` rows a class that are not held out."""
    one = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
           .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
           .where(~held_out(F.col("doc_id"), HELD_OUT_MOD, HELD_OUT_REST)))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    return (one.where("label = 0").orderBy(*order).limit(size)
            .unionByName(one.where("label = 1").orderBy(*order).limit(size)))


def _sorted(rows: DataFrame, kind) -> tuple[np.ndarray, np.ndarray]:
    """Keys (the first column) in order and both classes' counts."""
    found = rows.toArrow()
    keys = found[0].to_numpy().view(kind)
    order = np.argsort(keys)
    out = keys[order], np.stack([found[c].to_numpy()[order] for c in ("ordinary", "toxic")])
    del found, keys
    pa.default_memory_pool().release_unused()
    return out


def fit(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> Fitted:
    spark = docs.sparkSession
    lend = spark.sparkContext.broadcast  # words and pairs of the bounded sample
    sample = labelled_sample(labels, size).select(
        F.col("doc_id").alias("_id"),
        F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % HELD_OUT_MOD == CALIBRATE_REST,
               F.lit(None)).otherwise(F.col("label")).alias("_label"),
        F.col("label").alias("_target"))
    # the sample has at most 2 * size rows of two small numbers
    joined = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text")).join(
        F.broadcast(sample), F.col("_doc") == F.col("_id"), "left")
    counted = joined.where("_label is not null").select("_text", "_label")

    def summed(rows: DataFrame, by: str) -> DataFrame:
        return rows.groupBy(by).agg(*[F.sum(c).cast("int").alias(c) for c in ("ordinary", "toxic")])

    # distinct words, then pairs, of the bounded sample
    words, counts = _sorted(summed(per_batch(counted, "word long, ordinary int, toxic int", _words), "word"), np.uint64)
    n = len(words)
    lent = lend(words)
    del words
    if not counts.sum(axis=1).all():
        return Fitted(lent, lend(Pairs(np.zeros(n + 1, np.int32), np.empty(0, np.int32))), lend(Model(counts)))
    path, step = scratch(spark, "toxicity-pairs"), -(-n // CHUNKS)
    (summed(per_batch(counted, "pair long, ordinary int, toxic int", lambda: _pairs(lent), lent=(lent,)).where("pair >= 0"), "pair")
     .withColumn("chunk", F.floor(F.shiftright("pair", 32) / step).cast("int"))
     .sortWithinPartitions("chunk", "pair").write.option("compression", "zstd").partitionBy("chunk").parquet(path))
    table = spark.read.schema("pair long, ordinary int, toxic int, chunk int").parquet(path)

    def chunks():
        """One chunk's pairs at a time: the driver never holds the keys and counts of all."""
        for chunk in range(-(-n // step)):
            yield chunk * step, *_sorted(table.where(F.col("chunk") == chunk).drop("chunk"), np.int64)

    after, done, pairs = np.zeros(n + 1, np.int64), 0, Pairs(np.zeros(n + 1, np.int64), np.empty(0, np.int32))
    pairs.low, pairs.high = pairs.room(table.count(), n)
    for lowest, keys, _ in chunks():
        pairs.put(done, keys & 0xFFFFFFFF)
        done += len(keys)
        own = np.bincount((keys >> 32) - lowest)
        after[lowest:lowest + len(own)] = own
    np.cumsum(after[:-1], out=pairs.starts[1:])
    if done < 2**31:
        pairs.starts = pairs.starts.astype(np.int32)
    lent_pairs = lend(pairs)
    del keys, own, pairs
    forget(spark)

    # distinct words after each: those of the sample's pairs, and all others of the corpus
    others = per_batch(joined.where("_label is null").select("_text"), "pair long, hash long",
                       lambda: _others(lent, lent_pairs), lent=(lent, lent_pairs))
    others = others.distinct().groupBy(first_of("pair", n).alias("word")).count()
    others = others.toArrow()  # a row a word
    after[others["word"].to_numpy()] += others["count"].to_numpy()
    del others
    forget(spark)
    model = Model(counts, done, after, chunks)
    discard(spark, path)
    out = Fitted(lent, lent_pairs, lend(model), model.share, after)
    del model, counts
    apart = joined.where("_target is not null and _label is null").select("_text", "_target")
    seen = per_batch(apart, "best double, mean double, target int", lambda: _evidence(out.lent), lent=out.lent).toArrow()
    out.fit = logistic(np.column_stack([seen[c].to_numpy() for c in ("best", "mean")]),
                       seen["target"].to_numpy().astype(float))
    return out


def _evidence(lent):
    model = borrowed(lent)

    def work(batch: pa.RecordBatch) -> dict:
        found = model.evidences(batch.column(0))
        return {"best": [x for x, _ in found], "mean": [y for _, y in found], "target": batch.column(1)}

    return work


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float, float]:
    """Weights and offset by Newton steps with a small penalty; needs 10 rows of each class."""
    if y.sum() < 10 or (1 - y).sum() < 10:
        return DEFAULT_FIT
    x = np.column_stack([x, np.ones(len(x))])
    penalty = np.diag([0.05, 0.05, 1e-4])
    w = np.array(DEFAULT_FIT)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        norm = np.abs(step).max()
        w = w - step * min(1.0, 2.0 / norm)
        if norm < 1e-8:
            break
    return tuple(float(v) for v in w)


def score(docs: DataFrame, model: Fitted, keep: tuple[str, ...] = ("doc_id",),
          names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``keep`` columns plus score and predicted of every row; nothing is shuffled."""
    lent, weights = model.lent, model.fit

    def make():
        model = borrowed(lent)
        model.fit = weights

        def work(texts: pa.Array) -> list[list]:
            found = model.scores(texts)
            return [found, [int(p >= 0.5) for p in found]]

        return work

    return beside(docs, "text", keep, [(names[0], "double"), (names[1], "int")], make, lent)


def rate(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and prediction of every document."""
    out = held_out(F.col("doc_id"), HELD_OUT_MOD, HELD_OUT_REST)
    return score(docs, fit(docs, labels)).select("doc_id", out.alias("held_out"), "score", "predicted")


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents not predicted toxic, with all their columns."""
    cols = tuple(docs.columns)
    names = unused(docs, "score"), unused(docs, "predicted")
    return (score(docs, fit(docs, labels), cols, names)
            .where(F.col(names[1]) == 0).select(*quoted(cols)))
