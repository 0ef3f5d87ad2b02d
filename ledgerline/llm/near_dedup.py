"""Near-duplicates by SetSketch registers.

A document's set holds the hashes of its distinct five-word shingles.  Register i is the
truncated logarithm (base ``BASE``) of the smallest of exponentially distributed hash values of
the set: mergeable, and equal in two sketches with a probability that follows their Jaccard
similarity.  ``ROWS`` registers make a band; sets that share a band are candidates (a pair of
similarity 0.75 shares none with a probability of 3e-8).  From the registers of both and the
set sizes the similarity's likelihood is known; a pair is dropped if 0.75 and above are e**20
times less likely than the best value, or excluded by the sizes.  The others are verified on
their full sets.

Equal sets are one node, so copies cost nothing.  No bucket is expanded into pairs: first each
node is compared with its bucket's smallest node and the links are contracted to components;
then only nodes still apart in a common bucket count.  How many of a node's shingles any other
such node has bounds what it can share; that excludes the many variants of one text that are
near it but not near enough, and names each bucket's most typical node, with which the others
are compared next.  The nodes then outside a bucket's main component meet what is apart from them
there in blocks: their shingles are dealt into groups, and the smaller counts of each group bound
what two share, which leaves few pairs to compare.
Every candidate pair is thereby linked, compared, or already connected, so components are those
of all links.

Defined cases: null or empty text, or text of white space: empty set, linked with nothing;
fewer words than a shingle: the whole sequence is the one shingle; a null id: the row is
carried, linked with nothing, and kept; rows of one id are one document (their links are
joined); repeated rows are carried; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, per_batch, quoted, scratch, stream, unused, written
from .graph import components

WORDS, PERCENT = 5, 75
BANDS, ROWS = 32, 3
#: Close to 1: a register tells some thousand values apart, so sets that share nothing share no band.
BASE = 1.001
SURE = 20.0
CHUNK = 1024
#: Groups of shingles whose sizes bound what two sets share (a power of two), and nodes of a block.
GROUPS, BLOCK = 64, 512

_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64)
_MUL = _rng.integers(0, 2**64, (BANDS * ROWS, 1), np.uint64) | np.uint64(1)
_MIX = _rng.integers(0, 2**64, 64, np.uint64) | np.uint64(1)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles; A-Z are lower-cased."""
    words = text.encode("utf-8").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for j in range(min(size, len(h))):
        out ^= h[j:j + n]
        out *= _MIX[j]
        out ^= out >> np.uint64(29)
    return np.unique(out)


def registers(s: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set, as uint16."""
    low = np.full(len(_XOR), 2**64 - 1, np.uint64)
    for i in range(0, len(s), CHUNK):
        x = s[None, i:i + CHUNK] ^ _XOR
        x *= _MUL
        low = np.minimum(low, x.min(axis=1))
    smallest = -np.log1p(-(low.astype(np.float64) + 1.0) / 2.0**64.000001)  # exponential, rate 1
    return np.clip(np.floor(1.0 - np.log(smallest) / math.log(BASE)), 0, 65535).astype("<u2")


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h (hash of the text), n (set size), key (digest of the set), reg (registers)."""
    text = F.col(f"`{text_col}`")
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                      text.alias("text"))

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            n, key, reg = [], [], []
            for t in batch.column(2):
                s = shingles(t.as_py())
                n.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                reg.append(registers(s).tobytes() if len(s) else b"")
            return {"doc_id": batch.column(0), "h": batch.column(1), "n": n, "key": key, "reg": reg}
        return work

    return per_batch(src, "doc_id long, h long, n long, key binary, reg binary", make)


def log_likelihoods(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray,
                    grid: np.ndarray) -> np.ndarray:
    """Joint log-likelihood of similarities (columns) for pairs of sketches (rows)."""
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    j = np.minimum(grid[None, :], np.minimum(u, 1 - u) / np.maximum(u, 1 - u))

    def p(x):
        return -np.log1p(-np.clip(x, 1e-9, 1.0) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u - (1 - u) * j), p((1 - u) - u * j)
    equal = np.maximum(1.0 - up - down, 1e-9)
    return more * np.log(up) + less * np.log(down) + same * np.log(equal)


def likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) that may reach the similarity, judged by set sizes and registers."""
    side = [nodes.select(F.col("node").alias(s), F.col("n").alias(f"n{s}"), F.col("reg").alias(f"r{s}"))
            for s in "ab"]
    both = pairs.join(side[0], "a").join(side[1], "b").where(
        F.least("na", "nb") * 100 >= F.greatest("na", "nb") * PERCENT).select("a", "b", "na", "nb", "ra", "rb")
    grid = np.linspace(0.01, 1.0, 100)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            ra, rb = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(batch.num_rows, -1)
                      for i in (4, 5))
            na, nb = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            ll = log_likelihoods(ra, rb, na, nb, grid)
            keep = pa.array(ll[:, grid >= PERCENT / 100 - 1e-9].max(axis=1) >= ll.max(axis=1) - SURE)
            return {"a": batch.column(0).filter(keep), "b": batch.column(1).filter(keep)}
        return work

    return per_batch(both, "a long, b long", make)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs whose full sets are similar enough; ``texts``: (node, text) of candidate nodes."""
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "ta", "tb")

    def make():
        last: list = [None, None]  # pairs of one hub follow each other

        def work(batch: pa.RecordBatch) -> dict:
            keep = []
            for b, ta, tb in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if last[0] != b:
                    last[:] = b, shingles(tb.as_py())
                x, y = shingles(ta.as_py()), last[1]
                inter = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * inter >= PERCENT * (len(x) + len(y) - inter))
            mask = pa.array(keep, pa.bool_())
            return {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)}
        return work

    return per_batch(both, "a long, b long", make)


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    into = scratch(docs.sparkSession, "near-dedup")  # goes at the end, but for what the result reads
    rows = written(sketches(docs, id_col, text_col), "sketches", into)
    # a node is a set; its text is that of the smallest id
    nodes = written(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("key").agg(
        F.min(F.struct("doc_id", "h")).alias("rep"), F.first("n").alias("n"), F.first("reg").alias("reg"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes", into)
    rows = written(rows.join(nodes.select("key", "node"), "key", "left").select("doc_id", "n", "node"), "rows")

    width = 2 * ROWS
    bands = nodes.select("node", F.posexplode(F.array(*[
        F.substring("reg", width * i + 1, width) for i in range(BANDS)])).alias("band", "part")).select(
        F.xxhash64("band", "part").alias("bucket"), "node")
    hubs = bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.max("node").alias("top")).where("hub < top")
    shared = written(bands.join(hubs.select("bucket", "hub"), "bucket"), "buckets", into)  # those of two and more
    wanted = shared.select("node").distinct().join(nodes, "node").select("node", "rep.doc_id", "rep.h")
    text = F.col(f"`{text_col}`")
    texts = written(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"),
                                text.alias("text"))
                    .join(wanted, ["doc_id", "h"]).dropDuplicates(["doc_id", "h", "node"])
                    .select("node", "text"), "texts", into)

    links = written(verified(likely(shared.where("node <> hub").select(
        F.col("node").alias("a"), F.col("hub").alias("b")).distinct(), nodes), texts)
        .unionByName(same_ids(rows)), "links", into)
    comps = components(links, into)
    rest, alone = able(open_buckets(shared, comps, into), texts, nodes, into)
    more = written(verified(likely(hub_pairs(rest), nodes), texts), "links", into)
    if not more.isEmpty():
        comps = components(stars(comps).unionByName(more), into)
        rest = open_buckets(rest, comps, into)
    more = written(verified(likely(last_pairs(rest, dealt(rest, texts, alone)), nodes), texts), "links", into)
    if not more.isEmpty():
        comps = components(stars(comps).unionByName(more), into)

    # the smallest id of each component, found among its nodes
    named = nodes.select("node", "rep.doc_id").join(comps, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = written(named.join(least, "component").select("node", "component_id"), "components")
    discard(docs.sparkSession, into)
    out = rows.join(named, "node", "left")
    comp = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"),
                      F.coalesce(F.col("doc_id") == comp, F.lit(True)).alias("kept"))


def stars(comps: DataFrame) -> DataFrame:
    """Components as links (a, b) to go on from."""
    return comps.select(F.col("node").alias("a"), F.col("component").alias("b"))


def open_buckets(rows: DataFrame, comps: DataFrame, into: str) -> DataFrame:
    """``rows`` (bucket, node, ...) with their component (comp), of the buckets that hold more
    than one component."""
    keep = [c for c in rows.columns if c not in ("hub", "comp")]
    rows = written(rows.select(*keep).join(comps, "node", "left").select(
        *keep, F.coalesce("component", "node").alias("comp")), "labelled", into)
    return several(rows)


def several(rows: DataFrame) -> DataFrame:
    apart = (rows.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
             .where("low < high").select("bucket"))
    return rows.join(apart, "bucket")


#: What two sets share is at most the smaller c, and a link of similarity j needs j / (1 + j)
#: of both sizes.
MAY_LINK = f"least({{0}}.c, {{1}}.c) * {100 + PERCENT} >= {PERCENT} * ({{0}}.n + {{1}}.n)"


def hub_pairs(rows: DataFrame) -> DataFrame:
    """Each node against its bucket's most typical one (the largest share of shingles that
    others have), where both are apart: no more pairs than rows."""
    hubs = rows.groupBy("bucket").agg(F.max(F.struct(
        (F.col("c") / F.col("n")).alias("share"), "node", "comp", "n", "c")).alias("h"))
    pairs = rows.withColumn("x", F.struct("n", "c")).join(hubs, "bucket").where("comp <> h.comp").where(
        MAY_LINK.format("x", "h"))
    return pairs.select(F.greatest("node", "h.node").alias("a"), F.least("node", "h.node").alias("b")).distinct()


def able(rows: DataFrame, texts: DataFrame, nodes: DataFrame, into: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` of nodes that can still link, with n and the number c of their shingles that
    another open node has as well: a link needs c >= 0.75 n.  Beside it (node, u, alone): how many
    shingles a node has alone, and their groups.  Shingles of one node only are found by a count
    per shingle; nothing is joined back."""
    open_nodes = written(rows.select("node").distinct(), "open", into)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            sets = [shingles(t.as_py()) for t in batch.column(1)]
            node = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
            return {"node": pa.array(node), "s": pa.array(np.concatenate(sets).view(np.int64))}
        return work

    every = per_batch(texts.join(open_nodes, "node").select("node", "text"), "node long, s long", make)
    alone = written(
        every.groupBy("s").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
        .groupBy("node").agg(F.count("*").alias("u"), F.collect_list(F.expr(f"int(s & {GROUPS - 1})")).alias("alone")),
        "alone", into)
    bounds = open_nodes.join(nodes.select("node", "n"), "node").join(alone.select("node", "u"), "node", "left").select(
        "node", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("c")).where(F.col("c") * 100 >= F.col("n") * PERCENT)
    return several(written(rows.join(bounds, "node"), "able", into)), alone


def dealt(rows: DataFrame, texts: DataFrame, alone: DataFrame) -> DataFrame:
    """(node, g): how many of a node's shingles lie in each of ``GROUPS`` groups by hash, without
    those it has alone."""
    wanted = texts.join(rows.select("node").distinct(), "node").join(
        alone.select("node", "alone"), "node", "left").select("node", "text", "alone")

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            g = []
            for text, own in zip(batch.column(1), batch.column(2)):
                at = (shingles(text.as_py()) & np.uint64(GROUPS - 1)).astype(np.int64)
                g.append((np.bincount(at, minlength=GROUPS)
                          - np.bincount(np.array(own.as_py() or [], np.int64), minlength=GROUPS)).astype("<i4").tobytes())
            return {"node": batch.column(0), "g": g}
        return work

    return per_batch(wanted, "node long, g binary", make)


def last_pairs(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs that may link and are apart in a common bucket: the nodes outside a bucket's most
    common component against its other nodes.  Both are dealt into blocks of about ``BLOCK``
    nodes, and a task compares two blocks; only pairs whose groups of shingles allow a link leave
    it (``Blocks``).  A node has at most BANDS buckets; a pair counts in the first that both have."""
    sizes = rows.groupBy("bucket", "comp").agg(F.count("*").alias("k"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("k", "comp")).alias("m"), F.sum("k").alias("size")).select(
        "bucket", F.col("m.comp").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("every"),
        F.ceil((F.col("size") - F.col("m.k")) / BLOCK).cast("int").alias("outside"))
    own = rows.groupBy("node").agg(F.sort_array(F.collect_set("bucket")).alias("all"))
    all_rows = rows.join(main, "bucket").join(own.join(groups, "node"), "node").withColumn(
        "in_main", F.col("comp") == F.col("main"))
    cols = ["bucket", "i", "j", "side", "node", "comp", "in_main", "n", "g", "all"]
    place = F.xxhash64(F.col("node"), F.lit(1))
    first = all_rows.where("NOT in_main").withColumn("side", F.lit(0)).withColumn(
        "i", F.pmod(place, "outside").cast("int")).withColumn("j", F.explode(F.expr("sequence(0, every - 1)")))
    second = all_rows.withColumn("side", F.lit(1)).withColumn(
        "j", F.pmod(place, "every").cast("int")).withColumn("i", F.explode(F.expr("sequence(0, outside - 1)")))
    blocks = first.select(*cols).unionByName(second.select(*cols)).repartition("bucket", "i", "j").sortWithinPartitions(
        "bucket", "i", "j", "side")
    return stream(blocks, "a long, b long", Blocks)


class Blocks:
    """Compares the blocks of one sorted partition.  What two sets share is at most the sum, over
    the groups of shingles, of the smaller count; a link needs j / (1 + j) of both sizes."""

    def __init__(self):
        self.open = None

    def batch(self, batch: pa.RecordBatch):
        table = pa.Table.from_batches([batch])
        if self.open is not None:
            table = pa.concat_tables([self.open, table]).combine_chunks()
        key = np.stack([table.column(c).to_numpy() for c in ("bucket", "i", "j")])
        starts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
        if len(starts):
            yield self.pairs(table.slice(0, starts[-1]), np.append(0, starts))
            table = table.slice(starts[-1])
        self.open = table

    def rest(self):
        if self.open is not None:
            yield self.pairs(self.open, np.array([0, len(self.open)]))

    def pairs(self, table: pa.Table, starts: np.ndarray) -> dict:
        bucket, side, node, comp, n, in_main = (table.column(c).to_numpy() for c in (
            "bucket", "side", "node", "comp", "n", "in_main"))
        g = np.frombuffer(b"".join(table.column("g").to_pylist()), "<i4").reshape(-1, GROUPS)
        buckets = table.column("all").combine_chunks()
        found = []
        for low, high in zip(starts, starts[1:]):
            cut = low + int(np.searchsorted(side[low:high], 1))
            for x in range(low, cut):
                y = np.arange(cut, high)
                y = y[(comp[y] != comp[x]) & (in_main[y] | (node[y] < node[x]))]
                shared = np.minimum(g[y], g[x]).sum(axis=1)
                y = y[shared * (100 + PERCENT) >= PERCENT * (n[y] + n[x])]
                if len(y):
                    mine = set(buckets[x].as_py())
                    found.extend((max(node[x], node[k]), min(node[x], node[k])) for k in y
                                 if next(b for b in buckets[k].as_py() if b in mine) == bucket[x])
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return {"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])}


def same_ids(rows: DataFrame) -> DataFrame:
    """Links (a, b) between the sets of one id that has several."""
    sets = rows.where("node IS NOT NULL").select("doc_id", "node")
    least = sets.groupBy("doc_id").agg(F.min("node").alias("b"), F.max("node").alias("top")).where("b < top")
    return (sets.join(least.select("doc_id", "b"), "doc_id").where("node <> b")
            .select(F.col("node").alias("a"), "b").distinct())


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that are kept, one of each group, with all their columns, whatever their names;
    rows with a null id all stay, and so do different texts of a kept id.  Of rows that repeat id and
    text but differ elsewhere any one stays."""
    kept_id = unused(docs, "_kept_id")
    kept = group(docs, id_col, text_col).where("kept AND doc_id IS NOT NULL").select(
        F.col("doc_id").alias(kept_id)).distinct()
    named = docs.where(F.col(f"`{id_col}`").isNotNull())
    one = (named.join(kept, F.col(f"`{id_col}`").cast("long") == F.col(kept_id), "left_semi")
           .dropDuplicates([id_col, text_col]))
    return one.unionByName(docs.where(F.col(f"`{id_col}`").isNull())).select(*quoted(docs.columns))
