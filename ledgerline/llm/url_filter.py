"""URL filters by a Bloom filter cascade, in DataFrame functions only.

A rule is host plus path prefix and holds for the host and its subdomains.  A URL's candidate
keys are its host suffixes joined with its path prefixes of the lengths that rules have; the
longest listed one decides.  Membership is asked of a cascade: level 1 encodes the listed keys,
level 2 the other keys of the corpus that pass level 1, level 3 the listed keys that pass level
2, and so on until no key of the corpus is judged wrongly.  Over the corpus's complete key
universe that is exact, and scoring is a map over the scan with the filters as literals: no join.

A second cascade tells blocking rules from allowing ones.  Filter sizes follow the number of
rules (log2 of keys to rules bits each), not the corpus.  Beyond ``MAX_FILTER_BYTES`` the same
candidate keys are matched by a shuffled semi-join instead.

Defined cases: a null url, or one without ``://``, has empty host and path, so no rule of a
named host fits it; no rule fits: rule null, and the cascade's verdict on a key that is not
listed, ``allow``; duplicate rules count once, a key both allowed and blocked is blocked;
repeated rows are judged each; empty tables give empty tables; only url and id are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block")]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_FILTER_BYTES = 32 << 20
LATER_RATE = 0.5


def host_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def candidate_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """Host suffixes by path prefixes of the given lengths, longest key first."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in lengths]),
                        lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(
        prefixes, lambda p: F.struct((F.length(s) + F.length(p)).alias("n"), F.length(s).alias("h"),
                                     F.concat(s, p).alias("key")))))
    return F.transform(F.sort_array(keys, asc=False), lambda k: k["key"])


@dataclass
class Level:
    bits: int
    hashes: int
    words: list[int]


def positions(h: Column, level_bits: int, hashes: int) -> list[Column]:
    """Bit numbers from the two halves of one 64-bit hash."""
    low, step = h.bitwiseAND(F.lit(0x7FFFFFFF)), F.shiftrightunsigned(h, 33).bitwiseOR(F.lit(1))
    return [F.pmod(low + step * F.lit(j), F.lit(level_bits).cast("long")) for j in range(hashes)]


def key_hash(key: Column, seed: int) -> Column:
    return F.xxhash64(key, F.lit(seed))


def contains(key: Column, seed: int, level: Level) -> Column:
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")

    def test(h: Column) -> Column:
        hit = F.lit(True)
        for p in positions(h, level.bits, level.hashes):
            word = F.element_at(words, (F.shiftright(p, 6) + 1).cast("int"))
            hit = hit & (F.bit_get(word, F.pmod(p, F.lit(64)).cast("int")) == 1)
        return hit

    return F.element_at(F.transform(F.array(key_hash(key, seed)), test), 1)  # hashes the key once


def build_level(keys: DataFrame, seed: int, count: int, rate: float) -> Level:
    """Bits of all keys, set in parallel and merged by OR; ``count`` bounds what is collected."""
    bits = max(64, math.ceil(count * math.log(1 / rate) / math.log(2) ** 2 / 64) * 64)
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    if bits // 8 > MAX_FILTER_BYTES:
        raise OverflowError("filter beyond its size bound")
    at = keys.select(F.explode(F.array(*positions(key_hash(F.col("key"), seed), bits, hashes))).alias("p"))
    rows = at.groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                 F.pmod("p", F.lit(64)).cast("int"))).alias("b"))
    words = [0] * (bits // 64)
    for r in rows.collect():  # at most bits / 64 rows
        words[r["w"]] = r["b"]
    return Level(bits, hashes, words)


class Cascade:
    """Exact membership of keys of a universe in a listed set."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def member(self, key: Column) -> Column:
        """A key that fails an odd level is out, one that fails an even level is in; one that
        passes all belongs to the side that the last level encodes."""
        found = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            found = F.when(contains(key, i + 1, self.levels[i]), found).otherwise(F.lit(i % 2 == 1))
        return found


def build(listed: DataFrame, universe: DataFrame, name: str) -> Cascade:
    """``listed`` and ``universe`` have one column ``key``; the universe may repeat keys."""
    listed = written(listed.distinct(), f"{name}-listed")
    n = listed.count()
    if n == 0:
        return Cascade([])
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    levels = [build_level(listed, 1, n, min(0.5, max(n / max(size, 1), 1e-9)))]
    wrong = universe.where(contains(F.col("key"), 1, levels[0])).distinct().join(listed, "key", "left_anti")
    wrong = written(wrong, f"{name}-level1")  # about as many as there are listed keys
    inside, outside, count = listed, wrong, wrong.count()
    while count:
        i = len(levels) + 1
        levels.append(build_level(outside, i, count, LATER_RATE / 4))
        inside, outside = outside, written(
            inside.where(contains(F.col("key"), i, levels[-1])), f"{name}-level{i}")
        count = outside.count()
    return Cascade(levels)


def judge(pages: DataFrame, rules: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """id, host, path, rule and verdict of every row.  ``rules``: columns rule, verdict."""
    spark = pages.sparkSession
    rules = rules if rules is not None else spark.createDataFrame(RULES, "rule string, verdict string")
    rules = rules.where("rule is not null").select(F.col("rule").alias("key"), "verdict")
    slash = F.instr("key", "/")
    path_length = F.when(slash > 0, F.length("key") - slash + 1).otherwise(0)
    lengths = sorted(r[0] for r in rules.select(path_length).distinct().collect())  # path lengths only
    host, path = host_path(F.col(f"`{url_col}`"))
    src = pages.select(F.col(f"`{id_col}`").alias("page_id"), host.alias("host"), path.alias("path"))
    if not lengths:
        return src.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keys = candidate_keys(F.col("host"), F.col("path"), lengths)
    universe = src.select(F.explode(keys).alias("key"))
    blocked = rules.where("verdict = 'block'").select("key")
    try:
        listed = build(rules.select("key"), universe, "urls")
        blocking = build(blocked, rules.select("key"), "blocking")
    except OverflowError:
        return judge_by_join(src, keys, rules)
    rule = F.try_element_at(F.filter(keys, listed.member), F.lit(1))
    return src.withColumn("rule", rule).withColumn(
        "verdict", F.when(F.col("rule").isNotNull() & blocking.member(F.col("rule")), "block")
        .otherwise("allow"))


def judge_by_join(src: DataFrame, keys: Column, rules: DataFrame) -> DataFrame:
    """The way for lists beyond the size bound: candidate keys shuffled to the rules."""
    one = rules.groupBy("key").agg(F.max("verdict").alias("verdict"))  # block sorts after allow
    tagged = src.withColumn("_row", F.struct("page_id", "host", "path"))
    hits = (tagged.select("_row", F.posexplode(keys).alias("_at", "key")).join(one, "key")
            .groupBy("_row").agg(F.min_by("key", "_at").alias("rule"), F.min_by("verdict", "_at").alias("verdict")))
    return (tagged.join(hits.withColumnRenamed("_row", "_hit"), F.col("_row").eqNullSafe(F.col("_hit")), "left")
            .select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")))
