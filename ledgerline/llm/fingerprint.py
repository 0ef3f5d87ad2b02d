"""Document fingerprints by invertible Bloom lookup sketches, in DataFrame functions only.

A text's paragraphs (lines that are not empty, each once) are hashed to 64-bit digests.  Every
digest enters one cell in each of three subtables: a count, an XOR of digests and an XOR of
check values.  Sketches of two versions subtract cell by cell; what both share vanishes, and
peeling cells that hold one digest recovers the digests that only one version has.  When
peeling gets stuck, it is tried again with sketches four times as large, then with sketches
larger than both paragraph lists: digests are dealt by hash into blocks of about
``BLOCK_KEYS``, each with a sketch of its own, so the work follows the number of lines (times
the root of the number of blocks for dealing them) and not its square.  A block that is stuck
gets a sketch four times as large; a cycle that even this keeps is settled by comparing the
block's lists.  Likeness is 1 - differing / all digests of both.

Documents meet their successor in one pass: ids are cut into ranges, the first row of each
range is also given to the range before (and the very first to the last), and a window looks
one row ahead.  Texts are shuffled once.

Defined cases: null text counts as empty, an empty text has an empty sketch, two empty texts
are alike (1.0); a null id sorts before all others; rows with equal ids follow each other in
the order of their text hashes; a single row is its own successor; an empty table gives an
empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 10  # cells of a subtable of the fingerprint itself
SUBTABLES, ROUNDS = 3, 10
BLOCK_KEYS = 8  # digests of both texts in a block of the largest sketches, on average
RANGES_PER_PARTITION = 4
LOWEST = -(1 << 63)


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs."""
    lines = F.filter(F.split(text, "\n"), lambda p: p != "")
    return F.array_distinct(F.transform(lines, lambda p: F.xxhash64(p)))


def place(digest: Column, table: int, width: Column) -> Column:
    """The cell of a digest in a subtable, from 20 of its bits."""
    return F.pmod(F.shiftrightunsigned(digest, 20 * table).bitwiseAND(F.lit(0xFFFFF)), width)


def check(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit(1))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sketch(keys: Column, width: Column) -> Column:
    """All cells, subtable after subtable: struct(n, k, c)."""
    zero = F.lit(0).cast("long")

    def cell(hit: Column) -> Column:
        return F.struct(F.size(hit).alias("n"),
                        F.aggregate(hit, zero, lambda a, d: a.bitwiseXOR(d)).alias("k"),
                        F.aggregate(hit, zero, lambda a, d: a.bitwiseXOR(check(d))).alias("c"))

    def subtable(j: int) -> Column:
        placed = F.transform(keys, lambda d: F.struct(place(d, j, width).alias("at"), d.alias("k")))
        return let(placed, lambda ps: F.transform(
            F.sequence(F.lit(0).cast("long"), width - 1),
            lambda i: let(F.transform(F.filter(ps, lambda p: p["at"] == i), lambda p: p["k"]), cell)))

    return F.concat(*[subtable(j) for j in range(SUBTABLES)])


def peel(a: Column, b: Column, width: Column) -> Column:
    """Digests of either sketch alone, as struct(k, n) with n = 1 or -1; null when stuck."""
    cells = F.zip_with(a, b, lambda x, y: F.struct(
        (x["n"] - y["n"]).alias("n"), x["k"].bitwiseXOR(y["k"]).alias("k"), x["c"].bitwiseXOR(y["c"]).alias("c")))
    none = F.expr("CAST(array() AS array<struct<k:bigint,n:int>>)")

    def placed(x: Column) -> Column:
        k = x["k"]
        return F.struct(k.alias("k"), x["n"].alias("n"), x["c"].alias("c"), place(k, 0, width).alias("i"),
                        (place(k, 1, width) + width).alias("j"), (place(k, 2, width) + 2 * width).alias("l"))

    def step(state: Column, _: Column) -> Column:
        pure = F.array_distinct(F.transform(
            F.filter(state["cells"], lambda x: ((x["n"] == 1) | (x["n"] == -1)) & (check(x["k"]) == x["c"])),
            placed))

        def taken(found: Column) -> Column:
            left = F.when(F.size(found) == 0, state["cells"]).otherwise(F.transform(
                state["cells"], lambda x, i: F.aggregate(
                    F.filter(found, lambda p: (p["i"] == i) | (p["j"] == i) | (p["l"] == i)), x,
                    lambda acc, p: F.struct((acc["n"] - p["n"]).alias("n"), acc["k"].bitwiseXOR(p["k"]).alias("k"),
                                            acc["c"].bitwiseXOR(p["c"]).alias("c")))))
            new = F.transform(found, lambda p: F.struct(p["k"].alias("k"), p["n"].alias("n")))
            return F.struct(left.alias("cells"), F.concat(state["found"], new).alias("found"))

        return let(pure, taken)

    def finish(state: Column) -> Column:
        clean = F.forall(state["cells"], lambda x: (x["n"] == 0) & (x["k"] == 0) & (x["c"] == 0))
        return F.when(clean, state["found"])

    start = F.struct(cells.alias("cells"), none.alias("found"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, finish)


def lists_differ(a: Column, b: Column) -> Column:
    return F.size(F.array_except(a, b)) + F.size(F.array_except(b, a))


def peeled(a: Column, b: Column, width: int) -> Column:
    """Number of digests in one list only, from sketches of both; null when stuck."""
    w = F.lit(width).cast("long")
    n = F.size(peel(sketch(a, w), sketch(b, w), w))
    return F.when(n >= 0, n)


def in_blocks(a: Column, b: Column, width: int = WIDTH) -> Column:
    """Number of digests in one list only, block by block.  Digests are dealt in two steps, into
    about the root of the number of blocks each time."""
    blocks = F.floor((F.size(a) + F.size(b)) / BLOCK_KEYS) + 1
    side = F.ceil(F.sqrt(blocks)).cast("long")
    none = F.lit(0).cast("long")

    def numbers(last: Column) -> Column:
        return F.sequence(none, last - 1)

    def total(values: Column) -> Column:
        return F.aggregate(values, none, lambda x, y: x + y)

    def one(x: Column, y: Column) -> Column:
        return F.coalesce(peeled(x, y, width), peeled(x, y, 4 * width), lists_differ(x, y)).cast("long")

    def dealt(keys: Column, n: Column) -> Column:
        def placed(d: Column) -> Column:
            at = F.pmod(F.xxhash64(d, F.lit(2)), n * n)
            return F.struct(F.floor(at / n).alias("i"), F.pmod(at, n).alias("j"), d.alias("k"))

        return F.transform(keys, placed)

    def of(rows: Column, name: str, i: Column) -> Column:
        return F.filter(rows, lambda r: r[name] == i)

    def cell(rows: Column, j: Column) -> Column:
        return F.transform(of(rows, "j", j), lambda r: r["k"])

    def rest(n: Column) -> Column:
        both = F.struct(dealt(a, n).alias("a"), dealt(b, n).alias("b"))
        return let(both, lambda ab: total(F.transform(numbers(n), lambda i: let(
            F.struct(of(ab["a"], "i", i).alias("a"), of(ab["b"], "i", i).alias("b")),
            lambda part: total(F.transform(numbers(n), lambda j: let(
                F.struct(cell(part["a"], j).alias("a"), cell(part["b"], j).alias("b")),
                lambda c: one(c["a"], c["b"]))))))))

    return let(side, rest)


def differing(a: Column, keys_a: Column, b: Column, keys_b: Column, width: int = WIDTH) -> Column:
    """Number of digests in one text only: from the fingerprints, from larger sketches of both
    texts on failure, at last from sketches in blocks."""
    small = F.lit(width).cast("long")
    both = F.size(keys_a) + F.size(keys_b)
    fits = F.abs(F.size(keys_a) - F.size(keys_b)) <= SUBTABLES * width
    first = F.when(fits, F.size(peel(a, b, small)))
    second = F.when(both <= 8 * SUBTABLES * width, peeled(keys_a, keys_b, 4 * width))
    same = F.when(F.sort_array(keys_a) == F.sort_array(keys_b), F.lit(0)).otherwise(lists_differ(keys_a, keys_b))
    return F.when(a == b, same).otherwise(
        F.coalesce(F.when(first >= 0, first), second, in_blocks(keys_a, keys_b, width)))


def likeness(number: Column, keys_a: Column, keys_b: Column) -> Column:
    both = F.size(keys_a) + F.size(keys_b)
    return F.when(both == 0, F.lit(1.0)).otherwise(1.0 - number.cast("double") / both)


def as_text(cells: Column) -> Column:
    """Cells as text, hexadecimal: eight digits of the count, sixteen of the XOR of digests,
    sixteen of the XOR of check values."""
    return F.array_join(F.transform(cells, lambda x: F.concat(
        F.lpad(F.hex(x["n"].cast("long")), 8, "0"), F.lpad(F.hex(x["k"]), 16, "0"),
        F.lpad(F.hex(x["c"]), 16, "0"))), "")


def in_ranges(docs: DataFrame, key: str, ranges: int) -> tuple[Column, list[tuple[int, int]]]:
    """A range number for every row, and (range, smallest key) of the ranges that have rows."""
    cuts = sorted(set(docs.select(F.percentile_approx(
        key, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] or [])) if ranges > 1 else []
    group = max(1, math.isqrt(len(cuts)))

    def literal(values: list[int]) -> Column:
        return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

    if cuts:  # two short searches instead of one long one
        coarse = F.size(F.filter(literal(cuts[::group]), lambda c: c <= F.col(key)))
        fine = F.size(F.filter(F.slice(literal(cuts), F.greatest(coarse - 1, F.lit(0)) * group + 1, F.lit(group)),
                               lambda c: c <= F.col(key)))
        number = F.when(coarse == 0, 0).otherwise((coarse - 1) * group + fine)
    else:
        number = F.lit(0)
    rows = docs.groupBy(number.alias("r")).agg(F.min(key).alias("k")).orderBy("r").collect()  # a row a range
    return number, [(r["r"], r["k"]) for r in rows]


def with_next(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Columns doc_id, text, keys, cells and those of the next document, next_*."""
    spark = docs.sparkSession
    ranges = ranges or RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = docs.withColumn("_k", F.coalesce("doc_id", F.lit(LOWEST)))
    number, firsts = in_ranges(src.select("_k"), "_k", ranges)
    src = src.withColumn("_r", number)
    if firsts:
        before = dict(zip([r for r, _ in firsts], [firsts[-1][0], *[r for r, _ in firsts]]))
        numbers = [before.get(r, -1) for r in range(firsts[-1][0] + 1)]
        smallest = dict(firsts)
        keys = [smallest.get(r, LOWEST) for r in range(firsts[-1][0] + 1)]
        text = lambda v: F.split(F.lit(",".join(map(str, v))), ",").cast("array<bigint>")
        here = (F.col("_r") + 1).cast("int")
        first = F.col("_k") == F.element_at(text(keys), here)
        wraps = (F.col("_r") == firsts[0][0]).cast("int")
        own = F.struct(F.col("_r").cast("long").alias("r"), F.lit(0).alias("wrap"), F.lit(False).alias("copy"))
        copy = F.struct(F.element_at(text(numbers), here).alias("r"), wraps.alias("wrap"), F.lit(True).alias("copy"))
        src = src.withColumn("_to", F.explode(F.when(first, F.array(own, copy)).otherwise(F.array(own))))
    else:
        src = src.withColumn("_to", F.struct(F.lit(0).cast("long").alias("r"), F.lit(0).alias("wrap"),
                                             F.lit(False).alias("copy")))
    dealt = src.select("doc_id", "text", "_k", F.col("_to.r").alias("_range"), F.col("_to.wrap").alias("_wrap"),
                       F.col("_to.copy").alias("_copy")).repartition("_range")
    sketched = dealt.withColumn("keys", digests(F.col("text"))).withColumn(
        "cells", sketch(F.col("keys"), F.lit(WIDTH).cast("long")))
    ahead = Window.partitionBy("_range").orderBy("_wrap", "_k", F.xxhash64("text"), "_copy")
    for c in ("text", "keys", "cells"):
        sketched = sketched.withColumn(f"next_{c}", F.lead(c).over(ahead))
    return sketched.where(~F.col("_copy")).drop("_k", "_range", "_wrap", "_copy")


def compare(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited form, with both likenesses."""
    src = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    d = with_next(src).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substring("text", 1, F.col("n_chars").cast("int") - half),
                                        F.substring("next_text", 1, half)))
    d = d.withColumn("edited_keys", digests(F.col("edited"))).withColumn(
        "edited_cells", sketch(F.col("edited_keys"), F.lit(WIDTH).cast("long")))
    c = {n: F.col(n) for n in d.columns}
    return d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text(c["cells"]).alias("fingerprint"), as_text(c["edited_cells"]).alias("edited_fingerprint"),
        likeness(differing(c["cells"], c["keys"], c["edited_cells"], c["edited_keys"]),
                 c["keys"], c["edited_keys"]).alias("near_edited"),
        likeness(differing(c["cells"], c["keys"], c["next_cells"], c["next_keys"]),
                 c["keys"], c["next_keys"]).alias("near_next"))
