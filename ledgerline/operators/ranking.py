"""Exact NTILE over a whole table without sorting it or funnelling it into one task.

``NTILE(n) OVER (ORDER BY value, id)`` only needs the n - 1 rows that end a
tile.  They are selected, not sorted for.  A row's place in the order is
decided by a few non-null keys (is the value NULL, the value, is the id
NULL, the id).  Key by key, approximate percentiles give candidates around
each wanted place and one count per candidate tells which of them it is or
which two it lies between; rows outside drop out.  As soon as few rows are
left around a place they are fetched and the row is read off.  Every job is
one aggregate over (id, values); the driver gets at most ``FETCH`` rows a cut.
A row's tile is then a comparison with the cuts: no shuffle of the rows, no
checkpoint and no join back.

Cuts follow from the rows alone, so recomputed partitions change nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows around a cut that may be fetched, and the accuracy of the percentiles.
FETCH = 4096
ACCURACY = 10_000


@dataclass
class Order:
    """One NTILE: its column, the value it ranks by, and whether from the largest down.  NULL counts
    as the largest value; ties go by ascending id (a NULL id first)."""
    out_col: str
    value: str
    descending: bool = False


def tile_ends(rows: int, n: int) -> list[int]:
    """Places of the last row of tiles 1 to n - 1 (-1: none before): the first ``rows % n`` tiles
    hold one row more."""
    size, longer = divmod(rows, n)
    return [k * size + min(k, longer) - 1 for k in range(1, n)]


def _keys(df: DataFrame, order: Order, id_col: str, null_values: bool, null_ids: bool) -> list[Column]:
    """Ascending keys, none of them NULL, that put the rows in order."""
    types = {f.name: f.dataType for f in df.schema.fields}
    value, ident = F.col(order.value), F.col(id_col)
    keys = [F.coalesce(-value if order.descending else value, F.lit(0).cast(types[order.value]))]
    if null_values:
        keys.insert(0, F.when(value.isNull() == F.lit(order.descending), 0).otherwise(1))
    if null_ids:
        keys.append(F.when(ident.isNull(), 0).otherwise(1))
    return [*keys, F.coalesce(ident, F.lit(0).cast(types[id_col]))]


@dataclass
class _Cut:
    """The row at ``place`` among ``inside`` rows: those with ``fixed`` first keys and the next key
    between ``low`` and ``high`` (exclusive)."""
    keys: list[Column]
    place: int
    inside: int
    fixed: list = field(default_factory=list)
    low: object = None
    high: object = None
    stuck: bool = False

    @property
    def done(self) -> bool:
        return len(self.fixed) == len(self.keys)

    @property
    def key(self) -> Column:
        return self.keys[len(self.fixed)]

    def rows(self) -> Column:
        keep = F.lit(True)
        for key, value in zip(self.keys, self.fixed):
            keep &= key == F.lit(value)
        if self.low is not None:
            keep &= self.key > F.lit(self.low)
        if self.high is not None:
            keep &= self.key < F.lit(self.high)
        return keep

    def holds(self, row: tuple) -> bool:
        at = len(self.fixed)
        return (list(row[:at]) == self.fixed and (self.low is None or row[at] > self.low)
                and (self.high is None or row[at] < self.high))

    def narrow(self, counted: list[tuple[object, int, int]]) -> None:
        """Take in candidates, ascending, each with the rows below it and equal to it."""
        start, end, before = 0, self.inside, (self.low, self.high)
        for value, less, same in counted:
            if less <= self.place < less + same:
                self.fixed.append(value)
                self.low = self.high = None
                self.place, self.inside = self.place - less, same
                return
            if less + same <= self.place:
                self.low, start = value, less + same
            else:
                self.high, end = value, less
                break
        self.place, self.inside = self.place - start, end - start
        self.stuck = (self.low, self.high) == before  # keys that a double cannot tell apart


def _shares(place: float) -> list[float]:
    width = 2 / ACCURACY
    return [max(0.0, place - width), place, min(1.0, place + width)]


def _count(rows: DataFrame, cuts: list[_Cut], near: list) -> None:
    """One job: the candidates' counts, which narrow every cut."""
    asked = [(i, v) for i, found in enumerate(near) for v in sorted(set(found))]
    counts = []
    for i, v in asked:
        counts += [F.count_if(cuts[i].rows() & (cuts[i].key < F.lit(v))),
                   F.count_if(cuts[i].rows() & (cuts[i].key == F.lit(v)))]
    got = rows.agg(*[c.alias(f"n{j}") for j, c in enumerate(counts)]).first()
    for i, cut in enumerate(cuts):
        cut.narrow([(v, got[2 * j], got[2 * j + 1]) for j, (of, v) in enumerate(asked) if of == i])


def _candidates(rows: DataFrame, cuts: list[_Cut]) -> list:
    return list(rows.agg(*[
        F.percentile_approx(F.when(c.rows(), c.key), _shares((c.place + 0.5) / c.inside), ACCURACY).alias(f"c{i}")
        for i, c in enumerate(cuts)]).first())


def _fetch(rows: DataFrame, cuts: list[_Cut]) -> None:
    """One job: the few rows around the cuts of all orders."""
    keep, all_keys, starts = F.lit(False), [], {}
    for cut in cuts:
        keep |= cut.rows()
        if id(cut.keys) not in starts:
            starts[id(cut.keys)] = len(all_keys)
            all_keys += cut.keys
    found = [tuple(r) for r in rows.where(keep).select(
        *[k.alias(f"k{i}") for i, k in enumerate(all_keys)]).collect()]
    for cut in cuts:
        at = starts[id(cut.keys)]
        own = sorted(r[at:at + len(cut.keys)] for r in found)
        cut.fixed = list([r for r in own if cut.holds(r)][cut.place])


def find_cuts(df: DataFrame, id_col: str, n: int, orders: Sequence[Order],
              fetch: int = FETCH) -> dict[str, tuple[list[Column], list[list]]]:
    """Per order its keys and, as key values, the last rows of tiles 1 to n - 1."""
    rows = df.select(id_col, *sorted({o.value for o in orders})).persist()
    try:
        # counts, and the first candidates as if there were no NULL
        plain = [_keys(df, o, id_col, False, False)[0] for o in orders]
        first = rows.agg(
            F.count(F.lit(1)).alias("n"), F.count(id_col).alias("i"),
            *[F.count(o.value).alias(f"v{k}") for k, o in enumerate(orders)],
            *[F.percentile_approx(key, [s for t in range(1, n) for s in _shares(t / n)], ACCURACY).alias(f"c{k}")
              for k, key in enumerate(plain) if n > 1]).first()
        total = first["n"]
        keys, cuts, near = {}, {}, []
        for k, o in enumerate(orders):
            null_values, null_ids = first[f"v{k}"] < total, first["i"] < total
            keys[o.out_col] = _keys(df, o, id_col, null_values, null_ids)
            cuts[o.out_col] = []
            for t, at in enumerate(tile_ends(total, n)):
                if at >= 0:
                    cuts[o.out_col].append(_Cut(keys[o.out_col], at, total))
                    near.append(None if null_values else first[f"c{k}"][3 * t:3 * t + 3])
        every = [c for of_order in cuts.values() for c in of_order]
        if total > fetch:
            known = [(c, v) for c, v in zip(every, near) if v is not None]
            if known:
                _count(rows, [c for c, _ in known], [v for _, v in known])
        while wide := [c for c in every if not c.done and not c.stuck and c.inside > fetch]:
            _count(rows, wide, _candidates(rows, wide))
        if few := [c for c in every if not c.done and not c.stuck]:
            _fetch(rows, few)
        for cut in every:
            if not cut.done:
                rest = [k.alias(f"k{i}") for i, k in enumerate(cut.keys)]
                row = rows.where(cut.rows()).select(*rest).orderBy(*[f"k{i}" for i in range(len(rest))])
                cut.fixed = list(row.offset(cut.place).limit(1).first())
        return {o.out_col: (keys[o.out_col], [c.fixed for c in cuts[o.out_col]]) for o in orders}
    finally:
        rows.unpersist()


def tile(keys: list[Column], cuts: list[list]) -> Column:
    """1 + the number of cuts before the row."""
    out = F.lit(1)
    for cut in cuts:
        after = F.lit(False)
        for key, value in list(zip(keys, cut))[::-1]:
            after = (key > F.lit(value)) | ((key == F.lit(value)) & after)
        out = out + F.when(after, 1).otherwise(0)
    return out.cast("int")


def with_ntiles(df: DataFrame, id_col: str, n: int, orders: Sequence[Order], fetch: int = FETCH) -> DataFrame:
    """``df`` (one row per id) with the NTILE of each order."""
    found = find_cuts(df, id_col, n, orders, fetch)
    return df.withColumns({o.out_col: tile(*found[o.out_col]) for o in orders})


def with_ntile_single_task(df: DataFrame, n: int, order: Sequence[Column],
                           out_col: str) -> DataFrame:
    """Plain window NTILE (one task); kept as the reference for tests."""
    return df.withColumn(out_col, F.ntile(n).over(Window.orderBy(*order)))
