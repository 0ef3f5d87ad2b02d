"""Hot-key-safe fact -> dimension left join.

A key may hold a large share of the fact (one product in a third of all
orders, or the NULL key of orders without a product).  A plain shuffle
join sends all of its rows to one task; AQE can split such a partition
only when both join inputs are fresh shuffle stages, which depends on
the plan around the join.  This join splits hot keys explicitly:

1. which keys are hot is known before the query: a load keeps one sketch of
   the most frequent keys a column (``key_sketch``, one pass with map-side
   merging) and the build reads it from the manifest.  A query itself
   runs no job to find out; without statistics only NULL is dealt out and
   the rest is left to AQE;
2. a key that holds more rows than a shuffle partition's share is dealt
   over ``ceil(share * shuffle partitions)`` buckets by a hash of the row;
   the NULL key, which never matches, over all shuffle partitions;
3. dimension rows of hot keys are repeated once a bucket;
4. one join on (key, bucket).  Whether its dimension is broadcast is left
   to Spark's statistics and AQE; there is one plan whatever the size.

The result is exactly ``fact LEFT JOIN dim USING (key)``, whatever the
statistics say: stale ones cost balance, never rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 0.01
#: Items a sketch tracks: its counts are off by a few 10,000ths of the rows at most.
TRACKED = 10_000
_SALT = "_skew_salt"
_ROWS = "n_rows"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_sketch(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_rows`` and, per key column, a mergeable sketch of its most frequent values."""
    return rows.agg(F.count(F.lit(1)).alias(_ROWS),
                    *[F.expr(f"approx_top_k_accumulate(`{k}`, {TRACKED})").alias(k) for k in keys])


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """The sketch of all rows, from the sketches (one a row) of their parts."""
    keys = [c for c in sketches.columns if c != _ROWS]
    return sketches.agg(F.sum(_ROWS).alias(_ROWS),
                        *[F.expr(f"approx_top_k_combine(`{k}`, {TRACKED})").alias(k) for k in keys])


def hot_keys(sketch: DataFrame, hot_share: float = HOT_SHARE) -> dict:
    """``{"n_rows": n, "keys": {column: [[value, rows], ...]}}`` of the keys holding at least
    ``hot_share`` of the rows: at most ``1 / hot_share`` a column."""
    keys = [c for c in sketch.columns if c != _ROWS]
    most = math.ceil(1 / hot_share)
    row = sketch.select(_ROWS, *[F.expr(f"approx_top_k_estimate(`{k}`, {most})").alias(k) for k in keys]).first()
    return {_ROWS: row[_ROWS],
            "keys": {k: [[v, n] for v, n in row[k] if v is not None and n >= hot_share * row[_ROWS]]
                     for k in keys}}


def buckets(hot: dict | None, key: str, partitions: int) -> dict:
    """{key value: bucket count} of the keys that hold more than one shuffle partition's share."""
    if not hot or not hot[_ROWS]:
        return {}
    dealt = {v: math.ceil(n / hot[_ROWS] * partitions) for v, n in hot["keys"].get(key, ())}
    return {v: n for v, n in dealt.items() if n > 1}


def left_join_dimension(fact: DataFrame, dim: DataFrame, key: str, hot: dict | None = None) -> DataFrame:
    """``fact LEFT JOIN dim USING (key)`` with hot keys spread over tasks.

    ``dim`` holds the key plus the attributes to add (no other column
    names in common with ``fact``).  ``hot`` is what ``hot_keys`` gave for
    the fact's rows; no job runs here.
    """
    attrs = [c for c in dim.columns if c != key]
    dealt = buckets(hot, key, _partitions(fact))
    k = F.col(key)

    def by_key(value) -> Column:  # at most 1 / hot_share branches
        out = F.lit(0)
        for v, n in sorted(dealt.items()):
            out = F.when(k == F.lit(v), value(n)).otherwise(out)
        return out

    row = F.xxhash64(*[F.col(f"`{c}`") for c in fact.columns])
    salt = F.when(k.isNull(), F.pmod(row, F.lit(_partitions(fact)))).otherwise(
        by_key(lambda n: F.pmod(row, F.lit(n))))
    f = fact.withColumn(_SALT, salt.cast("int"))
    d = dim.withColumn(_SALT, F.explode(F.sequence(F.lit(0), by_key(lambda n: F.lit(n - 1)))))
    return f.join(d, [key, _SALT], "left").select(*fact.columns, *attrs)
