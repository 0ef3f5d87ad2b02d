"""Exact sets of whole-number keys, kept as rows that merge.

A set is a frame of (``by`` columns, ``bucket``, ``places``): key ``k`` lies in
bucket ``k >> 15`` at place ``k & 32767``, so a row holds at most 32,768
places (about two bytes a key when stored, and one row for a run of
neighbouring keys).  Sets of parts of the data union, subtract and
intersect bucket by bucket, exactly, without touching the data; NULL is
never a member.  Every aggregate is partial before its shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PLACE_BITS = 15
BUCKET, PLACES = "bucket", "places"


def _key(name: str) -> Column:
    return (F.shiftleft(F.col(BUCKET), PLACE_BITS).bitwiseOR(F.col("_place").cast("long"))).alias(name)


def key_sets(rows: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The set of ``key``'s values, one set per value of ``by``."""
    k = F.col(key).cast("long")
    return (rows.where(k.isNotNull())
            .groupBy(*by, F.shiftright(k, PLACE_BITS).alias(BUCKET))
            .agg(F.sort_array(F.collect_set(k.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int"))).alias(PLACES)))


def union(sets: DataFrame) -> DataFrame:
    """One set of all sets."""
    return sets.groupBy(BUCKET).agg(F.array_distinct(F.flatten(F.collect_list(PLACES))).alias(PLACES))


def keys(sets: DataFrame, key: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The members as rows."""
    return sets.select(*by, BUCKET, F.explode(PLACES).alias("_place")).select(*by, _key(key))


def minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Members of ``left`` that ``right`` lacks (neither has ``by`` columns)."""
    r = right.select(BUCKET, F.col(PLACES).alias("_other"))
    rest = F.array_except(PLACES, F.coalesce("_other", F.array().cast("array<int>")))
    return left.join(r, BUCKET, "left").select(BUCKET, rest.alias(PLACES)).where(F.size(PLACES) > 0)


def overlap(left: DataFrame, right: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Members of ``left`` (no ``by`` columns) that each of ``right``'s sets holds."""
    r = right.select(*by, BUCKET, F.col(PLACES).alias("_other"))
    both = F.array_intersect(PLACES, "_other")
    return left.join(r, BUCKET).select(*by, BUCKET, both.alias(PLACES)).where(F.size(PLACES) > 0)
