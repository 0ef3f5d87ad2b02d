"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _linked(pairs: DataFrame) -> DataFrame:
    """(u, v) with v no smaller than u's least neighbour: every v joined to that least one.
    The minimum is combined before the shuffle; the join back may be split by AQE."""
    least = pairs.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return pairs.join(least, F.col("u") == F.col("w"))


def _settled(pairs: DataFrame) -> bool:
    """No node has two smaller ones or is both the smaller and the larger: one grouped count."""
    ends = pairs.select(F.col("u").alias("w"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        pairs.select(F.col("v").alias("w"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    counted = ends.groupBy("w").agg((F.sum("up") + F.max("down")).alias("k"))
    return (counted.agg(F.max("k")).first()[0] or 0) <= 1


def components(edges: DataFrame, into: str | None = None, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b) to (node, component): the smallest node reachable, for every node that
    has an edge.  Ends when only stars are left; every round is a written table
    (in the scratch folder ``into``)."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct(), "edges", into)
    for _ in range(max_rounds):
        if _settled(now):
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (_linked(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
                 .where("u <> v").distinct())
        near = _linked(large)
        small = (near.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = written(small, "edges", into)
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
