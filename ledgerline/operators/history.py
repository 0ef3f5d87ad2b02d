"""Slowly changing dimension, type 2 (full change history by key).

A run compares the source with the *open* versions only (``valid_to`` is
NULL), by key, in one full outer join:

* key without an open version        -> new open version (also revives a
  key that was deleted earlier);
* changed                           -> old version closed at the new
  version's ``dbt_updated_at``, new open version added;
* unchanged                         -> nothing;
* open version without a source row -> closed at the run time (hard
  delete), when ``invalidate_hard_deletes``;
* NULL key (matches nothing, as in SQL) -> its open version is closed and
  the source row is inserted as new.

Changed means ``valid_from < source.updated_at`` (timestamp strategy) or
any check column differing, NULL-aware (check strategy).  Closed history
is never touched, so a writer can keep it append-only and rewrite the
open versions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_ts_col

SCD_ID, UPDATED, VALID_FROM, VALID_TO = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from",
                                         "dbt_valid_to")
META = [SCD_ID, UPDATED, VALID_FROM, VALID_TO]


def scd_id(key: Column, version_ts: Column) -> Column:
    """md5 of 'key|version' with NULL parts as empty strings."""
    empty = F.lit("")
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), empty),
                             F.coalesce(version_ts.cast("string"), empty)))


_SALT, _HERE = "_scd_salt", "_scd_here"


def _tagged(df: DataFrame, key: str) -> DataFrame:
    """Adds a presence mark (a row with a NULL key is present as well) and
    a salt: NULL keys never match, so a row hash spreads them over as many
    join groups as there are shuffle partitions."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(n))
    return df.withColumn(_SALT, F.when(F.col(key).isNull(), rows).otherwise(0)).withColumn(
        _HERE, F.lit(True))


def _joined(history_open: DataFrame, source: DataFrame, key: str, keys_not_null: bool = False):
    """Full outer join by key; (rows, open version present, source row present).

    ``keys_not_null`` (a gate has said so) leaves the salt out: a history bucketed by key is then
    joined as it lies, and only the source is exchanged."""
    h, s = _tagged(history_open, key).alias("_h"), _tagged(source, key).alias("_s")
    on = F.col(f"_h.{key}") == F.col(f"_s.{key}")
    if not keys_not_null:
        on = on & (F.col(f"_h.{_SALT}") == F.col(f"_s.{_SALT}"))
    j = h.join(s, on, "full_outer")
    return j, F.col(f"_h.{_HERE}").isNotNull(), F.col(f"_s.{_HERE}").isNotNull()


def _version_ts(source_alias: str, strategy: str, updated_at: str, run_ts: Column) -> Column:
    if strategy == "timestamp":
        return F.col(f"{source_alias}.{updated_at}").cast("timestamp_ntz")
    if strategy == "check":
        return run_ts
    raise ValueError(f"unknown strategy {strategy!r}")


def _changed(strategy: str, updated_at: str, check_cols: Sequence[str]) -> Column:
    if strategy == "timestamp":
        return F.col(f"_h.{VALID_FROM}") < F.col(f"_s.{updated_at}").cast("timestamp_ntz")
    cond = F.lit(False)
    for c in check_cols:
        cond = cond | ~F.col(f"_h.{c}").eqNullSafe(F.col(f"_s.{c}"))
    return cond


def snapshot(source: DataFrame, history: DataFrame | None, key: str, strategy: str,
             run_ts, updated_at: str = "updated_at",
             check_cols: Sequence[str] = (), invalidate_hard_deletes: bool = True,
             keys_not_null: bool = False, only_open: bool = False) -> DataFrame:
    """Return the full history after one snapshot run.  ``only_open``: ``history`` holds open
    versions alone, so it is not looked through for closed ones."""
    run = as_ts_col(run_ts)
    cols = source.columns
    s = source.alias("_s")
    if history is None:
        v = _version_ts("_s", strategy, updated_at, run)
        return s.select(*[F.col(f"_s.{c}") for c in cols],
                        scd_id(F.col(f"_s.{key}"), v).alias(SCD_ID),
                        v.alias(UPDATED), v.alias(VALID_FROM),
                        F.lit(None).cast("timestamp_ntz").alias(VALID_TO))

    is_open = F.col(VALID_TO).isNull()
    j, has_h, has_s = _joined(history if only_open else history.where(is_open), source, key, keys_not_null)
    changed = has_h & has_s & _changed(strategy, updated_at, check_cols)
    v = _version_ts("_s", strategy, updated_at, run)

    deleted = (~has_s) if invalidate_hard_deletes else F.lit(False)
    new_to = (F.when(deleted, run).when(changed, v).otherwise(F.col(f"_h.{VALID_TO}")))
    existing = F.struct(*[F.col(f"_h.{c}").alias(c) for c in cols],
                        F.col(f"_h.{SCD_ID}").alias(SCD_ID), F.col(f"_h.{UPDATED}").alias(UPDATED),
                        F.col(f"_h.{VALID_FROM}").alias(VALID_FROM), new_to.alias(VALID_TO))
    fresh = F.struct(*[F.col(f"_s.{c}").alias(c) for c in cols],
                     scd_id(F.col(f"_s.{key}"), v).alias(SCD_ID),
                     v.alias(UPDATED), v.alias(VALID_FROM),
                     F.lit(None).cast("timestamp_ntz").alias(VALID_TO))
    # each joined row yields the kept/closed open version and/or the new
    # version: one pass over the join instead of one per output branch
    out = F.filter(F.array(F.when(has_h, existing),
                           F.when(has_s & (~has_h | F.coalesce(changed, F.lit(False))), fresh)),
                   lambda x: x.isNotNull())
    merged = j.select(F.explode(out).alias("_v")).select("_v.*")
    return merged if only_open else history.where(~is_open).unionByName(merged)


def change_summary(source: DataFrame, history: DataFrame, key: str, strategy: str,
                   updated_at: str = "updated_at", check_cols: Sequence[str] = ()) -> DataFrame:
    """Counts of new / changed / deleted / unchanged keys a run would see."""
    j, has_h, has_s = _joined(history.where(F.col(VALID_TO).isNull()), source, key)
    kind = (F.when(~has_h, "new").when(~has_s, "deleted")
            .when(_changed(strategy, updated_at, check_cols), "changed").otherwise("same"))
    return j.groupBy(kind.alias("change")).agg(F.count(F.lit(1)).alias("keys"))
