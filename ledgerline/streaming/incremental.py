"""Structured Streaming form of the incremental order load.

Arriving order files are read with ``readStream``; each micro-batch is
merged into the target with the same delete-then-insert rule as the batch
load, inside ``foreachBatch``: only the order months it touches are
written anew, and dimension joins run for the delta only.

Exactly-once: an epoch writes its months to a folder of its own attempt
and then publishes folders and epoch number together in one manifest
version.  A replayed epoch finds its number there and does nothing, so it
never reads or writes what it has published.  Progress lives in the
checkpoint location, which must be on shared storage like ``root``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..plans import build as B
from ..plans import state as ST
from ..session import new_run_id


def upsert_batch_writer(table: str, root: str,
                        transform: Callable[[DataFrame], DataFrame] | None = None
                        ) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        manifest = ST.load(spark, root)
        if manifest.epochs.get(table, -1) < epoch_id:
            path = f"{root.rstrip('/')}/_epochs/{epoch_id}-{new_run_id()}"
            rows = batch.persist()  # the delta choice reads the micro-batch more than once
            try:
                up = B.upsert_by_month(spark, rows, transform or (lambda o: o), manifest.tables.get(table),
                                       path, manifest.tables.get(B.keys_of(table)))
            finally:
                rows.unpersist()
            manifest = ST.commit(spark, root, manifest, f"epoch-{epoch_id}",
                                 {table: up.table, B.keys_of(table): up.keys}, {table: epoch_id})
        ST.sync_catalog(spark, manifest, {table: table})
    return write


def start_incremental_stream(stream_rows: DataFrame, table: str, root: str,
                             checkpoint: str, available_now: bool = True,
                             transform: Callable[[DataFrame], DataFrame] | None = None):
    """Start the streaming load; returns the StreamingQuery.  ``transform``
    turns chosen order rows into target rows (it must keep the order key)."""
    w = (stream_rows.writeStream
         .foreachBatch(upsert_batch_writer(table, root, transform))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
