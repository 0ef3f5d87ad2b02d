"""Streaming load over two arriving order files == two sequential loads."""

import datetime as dt
import os
import time

from pyspark.sql import functions as F

from ledgerline.operators import marts as M
from ledgerline.operators import staging as S
from ledgerline.operators.upsert import incremental_load
from ledgerline.sources import datagen as G
from ledgerline.sources import schemas
from ledgerline.streaming.incremental import start_incremental_stream

AS_OF = dt.date(2025, 1, 1)
RUN = dt.datetime(2025, 1, 1)


def test_two_batches_upsert_in_order(spark, scratch):
    c, p, o = G.generate(spark, 80, 600, AS_OF, num_partitions=2)
    first = o.where(F.col("order_date") < dt.date(2024, 10, 1))
    last_day = first.agg(F.max("order_date")).first()[0]
    # second file: everything, with orders of the last loaded day changed
    second = o.withColumn("status", F.when(F.col("order_date") == last_day, F.lit("refunded"))
                          .otherwise(F.col("status")))
    incoming = os.path.join(scratch, "incoming")
    first.coalesce(1).write.parquet(os.path.join(incoming, "b1"))
    time.sleep(1.1)  # file order follows modification time
    second.coalesce(1).write.parquet(os.path.join(incoming, "b2"))

    stream = (spark.readStream.schema(schemas.RAW_ORDERS).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", True).parquet(incoming))
    products, customers = S.stg_products(p, AS_OF), S.stg_customers(c, AS_OF)
    table = "ledger_stream.test_two_batches"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    q = start_incremental_stream(
        S.stg_orders(stream), table, os.path.join(scratch, "data"),
        os.path.join(scratch, "checkpoint"),
        transform=lambda b: M.fct_orders_rows(b, products, customers, RUN))
    q.awaitTermination()
    assert q.lastProgress is not None and q.lastProgress["batchId"] == 1

    def rows(raw):
        return M.fct_orders_rows(S.stg_orders(raw), products, customers, RUN)
    _, t1 = incremental_load(rows(first), None)
    _, t2 = incremental_load(rows(second), t1)
    got = spark.table(table).drop("order_month")
    assert sorted(map(tuple, got.collect()), key=repr) == \
        sorted(map(tuple, t2.select(*got.columns).collect()), key=repr)


def test_replayed_epoch_changes_nothing(spark, scratch):
    from ledgerline.plans import state as ST
    from ledgerline.streaming.incremental import upsert_batch_writer
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 2), "a"), (2, dt.date(2024, 2, 2), "b"),
                                  (3, dt.date(2024, 2, 3), "c")],
                                 "order_id long, order_date date, status string")
    table = "ledger_stream.test_replay"
    write = upsert_batch_writer(table, scratch)
    write(rows, 0)
    before = ST.load(spark, scratch)
    write(rows.limit(0), 0)
    write(rows, 0)
    assert ST.load(spark, scratch).version == before.version
    assert spark.table(table).count() == 3
    write(rows.where("order_id = 3").withColumn("status", F.lit("z")), 1)
    got = {r.order_id: r.status for r in spark.table(table).collect()}
    assert got == {1: "a", 2: "b", 3: "z"}
    write(rows, 1)  # epoch 1 again, after its publish
    assert {r.order_id: r.status for r in spark.table(table).collect()} == got
