"""Published state: survives the process, never half visible, never overwritten."""

import datetime as dt
import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT
from ledgerline.plans import build as B
from ledgerline.plans import state as ST
from ledgerline.sources import datagen as G

AS_OF = dt.date(2025, 1, 1)


def _cli(*args):
    out = subprocess.run([sys.executable, "-m", "ledgerline", "--master", "local[2]", *args],
                         cwd=ROOT, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr[-2000:]
    return json.loads(out.stdout.strip().splitlines()[-1])


def test_history_continues_in_another_process(spark, scratch):
    csv, root = f"{scratch}/csv", f"{scratch}/wh"
    _cli("generate", "--out", csv, "--customers", "40", "--orders", "200", "--as-of", "2025-01-01")
    run = ["run", "--csv-dir", csv, "--root", root, "--as-of", "2025-01-01", "--tags",
           "snapshots,incremental"]
    _cli(*run, "--run-ts", "2025-01-01")
    second = _cli(*run, "--run-ts", "2025-02-01")
    assert second["published"]
    snap = B.published_table(spark, root, "customers_snapshot_check")
    assert snap.count() == 40  # the same customers: no version was opened or closed
    assert snap.agg(F.max("dbt_valid_from")).first()[0] == dt.datetime(2025, 1, 1)
    orders = B.published_table(spark, root, "fct_orders_incremental")
    last = orders.agg(F.max("order_date")).first()[0]
    again = orders.where(F.col("loaded_at") == dt.datetime(2025, 2, 1))
    B.open_warehouse(spark, root)  # views that the other process made
    assert spark.table("ledger_staging.stg_customers").count() == 40
    assert orders.count() == 200 and again.where(F.col("order_date") < last).count() == 0


def _build(spark, root, run_id, c, p, o, day, **kw):
    return B.build(spark, c, p, o, root, AS_OF, dt.datetime(2025, 1, day), run_id=run_id,
                   tags={"customers", "cohorts"}, **kw)


def test_publish_is_all_or_nothing(spark, scratch, monkeypatch):
    c, p, o = G.generate(spark, 50, 300, AS_OF, num_partitions=2)
    assert _build(spark, scratch, "a", c, p, o, 1).published
    before = ST.load(spark, scratch)

    def crash(*args, **kwargs):
        raise RuntimeError("stopped between two tables")

    monkeypatch.setattr(ST, "commit", crash)
    with pytest.raises(RuntimeError):
        _build(spark, scratch, "b", c.withColumn("first_name", F.lit("Zed")), p, o, 2)
    monkeypatch.undo()
    assert ST.load(spark, scratch) == before
    assert B.published_table(spark, scratch, "dim_customers").where("first_name = 'Zed'").count() == 0
    assert not os.path.exists(f"{scratch}/_runs/b")  # an unpublished run leaves nothing
    # a crash after the manifest: the next process's catalog follows the manifest
    monkeypatch.setattr(ST, "sync_catalog", crash)
    with pytest.raises(RuntimeError):
        _build(spark, scratch, "c", c, p, o, 3)
    monkeypatch.undo()
    assert ST.load(spark, scratch).run_id == "c"


def test_run_id_is_used_once(spark, scratch):
    c, p, o = G.generate(spark, 30, 200, AS_OF, num_partitions=2)
    assert _build(spark, scratch, "same", c, p, o, 1).published
    with pytest.raises(ValueError):
        _build(spark, scratch, "same", c, p, o, 2)
    m = ST.load(spark, scratch)
    with pytest.raises(ST.ConcurrentPublishError):  # two publishers of one version
        ST.commit(spark, scratch, ST.Manifest(m.version - 1), "late", {})
    assert _build(spark, scratch, "next", c, p, o, 2).published
    assert B.prune(spark, scratch) == [f"{scratch}/_runs/same"]


def test_failed_check_stops_the_run_there(spark, scratch):
    c, p, o = G.generate(spark, 30, 200, AS_OF, num_partitions=2)
    bad = c.withColumn("country", F.lit("Mars"))
    res = B.build(spark, bad, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), run_id="bad")
    assert not res.published and res.tables == {} and res.failures
    assert not os.path.exists(f"{scratch}/_runs/bad") and ST.load(spark, scratch).version == 0


def test_seeds_and_freshness(spark, scratch):
    c, p, o = G.generate(spark, 30, 200, AS_OF, num_partitions=2)
    at = spark.createDataFrame([(dt.datetime(2024, 12, 1),)], "t timestamp_ntz")
    with pytest.raises(B.PreflightError):
        B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), loaded_at=at, tags={"seeds"})
    at = spark.createDataFrame([(dt.datetime(2024, 12, 31, 20),)], "t timestamp_ntz")
    res = B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), loaded_at=at, tags={"seeds"})
    assert res.published and spark.table("ledger_reference.regions").count() == 5


def test_of_two_publishers_exactly_one_wins(spark, scratch):
    import threading
    for n in range(5):
        old, won, lost = ST.load(spark, scratch), [], []
        gate = threading.Barrier(2)

        def publish(name):
            gate.wait()
            try:
                ST.commit(spark, scratch, old, name, {"t": ST.Table("{}", path=name)})
                won.append(name)
            except ST.ConcurrentPublishError:
                lost.append(name)

        threads = [threading.Thread(target=publish, args=(f"{n}-{k}",)) for k in "ab"]
        [t.start() for t in threads]
        [t.join() for t in threads]
        assert len(won) == len(lost) == 1
        assert ST.load(spark, scratch).run_id == won[0] and ST.load(spark, scratch).version == n + 1
    assert not [f for f in os.listdir(f"{scratch}/_manifest") if f.endswith(".tmp")]


def test_a_long_log_is_read_as_one_file(spark, scratch, monkeypatch):
    ST.commit(spark, scratch, ST.Manifest(), "r", {"t": ST.Table("{}", path="p")})
    with open(f"{scratch}/_manifest/{1:012d}.json") as f:
        body = json.load(f)
    for n in range(2, 1000):  # as 998 more commits leave it
        with open(f"{scratch}/_manifest/{n:012d}.json", "w") as f:
            json.dump({**body, "version": n}, f)
    os.remove(f"{scratch}/_manifest/_head")
    ST.commit(spark, scratch, ST.load(spark, scratch), "last", {"t": ST.Table("{}", path="p999")})
    opened, read = [], ST._Files.read
    monkeypatch.setattr(ST._Files, "read", lambda self, name: opened.append(name) or read(self, name))
    monkeypatch.setattr(ST, "versions", None)  # the log is not listed
    assert ST.load(spark, scratch).tables["t"].path == "p999"
    assert len(opened) == 2  # the head and one manifest
    monkeypatch.undo()
    os.remove(f"{scratch}/_manifest/_head")  # only a hint
    assert ST.load(spark, scratch).version == 1000
    with open(f"{scratch}/_manifest/_head", "w") as f:
        f.write("998")
    assert ST.load(spark, scratch).version == 1000
    assert len(ST.drop_versions(spark, scratch, 10)) == 990
    assert ST.load(spark, scratch).version == 1000 and len(os.listdir(f"{scratch}/_manifest")) < 40


def test_entries_stay_while_a_table_is_published(spark, scratch):
    """A publish alters what changed: no entry is dropped, so no reader misses the table."""
    rows = spark.range(6).select("id", (F.col("id") % 3).cast("string").alias("part"))
    names = {"t": "ledger_sync.t", "flat": "ledger_sync.flat"}

    def publish(old, n, frame):
        frame.write.partitionBy("part").parquet(f"{scratch}/{n}/t")
        frame.write.parquet(f"{scratch}/{n}/flat")
        parts = [p for p in old.tables["t"].parts] if old.tables else []
        new = ST.partition_values(spark, f"{scratch}/{n}/t")
        parts = [p for p in parts if p[0] not in new] + [[v, f"{scratch}/{n}/t"] for v in new]
        return ST.commit(spark, scratch, old, str(n), {
            "t": ST.partitioned(frame, ["part"], parts), "flat": ST.plain(frame, f"{scratch}/{n}/flat")})

    m = publish(ST.Manifest(), 0, rows)
    ST.sync_catalog(spark, m, names)
    statements, sql = [], spark.sql
    m2 = publish(m, 1, rows.where("part = '1'").unionByName(spark.createDataFrame([(9, "new")], "id long, part string")))
    spark.sql = lambda text, *a, **k: statements.append(text) or sql(text, *a, **k)
    try:
        ST.sync_catalog(spark, m2, names)
        ST.sync_catalog(spark, m2, names)
    finally:
        del spark.sql
    assert not [s for s in statements if s.startswith(("DROP", "CREATE"))]
    assert len([s for s in statements if "SET LOCATION" in s]) == 2 and len([s for s in statements if " ADD " in s]) == 1
    key = lambda r: (r.part, r.id)
    want = sorted((tuple(r) for r in ST.read(spark, m2.tables["t"]).collect()))
    assert sorted((r.id, r.part) for r in spark.table("ledger_sync.t").collect()) == want
    assert sorted(map(key, spark.table("ledger_sync.flat").collect())) == [("1", 1), ("1", 4), ("new", 9)]
    # another root's table of the same name is made anew
    other = f"{scratch}/other"
    rows.write.parquet(f"{other}/flat")
    m3 = ST.commit(spark, other, ST.Manifest(), "x", {"flat": ST.plain(rows, f"{other}/flat")})
    ST.sync_catalog(spark, m3, {"flat": "ledger_sync.flat"})
    assert spark.table("ledger_sync.flat").count() == 6


def test_prune_covers_runs_epochs_and_the_log(spark, scratch):
    from ledgerline.streaming.incremental import upsert_batch_writer
    day = dt.date(2024, 1, 2)
    write = upsert_batch_writer("ledger_stream.test_prune", scratch)
    for n in range(4):
        write(spark.createDataFrame([(n, day, "a")], "order_id long, order_date date, status string"), n)
    assert len(os.listdir(f"{scratch}/_epochs")) == 4
    gone = B.prune(spark, scratch, keep=2)
    assert len(gone) == 3 and all("/_epochs/" in g for g in gone)
    assert spark.table("ledger_stream.test_prune").count() == 4 and ST.load(spark, scratch).version == 4
    assert len(ST.versions(ST._Files(spark, scratch), scratch)) == 2
    write(spark.createDataFrame([(9, day, "b")], "order_id long, order_date date, status string"), 4)
    assert spark.table("ledger_stream.test_prune").count() == 5


def test_raw_loads_keep_key_statistics(spark, scratch):
    csv, root = f"{scratch}/csv", f"{scratch}/wh"
    c, p, o = G.generate(spark, 30, 400, AS_OF, num_partitions=2)
    o = o.withColumn("product_id", F.when(F.col("order_id") % 3 == 0, F.lit(7)).otherwise(F.col("product_id")))
    from ledgerline.sources.files import write_csv
    for name, df in (("customers", c), ("products", p), ("orders", o)):
        write_csv(df, f"{csv}/{name}")
    B.load_raw_csv(spark, {t: f"{csv}/{t}" for t in ("customers", "products", "orders")}, root)
    hot = ST.load(spark, root).tables["raw_orders"].hot
    assert hot["n_rows"] == 400 and dict(map(tuple, hot["keys"]["product_id"]))[7] >= 133
    raw = {t: B.published_table(spark, root, f"raw_{t}") for t in ("customers", "products", "orders")}
    res = B.build(spark, raw["customers"], raw["products"], raw["orders"], root, AS_OF, dt.datetime(2025, 1, 1),
                  tags={"sales"})
    assert res.published and spark.table("ledger_marts.fct_daily_sales").count() > 0
