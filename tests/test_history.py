"""SCD2 over four runs vs. a DuckDB merge written as UPDATE + INSERT."""

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import history as H
from ledgerline.operators import staging as S
from ledgerline.sources import testbind as TB

CHECK = ["first_name", "last_name", "email", "country", "customer_tier"]
COMPARE = ["customer_id", "country", "customer_tier", "updated_at", "dbt_scd_id",
           "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _sources(spark):
    raw = TB.raw_customers(spark, SF_SMALL)
    loads = [TB.customers_first_load(raw), TB.customers_second_load(raw),
             TB.customers_second_load(raw), TB.customers_first_load(raw)]
    return [S.stg_customers(loads[n], TB.SNAPSHOT_RUNS[n].date()) for n in range(4)]


def _duck_merge(con, strategy, run_ts, first):
    ts = f"TIMESTAMP '{run_ts:%Y-%m-%d %H:%M:%S}'"
    v = "CAST(s.updated_at AS TIMESTAMP)" if strategy == "timestamp" else ts
    sid = f"md5(CAST(s.customer_id AS VARCHAR) || '|' || CAST({v} AS VARCHAR))"
    meta = f"{sid} AS dbt_scd_id, {v} AS dbt_updated_at, {v} AS dbt_valid_from, " \
           f"CAST(NULL AS TIMESTAMP) AS dbt_valid_to"
    if first:
        con.execute(f"CREATE TABLE snap AS SELECT s.*, {meta} FROM src s")
        return
    changed = ("h.dbt_valid_from < CAST(s.updated_at AS TIMESTAMP)" if strategy == "timestamp"
               else " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in CHECK))
    con.execute("CREATE OR REPLACE TEMP TABLE cur AS SELECT * FROM snap WHERE dbt_valid_to IS NULL")
    con.execute(f"""CREATE OR REPLACE TEMP TABLE ins AS
        SELECT s.*, {meta} FROM src s LEFT JOIN cur h ON h.customer_id = s.customer_id
        WHERE h.customer_id IS NULL OR ({changed})""")
    con.execute(f"""CREATE OR REPLACE TEMP TABLE upd AS
        SELECT h.dbt_scd_id, {v} AS new_to FROM cur h JOIN src s ON h.customer_id = s.customer_id
        WHERE {changed}
        UNION ALL
        SELECT h.dbt_scd_id, {ts} FROM cur h LEFT JOIN src s ON h.customer_id = s.customer_id
        WHERE s.customer_id IS NULL""")
    con.execute("""UPDATE snap SET dbt_valid_to = upd.new_to FROM upd
                   WHERE snap.dbt_scd_id = upd.dbt_scd_id AND snap.dbt_valid_to IS NULL""")
    con.execute("INSERT INTO snap SELECT * FROM ins")


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(None if x is None else str(x) for x in r))
    return sorted(out, key=lambda t: tuple((x is None, x) for x in t))


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_four_runs_match_duckdb_merge(spark, strategy):
    sources = _sources(spark)
    con = duckdb.connect()
    hist = None
    snapshots = []
    for n, src in enumerate(sources):
        run_ts = TB.SNAPSHOT_RUNS[n]
        hist = H.snapshot(src, hist, "customer_id", strategy, run_ts, check_cols=CHECK)
        hist = hist.checkpoint()  # cut lineage between runs, as a writer would
        pdf = src.toPandas()
        con.register("src_pdf", pdf)
        con.execute("CREATE OR REPLACE TABLE src AS SELECT * FROM src_pdf")
        _duck_merge(con, strategy, run_ts, first=(n == 0))
        spark_rows = _norm(tuple(r) for r in hist.select(*COMPARE).collect())
        duck_rows = _norm(con.execute(f"SELECT {', '.join(COMPARE)} FROM snap").fetchall())
        assert spark_rows == duck_rows, f"run {n + 1}"
        # never two open versions of one key
        dup_open = (hist.where(F.col("dbt_valid_to").isNull()).groupBy("customer_id").count()
                    .where("count > 1").count())
        assert dup_open == 0
        snapshots.append(spark_rows)
    # run 3 repeats run 2's source: nothing may change
    assert snapshots[2] == snapshots[1]
    # run 4 brings deleted keys back and deletes the later ones
    assert len(snapshots[3]) > len(snapshots[2])


def test_change_summary_counts(spark):
    sources = _sources(spark)
    h1 = H.snapshot(sources[0], None, "customer_id", "check", TB.SNAPSHOT_RUNS[0])
    counts = {r.change: r.keys for r in
              H.change_summary(sources[1], h1, "customer_id", "check", check_cols=CHECK).collect()}
    assert set(counts) <= {"new", "deleted", "changed", "same"}
    assert sum(counts.values()) == (h1.count() + sources[1].join(
        sources[0], "customer_id", "left_anti").count())
