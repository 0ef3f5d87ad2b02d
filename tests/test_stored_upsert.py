"""The stored upsert: equal to the plain rule, and blind to months it does not touch."""

import datetime as dt
import os
import shutil
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerline.plans import build as B
from ledgerline.plans import state as ST
from test_upsert_property import model

SCHEMA = "order_id long, order_date date, v int"
row = st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.dates(dt.date(2024, 1, 28), dt.date(2024, 4, 2)),
                st.integers(0, 3))


def rows_of(df):
    return sorted((tuple(r) for r in df.select("order_id", "order_date", "v").collect()), key=repr)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=8), st.lists(row, max_size=8), st.lists(row, max_size=5))
def test_three_loads_match_the_model(spark, first, second, third):
    folder = tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")
    up = B.upsert_by_month(spark, spark.createDataFrame(first, SCHEMA), lambda o: o, None, f"{folder}/0")
    want = sorted(first, key=repr)
    assert rows_of(up.rows) == want
    for n, source in enumerate((second, third), 1):
        delta, want = model(want, source)
        up = B.upsert_by_month(spark, spark.createDataFrame(source, SCHEMA), lambda o: o, up.table,
                               f"{folder}/{n}", up.keys)
        assert rows_of(up.rows) == want
        assert rows_of(up.delta) == delta


@pytest.fixture()
def stored(spark, scratch):
    rows = spark.range(4000).select(F.col("id").alias("order_id"), F.date_add(
        F.lit(dt.date(2023, 1, 1)), (F.col("id") / 10).cast("int")).alias("order_date"), F.lit(1).alias("v"))
    rows.write.parquet(f"{scratch}/orders")
    rows = spark.read.parquet(f"{scratch}/orders")
    return rows, B.upsert_by_month(spark, rows, lambda o: o, None, f"{scratch}/0"), scratch


def test_a_load_without_old_changes_reads_no_old_month(spark, stored):
    rows, up, scratch = stored
    newest = max(v[0] for v, _ in up.table.parts)
    for (value,), base in up.table.parts:
        if value != newest:
            shutil.rmtree(f"{base}/order_month={value}")  # any read of an old month would fail
    more = rows.unionByName(spark.createDataFrame([(9000, dt.date(2024, 2, 4), 2)], SCHEMA))
    again = B.upsert_by_month(spark, more, lambda o: o, up.table, f"{scratch}/1", up.keys)
    moved = [v[0] for v, base in again.table.parts if base != f"{scratch}/0/data"]
    assert moved == [newest] and "2024-02-01" == newest
    fresh = ST.read(spark, ST.only(again.table, moved))
    assert fresh.where("order_id = 9000").count() == 1
    assert len(again.keys.parts) == len(up.keys.parts)
    assert [v for v, path in again.keys.parts if path == f"{scratch}/1/keys"] == [[newest]]
    held = B.read_keys(spark, again.keys)
    assert held.where(f"order_month = DATE '{newest}'").selectExpr("sum(size(places))").first()[0] == fresh.count()


def test_old_rows_touch_their_months_only(spark, stored):
    rows, up, scratch = stored
    # a new key of an old day; an old key now on the newest day (its old month loses it)
    change = rows.withColumn("order_date", F.when(F.col("order_id") == 5, F.lit(dt.date(2024, 2, 4)))
                             .otherwise(F.col("order_date")))
    change = change.unionByName(spark.createDataFrame([(8000, dt.date(2023, 3, 9), 7)], SCHEMA))
    again = B.upsert_by_month(spark, change, lambda o: o, up.table, f"{scratch}/1", up.keys)
    moved = {v[0] for v, base in again.table.parts if base != f"{scratch}/0/data"}
    assert moved == {"2023-01-01", "2023-03-01", "2024-02-01"}
    got = {r.order_id: r.order_date for r in again.rows.collect()}
    assert len(got) == again.rows.count() == 4001
    assert got[5] == dt.date(2024, 2, 4) and got[8000] == dt.date(2023, 3, 9)


def test_a_target_without_key_sets_gets_them(spark, stored):
    rows, up, scratch = stored
    again = B.upsert_by_month(spark, rows.where("order_id < 10"), lambda o: o, up.table, f"{scratch}/1")
    assert again.rows.count() == 4000
    assert os.path.isdir(f"{scratch}/1/keys-of-target")


def test_the_recent_cut_reaches_the_scan(spark, stored):
    from ledgerline.operators import upsert as U
    rows, up, _ = stored
    missing = spark.createDataFrame([], "order_id long")
    plan = U.missing_keys(rows, B.read_keys(spark, up.keys), "order_id", "order_date",
                          dt.date(2024, 2, 4))._jdf.queryExecution().executedPlan().toString()
    assert "data" not in {f.split("/")[-3] for f in rows.inputFiles()}
    assert "ReadSchema: struct<order_id:bigint,order_date:date>" in plan
    chosen = U.chosen_rows(rows, missing, "order_id", "order_date", dt.date(2024, 2, 4))
    assert chosen._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
