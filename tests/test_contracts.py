"""Probes of inputs the fixture lacks: CSV headers, NULL keys, 64-bit keys, output order, plans."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerline.operators import analytics as A
from ledgerline.operators import history as H
from ledgerline.operators import marts as M
from ledgerline.operators import quality as Q
from ledgerline.operators import staging as S
from ledgerline.operators.upsert import incremental_load
from ledgerline.plans import suite as SUITE
from ledgerline.sources import files, schemas
from ledgerline.sources import testbind as TB

HEADS = {"customers": "customer_id, first_name, last_name, email, registration_date, country, updated_at",
         "products": "product_id,product_name,category,price,created_at",
         "orders": "order_id,customer_id,product_id,quantity,order_date,status,total_amount"}


def _csv(scratch, table, *lines):
    path = os.path.join(scratch, f"{table}.csv")
    with open(path, "w") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def test_header_blanks_are_trimmed(spark, scratch):
    path = _csv(scratch, "customers", HEADS["customers"], "1, Ann, Lee, a@x.io, 2024-01-02, UK, 2024-02-01")
    row = files.read_raw_csv(spark, "customers", path).first()
    assert (row.first_name, row.registration_date, row.total_orders) == ("Ann", dt.date(2024, 1, 2), 0)


def test_blanks_are_kept_outside_customers(spark, scratch):
    path = _csv(scratch, "products", HEADS["products"], "1, Padded,Books,1.50,2024-01-01")
    assert files.read_raw_csv(spark, "products", path).first().product_name == " Padded"


def test_missing_column_stops_the_load_and_keeps_the_old_tables(spark, scratch):
    from ledgerline.plans.build import load_raw_csv, published_table
    paths = {"customers": _csv(scratch, "customers", HEADS["customers"],
                               "1, Ann, Lee, a@x.io, 2024-01-02, UK, 2024-02-01"),
             "products": _csv(scratch, "products", HEADS["products"], "1,P,Books,1.50,2024-01-01"),
             "orders": _csv(scratch, "orders", HEADS["orders"], "1,1,1,2,2024-01-03,completed,3.00")}
    load_raw_csv(spark, paths, f"{scratch}/wh", run_id="good")
    paths["orders"] = _csv(scratch, "orders", HEADS["orders"].replace(",total_amount", ""),
                           "1,1,1,2,2024-01-03,completed")
    with pytest.raises(files.MissingColumnsError):
        load_raw_csv(spark, paths, f"{scratch}/wh", run_id="bad")
    assert str(published_table(spark, f"{scratch}/wh", "raw_orders").first().total_amount) == "3.00"
    assert not os.path.exists(f"{scratch}/wh/_raw/bad")


@pytest.mark.parametrize("strategy", ["timestamp", "check"])
def test_null_keys_in_history(spark, strategy):
    src = spark.createDataFrame([(1, "a", dt.date(2024, 1, 1)), (None, "x", dt.date(2024, 1, 1)),
                                 (None, "y", dt.date(2024, 1, 1))], "k long, v string, updated_at date")
    hist = None
    for n in range(1, 5):
        hist = H.snapshot(src, hist, "k", strategy, dt.datetime(2024, n, 10), check_cols=["v"]).checkpoint()
        # a NULL key matches nothing: its open versions close, its rows come in anew
        nulls = hist.where("k is null")
        assert nulls.count() == 2 * n and nulls.where("dbt_valid_to is null").count() == 2
        assert hist.where("k = 1").count() == 1
    counts = {r.change: r["keys"] for r in H.change_summary(src, hist, "k", strategy, check_cols=["v"]).collect()}
    assert counts == {"same": 1, "new": 2, "deleted": 2}


def test_keys_beyond_32_bits(spark):
    big = (1 << 31) + 5
    day = dt.date(2024, 5, 6)
    o = spark.createDataFrame([(big, big, big, 2, day, "completed", Decimal(20))],
                              "order_id long, customer_id long, product_id long, quantity int, order_date date, "
                              "status string, total_amount decimal(10,2)")
    c = spark.createDataFrame([(big, "A", "B", "e", day, "UK", day, 7)], schemas.RAW_CUSTOMERS)
    p = spark.createDataFrame([(big, "P", "Books", Decimal(5), day)], "product_id long, product_name string, "
                              "category string, price decimal(10,2), created_at date")
    sc, so, sp = S.stg_customers(c, day), S.stg_orders(o), S.stg_products(p, day)
    assert M.fct_daily_sales(so, sp, sc).first().order_id == big
    rows = M.fct_orders_rows(so, sp, sc, dt.datetime(2024, 5, 7))
    assert incremental_load(rows, rows)[1].first().customer_id == big
    for fields in (schemas.RAW_ORDERS, schemas.RAW_CUSTOMERS, schemas.RAW_PRODUCTS):
        assert {f.dataType.simpleString() for f in fields if f.name.endswith("_id")} == {"bigint"}


def _layers(spark):
    raw = TB.load_raw(spark, SF_SMALL)
    return S.stg_customers(raw.customers, TB.AS_OF), S.stg_orders(raw.orders), S.stg_products(raw.products, TB.AS_OF)


def test_output_order(spark):
    c, o, p = _layers(spark)
    summary = A.daily_sales_summary(M.fct_daily_sales(o, p, c)).select("sale_date", "gross_revenue").collect()
    assert summary == sorted(summary, key=lambda r: (r.sale_date, r.gross_revenue), reverse=True)
    cohorts = A.customer_cohorts(c, o).select("cohort_month", "order_month").collect()
    assert cohorts == sorted(cohorts) and len(cohorts) > 10


def test_no_expand_in_distinct_counts(spark):
    c, o, p = _layers(spark)
    frames = [A.daily_sales_summary(M.fct_daily_sales(o, p, c)), M.rfm_metrics(o, TB.AS_OF),
              Q.run_checks({"stg_customers": c, "stg_orders": o, "stg_products": p},
                           [k for k in SUITE.SUITE if k.model.startswith("stg_")], as_of=TB.AS_OF,
                           kinds={"accepted_values"})]
    for df in frames:
        assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()


def test_delta_reaches_the_scan(spark, scratch):
    rows = spark.range(2000).select("id", F.date_add(F.lit(dt.date(2024, 1, 1)), (F.col("id") % 300).cast("int"))
                                    .alias("day"), F.lit("x" * 50).alias("wide"))
    rows.write.parquet(f"{scratch}/src")
    rows.where("id < 1900").write.parquet(f"{scratch}/tgt")
    src, tgt = (spark.read.parquet(f"{scratch}/{n}") for n in ("src", "tgt"))
    delta, new = incremental_load(src, tgt, "id", "day")
    assert new.count() == 2000
    plan = delta._jdf.queryExecution().executedPlan().toString()
    keys_only = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "Window" not in plan and keys_only
    assert delta.where("id >= 1900").count() == 100


def test_negative_totals_fail_the_assertion(spark):
    df = spark.createDataFrame([(1, -5), (2, 5), (3, None)], "order_id long, total_amount int")
    got = Q.singular_result(df, SUITE.SINGULAR_CONDITION, SUITE.SINGULAR_MODEL, "total_amount").first()
    assert got.failures == 1
    assert Q.singular(df, F.expr(SUITE.SINGULAR_CONDITION), "s", "m", SUITE.SINGULAR_COLUMNS).count() == 1
