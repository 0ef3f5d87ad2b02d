"""CSV sources/sinks, seeds and the synthetic generator."""

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import datagen as G
from ledgerline.sources import files


def test_raw_csv_skips_blanks_and_defaults_total_orders(spark, scratch):
    path = os.path.join(scratch, "customers.csv")
    with open(path, "w") as fh:
        fh.write("customer_id,first_name,last_name,email,registration_date,country,updated_at\n")
        fh.write("1, Ann, Lee, ann@x.io, 2024-01-02, UK, 2024-02-01\n")
        fh.write("2,Bob,Ray,bob@x.io,2024-01-03,USA,\n")
    df = files.read_raw_csv(spark, "customers", path)
    rows = sorted(tuple(r) for r in df.collect())
    assert rows[0] == (1, "Ann", "Lee", "ann@x.io", dt.date(2024, 1, 2), "UK",
                       dt.date(2024, 2, 1), 0)
    assert rows[1][6] is None and rows[1][7] == 0


def test_raw_csv_fails_fast_on_bad_type(spark, scratch):
    path = os.path.join(scratch, "orders.csv")
    with open(path, "w") as fh:
        fh.write("order_id,customer_id,product_id,quantity,order_date,status,total_amount\n")
        fh.write("1,1,1,two,2024-01-01,completed,10.00\n")
    with pytest.raises(Exception):
        files.read_raw_csv(spark, "orders", path).collect()


def test_csv_sink_roundtrip(spark, scratch):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    out = os.path.join(scratch, "out")
    files.write_csv(df, out)
    back = spark.read.option("header", True).schema("id int, s string").csv(out)
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a"), (2, "b")]


def test_seeds_have_declared_types(spark):
    regions = files.read_seed(spark, "regions")
    cats = files.read_seed(spark, "categories")
    assert dict(regions.dtypes)["delivery_days"] == "int"
    assert dict(cats.dtypes)["is_active"] == "boolean"
    assert regions.count() == 5 and cats.count() == 5
    assert cats.where(~F.col("is_active")).select("category_name").first()[0] == "Books"


def test_generator_shapes_and_distributions(spark):
    c, p, o = G.generate(spark, 2000, 20000, dt.date(2025, 1, 1), num_partitions=4)
    assert c.count() == 2000 and p.count() == 46 and o.count() == 20000
    share = {r.status: r.n / 20000 for r in o.groupBy("status").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    for s, w in zip(G.STATUSES, G.STATUS_WEIGHTS):
        assert abs(share[s] - w) < 0.02
    years = {r.y: r.n for r in o.groupBy(F.year("order_date").alias("y")).agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert abs(years[2024] / 20000 - 0.7) < 0.02
    assert o.agg(F.min("quantity")).first()[0] >= 1
    # customers' total_orders equals their completed orders
    done = o.where("status = 'completed'").groupBy("customer_id").count()
    mism = c.join(done, "customer_id", "left").where(
        F.coalesce(F.col("count"), F.lit(0)) != F.col("total_orders")).count()
    assert mism == 0
    # prices within the category ranges
    for cat, (lo, hi), _ in G.CATALOG:
        r = p.where(F.col("category") == cat).agg(F.min("price"), F.max("price")).first()
        assert Decimal(str(lo)) <= r[0] and r[1] <= Decimal(str(hi))


def test_generator_independent_of_partitioning(spark):
    a = G.generate(spark, 100, 1000, dt.date(2025, 1, 1), num_partitions=1)[2]
    b = G.generate(spark, 100, 1000, dt.date(2025, 1, 1), num_partitions=7)[2]
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in b.collect())


def test_raw_load_is_all_or_nothing(spark, scratch):
    from ledgerline.plans.build import load_raw_csv
    d = {}
    files_ = {
        "customers": "customer_id,first_name,last_name,email,registration_date,country,"
                     "updated_at,total_orders\n1,A,B,a@b.c,2024-01-01,UK,2024-01-02,3\n",
        "products": "product_id,product_name,category,price,created_at\n"
                    "1,P,Books,10.50,2024-01-01\n",
        "orders": "order_id,customer_id,product_id,quantity,order_date,status,total_amount\n"
                  "1,1,1,2,2024-01-03,completed,21.00\n",
    }
    for name, text in files_.items():
        d[name] = os.path.join(scratch, f"{name}.csv")
        with open(d[name], "w") as fh:
            fh.write(text)
    load_raw_csv(spark, d, scratch, run_id="ok")
    assert spark.table("ledger_raw.orders").count() == 1
    # a bad orders file: nothing moves, the first load stays visible
    with open(d["orders"], "w") as fh:
        fh.write(files_["orders"] + "2,1,1,x,2024-01-04,completed,5.00\n")
    with pytest.raises(Exception):
        load_raw_csv(spark, d, scratch, run_id="bad")
    assert spark.table("ledger_raw.orders").count() == 1
    assert spark.table("ledger_raw.customers").count() == 1


def test_raw_load_enforces_keys_and_lengths(spark, scratch):
    from ledgerline.plans.build import RawLoadError, load_raw_csv
    base = {
        "customers": "customer_id,first_name,last_name,email,registration_date,country,"
                     "updated_at,total_orders\n1,A,B,a@b.c,2024-01-01,UK,2024-01-02,3\n",
        "products": "product_id,product_name,category,price,created_at\n"
                    "1,P,Books,10.50,2024-01-01\n",
        "orders": "order_id,customer_id,product_id,quantity,order_date,status,total_amount\n"
                  "1,1,1,2,2024-01-03,completed,21.00\n",
    }
    bad_cases = {
        "orders": base["orders"] + "2,9,1,1,2024-01-03,completed,5.00\n",      # orphan
        "products": base["products"] + "1,Q,Books,1.00,2024-01-01\n",        # duplicate key
        "customers": base["customers"].replace(",A,", "," + "x" * 51 + ","),  # too long
    }
    for bad_table, bad_text in bad_cases.items():
        d = {}
        for name, text in base.items():
            d[name] = os.path.join(scratch, f"{bad_table}_{name}.csv")
            with open(d[name], "w") as fh:
                fh.write(bad_text if name == bad_table else text)
        with pytest.raises(RawLoadError):
            load_raw_csv(spark, d, scratch, run_id=f"bad_{bad_table}")
