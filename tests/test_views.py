"""Staging views as text: equal to the staging frames, and there for a session that built nothing."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import staging as S
from ledgerline.plans import build as B
from ledgerline.plans import state as ST
from ledgerline.plans.views import NotAViewError, view_sql
from ledgerline.sources import datagen as G
from ledgerline.sources import files
from ledgerline.sources.files import write_csv

AS_OF = dt.date(2025, 1, 1)
TABLES = ("customers", "products", "orders")


def _csvs(spark, folder):
    paths = {}
    for name, df in zip(TABLES, G.generate(spark, 40, 300, AS_OF, num_partitions=2)):
        paths[name] = f"{folder}/{name}"
        write_csv(df, paths[name])
    return paths


def test_another_session_reads_the_views(spark, scratch):
    root = f"{scratch}/wh"
    B.load_raw_csv(spark, _csvs(spark, f"{scratch}/csv"), root, run_id="load")
    raw = {t: B.published_table(spark, root, f"raw_{t}") for t in TABLES}
    res = B.build(spark, raw["customers"], raw["products"], raw["orders"], root, AS_OF,
                  dt.datetime(2025, 1, 1), run_id="v", tags={"cohorts"}, views=True)
    assert res.published
    assert {r["table_name"]: r["status"] for r in res.postflight}["stg_orders"] == "ok"
    # nothing of the build's session is left
    for t in TABLES:
        spark.catalog.dropTempView(f"stg_{t}")
    for db in ("ledger_staging", "ledger_raw", "ledger_analytics"):
        spark.sql(f"DROP DATABASE {db} CASCADE")
    B.open_warehouse(spark, root)
    want = {"stg_customers": S.stg_customers(raw["customers"], AS_OF), "stg_orders": S.stg_orders(raw["orders"]),
            "stg_products": S.stg_products(raw["products"], AS_OF)}
    for name, df in want.items():
        view = spark.table(f"ledger_staging.{name}")
        assert view.columns == df.columns and view.dtypes == df.dtypes
        assert sorted(map(tuple, view.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)
    # a later load moves the raw tables; the views follow
    more = _csvs(spark, f"{scratch}/csv2")
    write_csv(G.generate(spark, 40, 300, AS_OF)[0].unionByName(spark.createDataFrame(
        [(999, "Ann", "Lee", "a@x.io", AS_OF, "UK", AS_OF, 0)], raw["customers"].schema)), more["customers"])
    B.load_raw_csv(spark, more, root, run_id="load2")
    assert spark.table("ledger_staging.stg_customers").count() == 41
    # counts come from the manifest
    m = ST.load(spark, root)
    assert m.tables["customer_cohorts"].rows == spark.table("ledger_analytics.customer_cohorts").count()


def test_only_projections_of_a_table_have_text(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("default.ledger_view_probe")
    t = spark.table("default.ledger_view_probe")
    text = view_sql(t.where("id > 0").select((F.col("id") + 1).alias("next")), "default.ledger_view_probe")
    assert sorted(r.next for r in spark.sql(text).collect()) == [2, 3]
    for bad in (t.groupBy("id").count(), spark.range(3).select("id")):
        with pytest.raises(NotAViewError):
            view_sql(bad, "default.ledger_view_probe")
    spark.sql("DROP TABLE default.ledger_view_probe")


def test_a_stopped_load_names_file_and_row(spark, scratch):
    paths = _csvs(spark, f"{scratch}/csv")
    bad = f"{paths['orders']}/bad.csv"
    with open(bad, "w") as f:
        f.write("order_id,customer_id,product_id,quantity,order_date,status,total_amount\n"
                "9001,1,1,two,2024-01-03,completed,3.00\n9002,1,1,2,2024-13-03,completed,3.00\n"
                "9003,1,1,2,2024-01-03,completed\n9004,1,1,,2024-01-03,completed,1.00\n")
    with pytest.raises(B.RawLoadError) as e:
        B.load_raw_csv(spark, paths, f"{scratch}/wh", run_id="bad")
    said = str(e.value)
    assert "bad.csv" in said and "9001,1,1,two" in said and "(quantity)" in said and "(order_date)" in said
    assert "9003" in said and "9004" not in said  # an empty field is NULL, not a fault
    assert not os.path.exists(f"{scratch}/wh/_raw/bad") and ST.load(spark, f"{scratch}/wh").version == 0
    found = {r.row.split(",")[0]: r.columns for r in files.rejected_rows(spark, "orders", paths["orders"]).collect()}
    assert found == {"9001": ["quantity"], "9002": ["order_date"], "9003": []}
