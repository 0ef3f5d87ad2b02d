"""Build: publish on clean data, incremental second run, gate blocks bad data."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerline.plans import build as B
from ledgerline.plans import state as ST
from ledgerline.sources import datagen as G

AS_OF = dt.date(2025, 1, 1)


def _location(spark, table):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def test_build_publish_rerun_and_gate(spark, scratch):
    c, p, o = G.generate(spark, 300, 3000, AS_OF, num_partitions=4)
    res = B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), run_id="r1")
    assert res.published, res.failures
    assert {r["status"] for r in res.postflight} == {"ok"}
    assert spark.table("ledger_marts.fct_orders_incremental").count() == 3000
    assert spark.table("ledger_snapshots.customers_snapshot").count() == 300
    # every published table reads back through the catalog
    assert spark.table("ledger_marts.dim_customers").count() == 300
    assert spark.table("ledger_marts.fct_daily_sales").count() == \
        o.where(F.col("status").isin("completed", "shipped")).count()
    assert spark.table("ledger_analytics.daily_sales_summary").count() > 0
    assert spark.table("ledger_analytics.customer_cohorts").count() > 0
    assert spark.table("ledger_snapshots.customers_snapshot_check").count() == 300
    first_loc = _location(spark, "ledger_marts.dim_customers")
    assert first_loc.endswith("/_runs/r1/dim_customers")

    _counts_are_kept(spark, scratch)

    # second run: one order changes status on the last loaded day
    last = o.agg(F.max("order_date")).first()[0]
    o2 = o.withColumn("status", F.when(F.col("order_date") == last, F.lit("shipped"))
                      .otherwise(F.col("status")))
    res2 = B.build(spark, c, p, o2, scratch, AS_OF, dt.datetime(2025, 1, 2), run_id="r2",
                   tags={"incremental", "snapshots"})
    assert res2.published, res2.failures
    inc = spark.table("ledger_marts.fct_orders_incremental")
    assert inc.count() == 3000
    assert inc.where(F.col("order_date") == last).where(F.col("status") != "shipped").count() == 0
    assert inc.where(F.col("loaded_at") == dt.datetime(2025, 1, 2)).count() == \
        o.where(F.col("order_date") == last).count()
    _counts_are_kept(spark, scratch)
    # tag selection: dim_customers untouched by run 2
    assert _location(spark, "ledger_marts.dim_customers") == first_loc

    # third run with a bad customer row: nothing is published
    bad = c.withColumn("country", F.when(F.col("customer_id") == 1, F.lit("Mars"))
                       .otherwise(F.col("country")))
    res3 = B.build(spark, bad, p, o2, scratch, AS_OF, dt.datetime(2025, 1, 3), run_id="r3")
    assert not res3.published
    assert any(f["column_name"] == "country" for f in res3.failures)
    assert _location(spark, "ledger_marts.dim_customers") == first_loc


def _counts_are_kept(spark, root):
    """The manifest's row counts, observed while writing, are the tables' own."""
    m = ST.load(spark, root)
    for name, q in B.catalog_names(m.tables).items():
        if m.tables[name].rows is not None:
            assert m.tables[name].rows == spark.table(q).count(), name
    assert {n for n, t in m.tables.items() if t.rows is None} <= {B.keys_of(B.INCREMENTAL), "seed_regions", "seed_categories"}


def test_row_checks_do_not_read_a_written_model(spark, scratch, monkeypatch):
    """Row-level and value checks come from metrics of the write; only keys are read again."""
    from ledgerline.operators import quality as Q
    c, p, o = G.generate(spark, 60, 400, AS_OF, num_partitions=2)
    asked, run = [], Q.run_checks
    monkeypatch.setattr(Q, "run_checks", lambda models, checks, **k: asked.append([x.kind for x in checks]) or run(
        models, checks, **k))
    published = []
    commit = ST.commit
    monkeypatch.setattr(ST, "commit", lambda *a, **k: published.append(len(asked)) or commit(*a, **k))
    res = B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), run_id="m", tags={"customers", "incremental"})
    assert res.published and published
    assert {k for kinds in asked[:published[0]] for k in kinds} <= {"unique", "relationships"}
    # a NULL that only the model has is found by the write's metrics
    monkeypatch.setattr(B.M, "fct_orders_rows", lambda *a, f=B.M.fct_orders_rows, **k: f(*a, **k).withColumn(
        "net_amount", F.when(F.col("order_id") > 5, F.col("net_amount"))))
    bad = B.build(spark, c, p, o, f"{scratch}/other", AS_OF, dt.datetime(2025, 1, 1), run_id="n", tags={"incremental"})
    assert not bad.published
    assert [(f["test"], f["column_name"], f["failures"]) for f in bad.failures] == [
        ("not_null", "net_amount", o.where("order_id <= 5").count())]


def test_preflight_blocks_empty_sources(spark, scratch):
    c, p, o = G.generate(spark, 10, 50, AS_OF)
    none = o.where(F.col("status") != "completed")
    row = B.preflight(c, none).first()
    assert row["status"] == "fail" and not row["completed_present"]
    try:
        B.build(spark, c, p, none, scratch, AS_OF, dt.datetime(2025, 1, 1))
    except B.PreflightError:
        pass
    else:
        raise AssertionError("pre-flight should stop the build")


def test_partition_level_incremental_equals_whole_table_rule(spark, scratch):
    from ledgerline.operators import marts as M
    from ledgerline.operators import staging as S
    from ledgerline.operators import upsert as U
    c, p, o = G.generate(spark, 200, 2000, AS_OF, num_partitions=3)
    # a fresh catalog entry for this test
    spark.sql("DROP TABLE IF EXISTS ledger_marts.fct_orders_incremental")
    r1 = B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), run_id="p1",
                 tags={"incremental"})
    assert r1.published, r1.failures
    last = o.agg(F.max("order_date")).first()[0]
    oldest = o.agg(F.min("order_id")).first()[0]
    # an old order is re-dated onto the last loaded day (moves month);
    # last-day orders change status
    o2 = (o.withColumn("order_date", F.when(F.col("order_id") == oldest, F.lit(last))
                       .otherwise(F.col("order_date")))
          .withColumn("status", F.when(F.col("order_date") == last, F.lit("refunded"))
                      .otherwise(F.col("status"))))
    r2 = B.build(spark, c, p, o2, scratch, AS_OF, dt.datetime(2025, 1, 2), run_id="p2",
                 tags={"incremental"})
    assert r2.published, r2.failures
    got = spark.table("ledger_marts.fct_orders_incremental").drop("order_month")

    def rows(raw_orders, ts):
        return M.fct_orders_rows(S.stg_orders(raw_orders), S.stg_products(p, AS_OF),
                                 S.stg_customers(c, AS_OF), ts)
    _, t1 = U.incremental_load(rows(o, dt.datetime(2025, 1, 1)), None)
    _, t2 = U.incremental_load(rows(o2, dt.datetime(2025, 1, 2)), t1)
    key = sorted(got.columns)
    assert sorted(map(tuple, got.select(*key).collect())) == \
        sorted(map(tuple, t2.select(*key).collect()))
    moved = got.where(F.col("order_id") == oldest).first()
    assert moved["order_date"] == last


def test_snapshot_runs_rewrite_only_open_versions(spark, scratch):
    from ledgerline.operators import history as H
    from ledgerline.operators import staging as S
    c, p, o = G.generate(spark, 120, 400, AS_OF, num_partitions=2)
    for t in ("customers_snapshot", "customers_snapshot_check"):
        spark.sql(f"DROP TABLE IF EXISTS ledger_snapshots.{t}")
    c2 = (c.where(F.col("customer_id") % 7 != 0)                      # deletes
          .withColumn("country", F.when(F.col("customer_id") % 5 == 1, F.lit("UK"))
                      .otherwise(F.col("country")))
          .withColumn("updated_at", F.when(F.col("customer_id") % 5 == 1,
                                           F.date_add("updated_at", 400))
                      .otherwise(F.col("updated_at"))))
    o2 = o.join(c2.select("customer_id"), "customer_id", "left_semi")  # no orphans
    runs = [(c, o, dt.datetime(2025, 1, 1)), (c2, o2, dt.datetime(2025, 2, 1)),
            (c, o, dt.datetime(2025, 3, 1))]                          # revives
    hist = {"timestamp": None, "check": None}
    for n, (cust, orders, ts) in enumerate(runs):
        res = B.build(spark, cust, p, orders, scratch, AS_OF, ts, run_id=f"s{n}",
                      tags={"snapshots"})
        assert res.published, res.failures
        for strategy in hist:
            hist[strategy] = H.snapshot(S.stg_customers(cust, AS_OF), hist[strategy],
                                        "customer_id", strategy, ts,
                                        check_cols=B.CHECK_COLUMNS).checkpoint()
    for table, strategy in B.SNAPSHOTS.items():
        got = spark.table(f"ledger_snapshots.{table}")
        cols = sorted(hist[strategy].columns)
        assert sorted(map(tuple, got.select(*cols).collect()), key=repr) == \
            sorted(map(tuple, hist[strategy].select(*cols).collect()), key=repr)
        assert ST.load(spark, scratch).tables[table].rows == got.count()
        _only_the_source_is_exchanged(spark, scratch, table, S.stg_customers(c, AS_OF))
        states = {r[0] for r in got.select("version_state").distinct().collect()}
        assert "open" in states and all(s == "open" or s.startswith("closed-") for s in states)


def _only_the_source_is_exchanged(spark, root, table, source):
    """The next run's join: stored open versions lie in buckets, so their side has no Exchange."""
    from ledgerline.operators import history as H
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        opened = ST.read_bucketed(spark, ST.only(ST.load(spark, root).tables[table], [B.OPEN_STATE]))
        merged = H.snapshot(source, opened.drop(B.SNAPSHOT_STATE), B.SNAPSHOT_KEY, "check",
                            dt.datetime(2025, 4, 1), check_cols=B.CHECK_COLUMNS, keys_not_null=True, only_open=True)
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    stored = plan[plan.index("FullOuter"):plan.index("ledger_store")]  # the join down to the stored scan
    assert "Exchange" not in stored and "Bucketed: true" in plan
    assert merged.where("dbt_valid_to IS NULL").count() == source.count()


def test_partitioned_full_rebuild_is_readable_and_current(spark, scratch):
    c, p, o = G.generate(spark, 100, 800, AS_OF, num_partitions=2)
    spark.sql("DROP TABLE IF EXISTS ledger_marts.fct_daily_sales")
    r1 = B.build(spark, c, p, o, scratch, AS_OF, dt.datetime(2025, 1, 1), run_id="f1",
                 tags={"sales"})
    assert r1.published, r1.failures
    t = spark.table("ledger_marts.fct_daily_sales")
    assert t.count() == r1_count(o)
    # second build: 2023 orders disappear (their month partitions must go)
    o2 = o.where(F.year("order_date") == 2024)
    r2 = B.build(spark, c, p, o2, scratch, AS_OF, dt.datetime(2025, 1, 2), run_id="f2",
                 tags={"sales"})
    assert r2.published, r2.failures
    t = spark.table("ledger_marts.fct_daily_sales")
    assert t.count() == r1_count(o2)
    assert t.where("order_year = 2023").count() == 0


def r1_count(orders):
    return orders.where(F.col("status").isin("completed", "shipped")).count()


def test_postflight_reports_missing_and_empty(spark):
    full = spark.range(3).toDF("x")
    empty = spark.range(0).toDF("x")
    rows = {r.table_name: (r.table_exists, r.row_count, r.status) for r in
            B.postflight({"a": full, "b": empty}, ["a", "b", "c"]).collect()}
    assert rows == {"a": (True, 3, "ok"), "b": (True, 0, "empty"), "c": (False, None, "missing")}
