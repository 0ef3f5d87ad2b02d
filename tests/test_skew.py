"""Hot-key-safe dimension join: same rows as a plain left join, both paths."""

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import skew


@pytest.fixture()
def hot_fixture(spark):
    # key 7 holds a third of the fact, NULL another tenth; dim has a
    # duplicated key and misses some keys
    fact = spark.range(3000).select(
        F.col("id").alias("row_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7))
         .when(F.col("id") % 10 == 1, F.lit(None))
         .otherwise(F.col("id") % 50).cast("int").alias("k"))
    dim = spark.createDataFrame([(k, f"a{k}") for k in range(0, 45)] + [(3, "dup")],
                                "k int, attr string")
    return fact, dim


def _rows(df):
    return sorted(tuple(r) for r in df.select("row_id", "k", "attr").collect())


def _hot(fact):
    return skew.hot_keys(skew.key_sketch(fact, ["k"]))


def test_buckets_follow_the_share(spark, hot_fixture):
    fact, _ = hot_fixture
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = _hot(fact)
    assert len(hot["keys"]["k"]) <= 100
    assert skew.buckets(hot, "k", partitions)[7] == -(-fact.where("k = 7").count() * partitions // fact.count())
    assert skew.buckets(None, "k", partitions) == skew.buckets({"n_rows": 0, "keys": {}}, "k", partitions) == {}


def test_sketches_of_parts_merge(spark, hot_fixture, scratch):
    fact, _ = hot_fixture
    for n in range(3):
        skew.key_sketch(fact.where(F.col("row_id") % 3 == n), ["k"]).write.parquet(f"{scratch}/part={n}")
    parts = spark.read.parquet(scratch).drop("part")
    merged, whole = skew.hot_keys(skew.merge_sketches(parts)), _hot(fact)
    assert merged["n_rows"] == whole["n_rows"] == 3000
    assert sorted(merged["keys"]["k"]) == sorted(whole["keys"]["k"])


def test_building_a_fact_runs_no_job(spark):
    from conftest import SF_SMALL
    from ledgerline.plans.registry import Inputs
    i = Inputs(spark, SF_SMALL)
    orders, products, customers = i.stg_orders, i.stg_products, i.stg_customers
    from ledgerline.operators import marts as M
    hot = {"n_rows": 90, "keys": {"product_id": [[1, 30]], "customer_id": [[2, 30]]}}
    sc = spark.sparkContext
    sc.setJobGroup("building", "no job")
    try:
        facts = [M.fct_daily_sales(orders, products, customers, hot),
                 M.fct_orders_rows(orders, products, customers, i.run_ts, hot)]
        assert list(sc.statusTracker().getJobIdsForGroup("building")) == []
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert facts[0].count() == M.fct_daily_sales(orders, products, customers).count()


def test_hot_and_null_keys_are_spread(spark, hot_fixture):
    """With statistics no partition of the fact side holds a hot key's rows alone; NULL needs none."""
    fact, dim = hot_fixture
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(old, ("-1", "false")):
            spark.conf.set(k, v)
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        most = {}
        for name, hot in (("without", None), ("with", _hot(fact))):
            joined = skew.left_join_dimension(fact, dim, "k", hot)
            per = joined.groupBy(F.spark_partition_id().alias("p")).agg(
                F.count_if(F.col("k") == 7).alias("hot"), F.count_if(F.col("k").isNull()).alias("null")).collect()
            most[name] = max(r.hot for r in per), max(r.null for r in per)
        total = fact.where("k = 7").count()
        assert most["without"][0] >= total and most["with"][0] < total
        assert max(m[1] for m in most.values()) < fact.where("k is null").count() / 2
        assert n >= 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("threshold", ["-1", "10m"])
def test_same_rows_as_plain_left_join(spark, hot_fixture, threshold):
    fact, dim = hot_fixture
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = skew.left_join_dimension(fact, dim, "k", _hot(fact))
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "_skew_salt" in plan  # one plan, whatever the size
        expect = fact.join(dim, "k", "left")
        assert _rows(got) == _rows(expect)
        assert _rows(skew.left_join_dimension(fact, dim, "k")) == _rows(expect)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_registered_fact_on_salted_path_matches_oracle(spark):
    import duckdb

    import __spark_entry__ as E
    from conftest import SF_SMALL
    from scripts.check_oracle import rows_of
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sdf = E.queries()["fct_daily_sales"](spark, SF_SMALL)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    con = duckdb.connect()
    for t in ("customer", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    rel = con.sql(E.oracle_sql()["fct_daily_sales"])
    assert rows_of(sdf.columns, srows) == rows_of(rel.columns, rel.fetchall())
