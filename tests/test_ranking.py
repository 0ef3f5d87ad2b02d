"""Selected cuts must give the single-task window NTILE exactly."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.ranking import Order, tile_ends, with_ntile_single_task, with_ntiles


def _compare(spark, rows, n, fetch, kind="int"):
    df = spark.createDataFrame(rows, f"id long, v {kind}").repartition(3).cache()
    up, down = Order("up", "v"), Order("down", "v", descending=True)
    got = with_ntiles(df, "id", n, [up, down], fetch)
    a = {r.id: (r.up, r.down) for r in got.collect()}
    ref = with_ntile_single_task(df, n, [F.col("v").asc_nulls_last(), F.col("id").asc()], "up")
    ref = with_ntile_single_task(ref, n, [F.col("v").desc_nulls_first(), F.col("id").asc()], "down")
    assert a == {r.id: (r.up, r.down) for r in ref.collect()}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "RDDScan" not in plan


@pytest.mark.parametrize("fetch", [2, 4096])
def test_small_sizes_with_ties(spark, fetch):
    rnd = random.Random(7)
    for size in [0, 1, 2, 3, 4, 5, 7, 11, 17, 50]:
        _compare(spark, [(i, rnd.choice([None, 1, 2, 2, 3])) for i in range(size)], 4, fetch)


def test_every_size_up_to_fifty_has_the_right_ends(spark):
    for n in (1, 3, 4, 5):
        for size in range(51):
            tiles = [1 + sum(i > e for e in tile_ends(size, n)) for i in range(size)]
            want = [r[0] for r in spark.range(size).select(F.expr(f"ntile({n}) over (order by id)")).collect()] \
                if size in (0, 1, 2, 3, 9, 50) else None
            lengths = [tiles.count(t) for t in range(1, n + 1)]
            assert lengths == [size // n + (t < size % n) for t in range(n)]
            assert want is None or tiles == want


def test_other_bucket_counts_and_null_id(spark):
    rows = [(i, i % 3) for i in range(7)] + [(None, 1)]
    for n in (1, 2, 5):
        _compare(spark, rows, n, 2)


def test_heavy_ties_split_by_id(spark):
    # one value holds a third of the rows, NULL a tenth: cuts inside them need the id
    rows = [(i * 7919 % 3001, None if i % 10 == 1 else 0 if i % 3 == 0 else i % 97) for i in range(3000)]
    _compare(spark, rows, 4, 20)


def test_money_and_keys_that_doubles_cannot_tell_apart(spark):
    from decimal import Decimal
    big = (1 << 60)
    rows = [(big + i, Decimal(i % 50) / 100 + Decimal(10) ** 17) for i in range(400)]
    _compare(spark, rows, 4, 5, "decimal(20,2)")
    _compare(spark, [(big + i, big + i % 7) for i in range(300)], 3, 5, "bigint")


def test_dim_customers_has_no_join_back(spark):
    from conftest import SF_SMALL
    from ledgerline.operators import marts as M
    from ledgerline.plans.registry import Inputs
    i = Inputs(spark, SF_SMALL)
    d = M.dim_customers(i.stg_customers, i.stg_orders, i.as_of, unique_orders=True)
    plan = d._jdf.queryExecution().executedPlan().toString()
    plan = plan.split("Initial Plan")[0]
    assert plan.count("Join") <= 2  # the customers' own, and the order lines of the test tables
    assert "RDDScan" not in plan and "Window" not in plan
