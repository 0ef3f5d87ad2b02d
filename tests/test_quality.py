"""Quality checks on hand-made frames: each kind, NULL handling, gate."""

import datetime as dt

from ledgerline.operators import quality as Q
from ledgerline.operators.quality import Check

D = dt.date


def _results(spark, models, checks, as_of=D(2024, 1, 10)):
    out = Q.run_checks(models, checks, as_of=as_of)
    return {(r.test, r.column_name, r.rule): r.failures for r in out.collect()}


def test_each_kind(spark):
    orders = spark.createDataFrame([
        (1, 10, "completed", 5, D(2024, 1, 1)),
        (2, 10, "weird", 0, D(2024, 2, 1)),       # bad status, qty 0, future date
        (2, 99, "weird", 101, D(2022, 1, 1)),     # duplicate id, orphan, old date
        (3, None, None, None, None),              # NULLs pass all but not_null
        (4, 11, "odd", 7, D(2024, 1, 2)),
    ], "order_id int, customer_id int, status string, quantity int, order_date date")
    customers = spark.createDataFrame([(10,), (11,)], "customer_id int")
    checks = [
        Check("unique", "o", "order_id"),
        Check("not_null", "o", "customer_id"),
        Check("accepted_values", "o", "status", values=("completed", "pending")),
        Check("relationships", "o", "customer_id", to="c", field_name="customer_id"),
        Check("accepted_range", "o", "quantity", min_value=1, max_value=100),
        Check("expression_is_true", "o", "order_date", expression="<= CURRENT_DATE"),
        Check("expression_is_true", "o", "order_date", expression=">= '2023-01-01'"),
    ]
    got = _results(spark, {"o": orders, "c": customers}, checks)
    assert got[("unique", "order_id", "")] == 1
    assert got[("not_null", "customer_id", "")] == 1
    # two distinct invalid values ('weird' twice, 'odd' once)
    assert got[("accepted_values", "status", "in (completed, pending)")] == 2
    assert got[("relationships", "customer_id", "c.customer_id")] == 1
    assert got[("accepted_range", "quantity", ">= 1 and <= 100")] == 2
    assert got[("expression_is_true", "order_date", "<= CURRENT_DATE")] == 1
    assert got[("expression_is_true", "order_date", ">= '2023-01-01'")] == 1


def test_gate_and_singular(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0)], "order_id int, total_amount double")
    from pyspark.sql import functions as F
    bad = Q.singular(df, F.col("total_amount") < 0, "neg", "o", ["order_id", "total_amount"])
    assert [tuple(r) for r in bad.collect()] == [(2, -1.0)]
    ok = Q.gate(Q.run_checks({"o": df}, [Check("not_null", "o", "order_id")]))
    assert ok.passed
    fail = Q.gate(Q.run_checks({"o": df}, [Check("accepted_range", "o", "total_amount",
                                                  min_value=0)]))
    assert not fail.passed and fail.failures[0]["failures"] == 1


def test_freshness(spark):
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, 0, 0)), ("b", dt.datetime(2024, 1, 2, 12, 0)),
         ("c", dt.datetime(2024, 1, 3, 0, 0))], "src string, ts timestamp_ntz")
    run = dt.datetime(2024, 1, 3, 6, 0)
    got = {r.src: r.status for r in Q.source_freshness(df, "ts", run, by=["src"]).collect()}
    assert got == {"a": "error", "b": "pass", "c": "pass"}
    got = {r.src: r.status for r in
           Q.source_freshness(df, "ts", dt.datetime(2024, 1, 4, 1, 0), by=["src"]).collect()}
    assert got == {"a": "error", "b": "warn", "c": "warn"}


def test_declared_suite_size():
    from ledgerline.plans.suite import SUITE, suite_counts
    assert len(SUITE) == 58
    assert suite_counts() == {"unique": 8, "not_null": 32, "accepted_values": 8,
                              "relationships": 3, "accepted_range": 4,
                              "expression_is_true": 3}


def test_singular_result_row(spark):
    df = spark.createDataFrame([(1, 5.0), (2, -1.0), (3, None)], "order_id int, total_amount double")
    r = Q.singular_result(df, "total_amount < 0", "stg_orders", "total_amount").first()
    assert (r.test, r.model, r.failures) == ("singular", "stg_orders", 1)
