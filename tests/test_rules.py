"""Boundary values of every named rule, and the 64-cell RFM table."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerline.functions import rules as R
from ledgerline.functions.dates import days_between, dow0, months_between_starts


def _eval(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr.alias("x")).collect()]


def test_customer_tier_boundaries(spark):
    vals = [4, 5, 19, 20, 49, 50, 99, 100, None]
    got = _eval(spark, [(v,) for v in vals], "n int", R.customer_tier(F.col("n")))
    assert got == ["New", "Bronze", "Bronze", "Silver", "Silver", "Gold", "Gold", "VIP", "New"]


def test_price_segment_and_category(spark):
    vals = [None, Decimal("100.00"), Decimal("100.01"), Decimal("1000.00"), Decimal("1000.01")]
    rows = [(v,) for v in vals]
    seg = _eval(spark, rows, "p decimal(10,2)", R.price_segment(F.col("p")))
    cat = _eval(spark, rows, "p decimal(10,2)", R.price_category(F.col("p")))
    assert seg == ["unknown", "budget", "medium", "medium", "premium"]
    assert cat == ["budget", "budget", "medium", "medium", "premium"]


def test_estimated_discount_tiers(spark):
    rows = [(Decimal(t), q) for t in ["200.00", "200.01", "500.00", "500.01", "1000.00",
                                      "1000.01"] for q in (1, 4, 5)]
    got = _eval(spark, rows, "t decimal(10,2), q int",
                R.estimated_discount(F.col("t"), F.col("q")))
    expect = []
    for t, q in rows:
        if t > 1000:
            expect.append(t * Decimal("0.15"))
        elif t > 500:
            expect.append(t * Decimal("0.10"))
        elif t > 200:
            expect.append(t * Decimal("0.05"))
        elif q >= 5:
            expect.append(t * Decimal("0.03"))
        else:
            expect.append(Decimal(0))
    assert [Decimal(g) for g in got] == expect


def test_flat_discount(spark):
    got = _eval(spark, [(Decimal("500.00"),), (Decimal("500.01"),)], "t decimal(10,2)",
                R.flat_discount(F.col("t")))
    assert [Decimal(g) for g in got] == [Decimal(0), Decimal("100.002")]


def test_activity_and_churn(spark):
    vals = [None, 30, 31, 90, 91, 180, 181]
    act = _eval(spark, [(v,) for v in vals], "d int", R.activity_status(F.col("d")))
    assert act == ["Churned", "Active", "Warm", "Warm", "Cold", "Cold", "Churned"]
    rows = [(None, "VIP"), (91, "VIP"), (91, "Silver"), (181, "Gold"), (181, "New"), (90, "VIP")]
    churn = _eval(spark, rows, "d int, t string", R.churn_risk(F.col("d"), F.col("t")))
    assert churn == ["Active", "High Risk", "Active", "High Risk", "Likely Churned", "Active"]


def test_country_rules(spark):
    vals = ["Russia", "USA", "United States", "UK", "United Kingdom", "Germany", "France",
            "Japan", "Brazil", None]
    code = _eval(spark, [(v,) for v in vals], "c string", R.country_code(F.col("c")))
    major = _eval(spark, [(v,) for v in vals], "c string", R.is_major_market(F.col("c")))
    assert code == ["RU", "US", "US", "GB", "GB", "DE", "FR", "JP", "Other", "Other"]
    # 'United States' has code US but is not a major market
    assert major == [True, True, False, True, False, True, False, False, False, False]


def test_order_category_and_groups(spark):
    vals = ["completed", "shipped", "pending", "cancelled", "refunded", "on_hold", None]
    got = _eval(spark, [(v,) for v in vals], "s string", R.order_category(F.col("s")))
    assert got == ["successful", "successful", "in_progress", "failed", "failed", "unknown",
                   "unknown"]
    cats = ["Electronics", "Home", "Clothing", "Books", "Garden"]
    grp = _eval(spark, [(v,) for v in cats], "c string", R.category_group(F.col("c")))
    assert grp == ["High Value", "High Value", "Fashion", "Education", "Other"]


def test_day_of_week_zero_is_sunday(spark):
    days = [dt.date(2024, 6, 1), dt.date(2024, 6, 2), dt.date(2024, 5, 31)]  # Sat, Sun, Fri
    got = _eval(spark, [(d,) for d in days], "d date", dow0(F.col("d")))
    weekend = _eval(spark, [(d,) for d in days], "d date", R.is_weekend(dow0(F.col("d"))))
    assert got == [6, 0, 5]
    assert weekend == [True, True, False]


def test_date_arithmetic(spark):
    rows = [(dt.date(2028, 12, 1), dt.date(2028, 12, 31))]
    got = _eval(spark, rows, "a date, b date", days_between(F.col("b"), F.col("a")))
    assert got == [30]
    rows = [(dt.date(2027, 3, 1), dt.date(2028, 1, 1)), (dt.date(2028, 1, 1), dt.date(2027, 3, 1))]
    got = _eval(spark, rows, "a date, b date", months_between_starts(F.col("b"), F.col("a")))
    assert got == [10, -10]


def test_null_string_semantics(spark):
    rows = [("a", None), ("a", "b")]
    strict = _eval(spark, rows, "x string, y string",
                   F.concat(F.col("x"), F.lit(" "), F.col("y")))
    skip = _eval(spark, rows, "x string, y string", R.rfm_score(F.col("x"), F.col("y"), F.lit(None)))
    assert strict == [None, "a b"]
    assert skip == ["a", "ab"]


# Expected RFM segment per (r, f, m) cell: first matching rule.
EXPECTED_SEGMENT_CELLS = {
    "Champions": {"444"},
    "Loyal Customers": {"333", "334", "343", "344", "433", "434", "443"},
    "Potential Loyalists": {"312", "313", "314", "322", "323", "324", "332", "342", "412", "413",
                            "414", "422", "423", "424", "432", "442"},
    "New Customers": {"411", "421"},
    "Lost": {"111", "112", "121", "211", "212", "221"},
    "Others": {"113", "114", "131", "141", "213", "214", "231", "241", "311", "321", "331",
               "341", "431", "441"},
}


def test_rfm_truth_table(spark):
    cells = [(r, f, m) for r in range(1, 5) for f in range(1, 5) for m in range(1, 5)]
    df = spark.createDataFrame(cells, "r int, f int, m int")
    got = {(x.r, x.f, x.m): x.s for x in df.select(
        "r", "f", "m", R.rfm_segment(F.col("r"), F.col("f"), F.col("m")).alias("s")).collect()}
    for (r, f, m), seg in got.items():
        key = f"{r}{f}{m}"
        expected = next((s for s, ks in EXPECTED_SEGMENT_CELLS.items() if key in ks), "At Risk")
        assert seg == expected, key
    at_risk = [k for k, v in got.items() if v == "At Risk"]
    assert len(at_risk) == 18 and all(r <= 2 and f >= 2 and m >= 2 for r, f, m in at_risk)
    # customers without orders: NULL scores -> 'Others' and empty score
    none = spark.range(1).select(
        R.rfm_segment(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int")),
        R.rfm_score(F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("int"))
    ).first()
    assert tuple(none) == ("Others", "")
