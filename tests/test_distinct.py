"""Distinct orders and customers where keys repeat: once each, whatever the path."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import analytics as A
from ledgerline.operators import marts as M
from ledgerline.operators import staging as S

DAY = dt.date(2024, 5, 6)
ORDERS = ("order_id long, customer_id long, product_id long, quantity int, order_date date, status string, "
          "total_amount decimal(10,2)")


def _layers(spark, rows):
    o = S.stg_orders(spark.createDataFrame([(k, c, 1, 2, d, "completed", Decimal(10)) for k, c, d in rows], ORDERS))
    p = S.stg_products(spark.createDataFrame([(1, "P", "Books", Decimal(5), DAY)], "product_id long, product_name string, "
                                             "category string, price decimal(10,2), created_at date"), DAY)
    c = S.stg_customers(spark.createDataFrame(
        [(i, "A", "B", "e", DAY, "UK", DAY, 7) for i in (1, 1, 2, 3)],
        "customer_id long, first_name string, last_name string, email string, registration_date date, "
        "country string, updated_at date, total_orders int"), DAY)
    return o, p, c


ROWS = [(10, 2, DAY), (10, 2, DAY),                       # one order loaded twice
        (11, 2, DAY), (11, 3, DAY), (11, 3, DAY),         # one order id of two customers
        (12, 3, DAY + dt.timedelta(31)), (12, 3, DAY),    # one order id on two days
        (None, 2, DAY), (None, 3, DAY), (None, 3, DAY),   # no order id: rows without an order
        (13, None, DAY)]


def test_summary_counts_keys_once(spark):
    o, p, c = _layers(spark, ROWS)
    fct = M.fct_daily_sales(o, p, c)
    got = {(r.sale_date, r.country): r for r in A.daily_sales_summary(fct, ordered=False).collect()}
    day = got[DAY, "UK"]
    assert (day.total_orders, day.unique_customers, day.total_items_sold) == (3, 2, 18)  # 10, 11, 12
    assert float(day.gross_revenue) == 90.0
    assert got[DAY + dt.timedelta(31), "UK"].total_orders == 1
    unknown = got[DAY, None]
    assert (unknown.total_orders, unknown.unique_customers) == (1, 0)


def test_both_paths_agree_without_repeats(spark):
    o, p, c = _layers(spark, [(i, i % 3 + 1 if i % 5 else None, DAY + dt.timedelta(i % 2)) for i in range(40)] + [(None, 2, DAY)])
    fct = M.fct_daily_sales(o, p, c.dropDuplicates(["customer_id"]))
    one, other = (sorted(map(tuple, A.daily_sales_summary(fct, False, u).collect()), key=repr) for u in (False, True))
    assert one == other


def test_frequency_counts_orders_once(spark):
    o, _, _ = _layers(spark, ROWS)
    got = {r.customer_id: (r.frequency, r.active_months, float(r.monetary)) for r in M.rfm_metrics(o, DAY).collect()}
    net = float(o.selectExpr("total_amount - estimated_discount").first()[0])
    assert got == {2: (2, 1, 4 * net), 3: (2, 2, 6 * net), None: (1, 1, net)}
    keys = o.select("order_id", "customer_id")
    assert {r.customer_id: r.frequency for r in M.rfm_metrics(o, DAY, order_keys=keys).collect()} == {2: 2, 3: 2, None: 1}


def test_a_customer_listed_twice_is_active_once(spark):
    o, _, c = _layers(spark, [(1, 1, DAY), (2, 2, DAY)])
    (row,) = A.customer_cohorts(c, o).collect()
    net = float(o.selectExpr("total_amount - estimated_discount").first()[0])
    assert row.active_customers == 2 and float(row.total_revenue) == 3 * net  # the join doubles its revenue
