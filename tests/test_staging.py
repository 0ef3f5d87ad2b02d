"""Staging views on hand-made rows (NULL and clock-relative paths)."""

import datetime as dt
from decimal import Decimal

from ledgerline.operators import staging as S

AS_OF = dt.date(2028, 12, 31)
CUST = ("customer_id int, first_name string, last_name string, email string, "
        "registration_date date, country string, updated_at date, total_orders int")


def test_stg_customers_rules(spark):
    rows = [
        (1, "Ann", None, "a@x", dt.date(2028, 1, 15), "United States", None, 19),
        (2, "Bob", "Ray", "b@x", dt.date(2027, 5, 2), "UK", dt.date(2029, 6, 1), 100),
        (3, "Cy", "Do", "c@x", dt.date(2028, 12, 1), "Brazil", dt.date(2028, 7, 4), 5),
    ]
    got = {r.customer_id: r for r in
           S.stg_customers(spark.createDataFrame(rows, CUST), AS_OF).collect()}
    a, b, c = got[1], got[2], got[3]
    assert (a.country_code, a.is_major_market, a.customer_tier) == ("US", False, "Bronze")
    assert a.full_name is None                              # '||' with a NULL part
    assert a.updated_at == dt.date(2028, 1, 15) and a.last_updated is None
    assert a.activity_status == "Churned"                   # 351 days
    assert a.cohort_month == dt.date(2028, 1, 1)
    assert b.activity_status == "Active"                    # update in the future
    assert (b.customer_tier, b.country_code, b.days_since_registration) == ("VIP", "GB", 609)
    assert (c.country_code, c.activity_status, c.full_name) == ("Other", "Cold", "Cy Do")


def test_stg_orders_and_products(spark):
    orders = spark.createDataFrame([
        (1, 1, 1, 0, dt.date(2024, 6, 1), "shipped", Decimal("1000.01")),
        (2, 1, None, 5, dt.date(2022, 12, 31), "completed", Decimal("10.00")),
        (3, 1, 2, 5, dt.date(2023, 1, 1), "on_hold", Decimal("150.00")),
    ], "order_id int, customer_id int, product_id int, quantity int, order_date date, "
       "status string, total_amount decimal(10,2)")
    got = {r.order_id: r for r in S.stg_orders(orders).collect()}
    assert set(got) == {1, 3}                               # before 2023 dropped
    o1, o3 = got[1], got[3]
    assert o1.unit_price is None and o1.is_weekend and o1.order_day_of_week == 6
    assert Decimal(o1.estimated_discount) == Decimal("150.0015")
    assert (o3.order_category, Decimal(o3.estimated_discount)) == ("unknown", Decimal("4.5000"))
    products = spark.createDataFrame([
        (1, "P", "Garden", None, dt.date(2028, 12, 1)),
        (2, "Q", "Home", Decimal("1000.00"), dt.date(2028, 11, 30)),
    ], "product_id int, product_name string, category string, price decimal(10,2), "
       "created_at date")
    p = {r.product_id: r for r in S.stg_products(products, AS_OF).collect()}
    assert (p[1].price_segment, p[1].price_category, p[1].category_group) == \
        ("unknown", "budget", "Other")
    assert (p[1].is_new_arrival, p[2].is_new_arrival) == (True, False)
    assert (p[2].price_segment, p[2].days_since_created) == ("medium", 31)
