"""Staging layer: cleaned views over the raw tables.

Each function is a lazy projection (plus one filter for orders); Catalyst
collapses them into the consumers' scans, so staging costs nothing extra.
``as_of`` replaces the reference's CURRENT_DATE so results never depend on
the wall clock.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import days_between, dow0, month_start

# Fixed value: orders before this date are not staged.
ORDERS_START = _dt.date(2023, 1, 1)


def stg_customers(raw_customers: DataFrame, as_of) -> DataFrame:
    c = raw_customers
    updated = F.coalesce(F.col("updated_at"), F.col("registration_date"))
    return c.select(
        "customer_id", "first_name", "last_name", "email", "registration_date", "country",
        R.country_code(F.col("country")).alias("country_code"),
        updated.alias("updated_at"),
        R.customer_tier(F.col("total_orders")).alias("customer_tier"),
        days_between(as_of, F.col("registration_date")).alias("days_since_registration"),
        R.is_major_market(F.col("country")).alias("is_major_market"),
        R.activity_status(days_between(as_of, updated)).alias("activity_status"),
        month_start(F.col("registration_date")).alias("cohort_month"),
        "total_orders",
        F.col("updated_at").alias("last_updated"),
        # '||' semantics: NULL when any part is NULL
        F.concat(F.col("first_name"), F.lit(" "), F.col("last_name")).alias("full_name"),
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    o = raw_orders.where(F.col("order_date") >= F.lit(ORDERS_START))
    d = F.col("order_date")
    return o.select(
        "order_id", "customer_id", "product_id", "quantity", "order_date", "status",
        "total_amount",
        R.safe_ratio(F.col("total_amount"), F.col("quantity")).alias("unit_price"),
        R.order_category(F.col("status")).alias("order_category"),
        F.year(d).alias("order_year"),
        F.month(d).alias("order_month"),
        F.quarter(d).alias("order_quarter"),
        dow0(d).alias("order_day_of_week"),
        R.estimated_discount(F.col("total_amount"), F.col("quantity")).alias("estimated_discount"),
        R.is_weekend(dow0(d)).alias("is_weekend"),
    )


def successful_orders(stg_orders_df: DataFrame) -> DataFrame:
    """Orders whose category is 'successful'.

    The status test is stated next to the derived category so that the
    predicate can reach the scan as a plain IN filter.
    """
    return stg_orders_df.where(F.col("status").isin(R.SUCCESSFUL_STATUSES)
                               & (F.col("order_category") == R.SUCCESSFUL))


def stg_products(raw_products: DataFrame, as_of) -> DataFrame:
    p = raw_products
    age = days_between(as_of, F.col("created_at"))
    return p.select(
        "product_id", "product_name", "category", "price", "created_at",
        R.price_segment(F.col("price")).alias("price_segment"),
        R.price_category(F.col("price")).alias("price_category"),
        age.alias("days_since_created"),
        R.is_new_arrival(age).alias("is_new_arrival"),
        R.category_group(F.col("category")).alias("category_group"),
    )
