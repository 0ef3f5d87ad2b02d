"""Marts: order-level sales fact, RFM customer dimension, incremental
order fact rows.

Fact -> dimension joins go through ``skew.left_join_dimension``: keys
holding a large share of the orders (a hot product or customer, known
from the load's key statistics, or the NULL key of orders without a
product) are spread over many tasks explicitly; the rest is an ordinary
shuffle join, which AQE may still turn into a broadcast when it measures
a small dimension.  Building these plans runs no job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import as_ts_col, days_between, dow0
from .ranking import Order, with_ntile_single_task, with_ntiles
from .skew import left_join_dimension
from .staging import successful_orders


def fct_daily_sales(stg_orders: DataFrame, stg_products: DataFrame,
                    stg_customers: DataFrame, hot: dict | None = None) -> DataFrame:
    """One row per successful order with customer and product attributes.
    ``hot``: the orders' frequent keys, as the raw load keeps them."""
    o = successful_orders(stg_orders)
    p = stg_products.select("product_id", "product_name", "category", "price_segment",
                            F.col("price").alias("current_price"))
    c = stg_customers.select("customer_id", "country", "country_code", "customer_tier",
                             "is_major_market")
    j = _with_dimensions(o, p, c, hot)
    total, disc, qty = F.col("total_amount"), F.col("estimated_discount"), F.col("quantity")
    return j.select(
        F.col("order_date").alias("sale_date"),
        "order_year", "order_month", "order_quarter", "order_day_of_week",
        "is_weekend", "order_id", "order_category", "quantity", "total_amount",
        "estimated_discount",
        (total - disc).alias("net_revenue"),
        R.safe_ratio(total, qty).alias("avg_item_price"),
        "customer_id", "country", "country_code", "customer_tier", "is_major_market",
        "product_id", "product_name", "category", "price_segment", "current_price",
        R.estimated_margin(total, disc, F.col("current_price"), qty).alias("estimated_margin"),
        R.is_high_value(total).alias("is_high_value"),
        R.is_bulk_order(qty).alias("is_bulk_order"),
        R.is_vip_customer(F.col("customer_tier")).alias("is_vip_customer"),
    )


def _with_dimensions(orders: DataFrame, products: DataFrame, customers: DataFrame,
                     hot: dict | None = None) -> DataFrame:
    """orders LEFT JOIN products LEFT JOIN customers, hot keys split."""
    j = left_join_dimension(orders, products, "product_id", hot)
    return left_join_dimension(j, customers, "customer_id", hot)


def rfm_metrics(stg_orders: DataFrame, as_of, unique_orders: bool = False,
                order_keys: DataFrame | None = None) -> DataFrame:
    """Per-customer recency / frequency / monetary over successful orders.

    Two stages, each with partial aggregation before its shuffle: by
    customer and order month, then by customer, where a month is one row.
    A customer holding a third of all orders ships one row per month and
    map task.  ``frequency`` counts distinct orders: rows, less the repeats of
    a customer's order ids, which one aggregate over (customer, order) finds
    and a union with negative counts takes off; ``unique_orders`` says that a
    gate has found none.  ``order_keys``: (order_id, customer_id) of the same rows,
    if the caller has them more cheaply than from the orders.
    """
    d = F.col("order_date")
    o = successful_orders(stg_orders).select(
        "customer_id", "order_id", "order_date", "quantity",
        (F.year(d) * 100 + F.month(d)).alias("_month"),
        (F.col("total_amount") - F.col("estimated_discount")).alias("net_amount"))
    monthly = o.groupBy("customer_id", "_month").agg(
        F.max(d).alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        F.sum("net_amount").alias("monetary"),
        F.count("net_amount").alias("_n_net"),
        F.min(d).alias("first_order_date"),
        F.sum(R.is_weekend(dow0(d)).cast("int")).alias("weekend_orders"),
        F.sum("quantity").alias("total_items_bought"),
    )
    if not unique_orders:
        keys = (o if order_keys is None else order_keys).where(F.col("order_id").isNotNull())
        again = keys.groupBy("customer_id", "order_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
        repeats = again.groupBy("customer_id").agg(F.sum(1 - F.col("_n")).alias("frequency"))
        monthly = monthly.unionByName(repeats, allowMissingColumns=True)
    agg = monthly.groupBy("customer_id").agg(
        F.max("last_order_date").alias("last_order_date"),
        F.min("first_order_date").alias("first_order_date"),
        F.count("_month").alias("active_months"),
        *[F.sum(c).alias(c) for c in ("frequency", "monetary", "_n_net", "weekend_orders",
                                      "total_items_bought")])
    return agg.select(
        "customer_id", "last_order_date", "frequency", "monetary",
        R.safe_ratio(F.col("monetary"), F.col("_n_net")).alias("avg_order_value"),
        "first_order_date",
        days_between(as_of, F.col("last_order_date")).alias("recency"),
        "active_months", "weekend_orders", "total_items_bought",
    )


#: The quartile orders; ties go by customer id.
SCORES = [Order("r_score", "recency", descending=True), Order("f_score", "frequency"),
          Order("m_score", "monetary")]


def rfm_scores(rfm: DataFrame, distributed: bool = True) -> DataFrame:
    """Quartile scores r/f/m (4 = best) over all customers with orders: a comparison of each row
    with the three cuts of each order."""
    if not distributed:
        for o in SCORES:
            by = F.col(o.value).desc_nulls_first() if o.descending else F.col(o.value).asc_nulls_last()
            rfm = with_ntile_single_task(rfm, 4, [by, F.col("customer_id").asc()], o.out_col)
        return rfm
    return with_ntiles(rfm, "customer_id", 4, SCORES)


def dim_customers(stg_customers: DataFrame, stg_orders: DataFrame, as_of,
                  distributed_ntile: bool = True, unique_orders: bool = False,
                  order_keys: DataFrame | None = None) -> DataFrame:
    scored = rfm_scores(rfm_metrics(stg_orders, as_of, unique_orders, order_keys), distributed_ntile).alias("r")
    c = stg_customers.alias("c")
    j = c.join(scored, F.col("c.customer_id") == F.col("r.customer_id"), "left")
    r, f, m = F.col("r.r_score"), F.col("r.f_score"), F.col("r.m_score")
    recency = F.col("r.recency")
    zero = F.lit(0)
    return j.select(
        "c.customer_id", "c.first_name", "c.last_name", "c.email", "c.registration_date",
        "c.country", "c.country_code", "c.customer_tier",
        F.coalesce("r.first_order_date", "c.registration_date").alias("first_order_date"),
        F.col("r.last_order_date").alias("last_order_date"),
        F.coalesce(F.col("r.frequency"), zero.cast("long")).alias("total_orders"),
        F.coalesce(F.col("r.monetary"), zero).alias("lifetime_value"),
        F.coalesce(F.col("r.avg_order_value"), zero.cast("double")).alias("avg_order_value"),
        recency.alias("days_since_last_order"),
        F.coalesce(F.col("r.active_months"), zero.cast("long")).alias("active_months"),
        F.coalesce(F.col("r.total_items_bought"), zero.cast("long")).alias("total_items_bought"),
        R.rfm_score(r, f, m).alias("rfm_score"),
        R.rfm_segment(r, f, m).alias("rfm_segment"),
        R.activity_status(recency).alias("activity_status"),
        R.churn_risk(recency, F.col("c.customer_tier")).alias("churn_risk"),
    )


def fct_orders_rows(stg_orders: DataFrame, stg_products: DataFrame,
                    stg_customers: DataFrame, run_ts, hot: dict | None = None) -> DataFrame:
    """Rows of the incremental order fact (all statuses)."""
    p = stg_products.select("product_id", "product_name", "category")
    c = stg_customers.select("customer_id", "first_name", "last_name")
    j = _with_dimensions(stg_orders, p, c, hot)
    return j.select(
        "order_id", "customer_id", "product_id", "first_name", "last_name", "product_name",
        "category", "quantity", "order_date", "status", "total_amount", "estimated_discount",
        (F.col("total_amount") - F.col("estimated_discount")).alias("net_amount"),
        as_ts_col(run_ts).alias("loaded_at"),
    )
