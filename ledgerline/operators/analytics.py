"""Analytics: daily sales summary with trend windows, retention cohorts.

Money stays exact (decimal sums); every average or share is one double
division of two exact aggregates, so the bits do not depend on the order
in which partial sums arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.dates import month_start, months_between_starts
from .staging import successful_orders

SUMMARY_KEYS = ["sale_date", "order_year", "order_month", "order_quarter",
                "country", "country_code", "is_major_market", "category",
                "price_segment"]
TREND_PARTITION = ["country", "category"]
LAG_ROWS = 7
ROLLING_ROWS = 7


def _trend_window() -> Window:
    # LAG and the moving frame count rows, not days.  Several rows share a
    # sale_date inside one (country, category) (one per price segment), so
    # price_segment breaks the tie deterministically.
    return (Window.partitionBy(*TREND_PARTITION)
            .orderBy(F.col("sale_date").asc_nulls_last(),
                     F.col("price_segment").asc_nulls_last()))


def _measures() -> dict:
    """Row values whose sums make up the summary (a count is a sum of ones)."""
    per_item = R.safe_ratio(F.col("net_revenue"), F.col("quantity")).cast("decimal(28,10)")
    one = lambda cond: F.when(cond, 1).otherwise(0)
    of = lambda flag, value: F.when(F.col(flag), value).otherwise(0)
    return {
        "total_items_sold": F.col("quantity"), "gross_revenue": F.col("total_amount"),
        "net_revenue": F.col("net_revenue"), "estimated_margin": F.col("estimated_margin"),
        "_n_total": one(F.col("total_amount").isNotNull()),
        "_sum_per_item": per_item, "_n_per_item": one(per_item.isNotNull()),
        "high_value_orders": of("is_high_value", F.lit(1)), "bulk_orders": of("is_bulk_order", F.lit(1)),
        "vip_orders": of("is_vip_customer", F.lit(1)),
        "_hv_net": of("is_high_value", F.col("net_revenue")), "_we_net": of("is_weekend", F.col("net_revenue")),
    }


def _once_per_order(fct: DataFrame, measures: dict) -> DataFrame:
    """One row per order and customer of a day's group, for orders on several rows: the order's sums
    and its count (``_order``) on the first.  Rows without an order id are told apart by customer, so
    no group of theirs grows beyond a customer's."""
    without = F.when(F.col("order_id").isNull(), F.col("customer_id")).alias("_without_order")
    per_order = fct.groupBy(*SUMMARY_KEYS, "order_id", without).agg(
        *[F.sum(m).alias(name) for name, m in measures.items()],
        F.collect_set("customer_id").alias("_customers"))
    rows = per_order.select("*", F.posexplode_outer("_customers").alias("_place", "customer_id"))
    first = F.coalesce(F.col("_place"), F.lit(0)) == 0
    return rows.select(
        *SUMMARY_KEYS, "customer_id", *[F.when(first, F.col(name)).alias(name) for name in measures],
        F.when(first & F.col("order_id").isNotNull(), 1).otherwise(0).alias("_order"))


def daily_aggregates(fct: DataFrame, unique_orders: bool = False) -> DataFrame:
    """The nine-key daily grain with all plain aggregates.

    Each stage has partial aggregation before its shuffle: by the nine keys
    and the customer, then by the nine keys, where a customer is one row.  So
    the distinct customers are counted without expanding the fact.  Distinct
    orders take a stage before these, by the nine keys and the order, which
    ``unique_orders`` (a gate has found no repeated order id) leaves out.
    """
    measures = _measures()
    if unique_orders:
        rows = fct.select(*SUMMARY_KEYS, "customer_id", *[m.alias(name) for name, m in measures.items()],
                          F.when(F.col("order_id").isNotNull(), 1).otherwise(0).alias("_order"))
    else:
        rows = _once_per_order(fct, measures)
    by_customer = rows.groupBy(*SUMMARY_KEYS, "customer_id").agg(
        F.sum("_order").alias("total_orders"), *[F.sum(name).alias(name) for name in measures])
    totals = [c for c in by_customer.columns if c not in (*SUMMARY_KEYS, "customer_id")]
    g = by_customer.groupBy(*SUMMARY_KEYS).agg(
        F.count("customer_id").alias("unique_customers"),
        *[F.sum(c).alias(c) for c in totals])
    return g.select(
        *SUMMARY_KEYS, "total_orders", "unique_customers", "total_items_sold",
        "gross_revenue", "net_revenue", "estimated_margin",
        R.safe_ratio(F.col("gross_revenue"), F.col("_n_total")).alias("avg_order_value"),
        R.safe_ratio(F.col("_sum_per_item"), F.col("_n_per_item")).alias("avg_revenue_per_item"),
        R.safe_ratio(F.col("net_revenue"), F.col("unique_customers"))
        .alias("avg_revenue_per_customer"),
        "high_value_orders", "bulk_orders", "vip_orders",
        R.safe_ratio(F.col("_hv_net"), F.col("net_revenue")).alias("high_value_revenue_share"),
        R.safe_ratio(F.col("_we_net"), F.col("net_revenue")).alias("weekend_revenue_share"),
    )


def with_trends(daily: DataFrame) -> DataFrame:
    """Week-over-week change (row lag 7) and 7-row moving average.

    LAG and the moving frame share one partitioning and one sort.  The
    (country, category) partitions hold aggregated rows only, so a hot
    partition is bounded by the calendar, not by the order count.
    """
    w = _trend_window()
    frame = w.rowsBetween(-(ROLLING_ROWS - 1), 0)
    prev = F.lag("net_revenue", LAG_ROWS).over(w)
    return daily.select(
        "*",
        (F.col("net_revenue") - prev).alias("weekly_revenue_change"),
        (R.safe_ratio(F.col("net_revenue"), prev) - 1).alias("weekly_growth_rate"),
        R.safe_ratio(F.sum("net_revenue").over(frame), F.count("net_revenue").over(frame))
        .alias("rolling_7day_avg_revenue"),
    )


def daily_sales_summary(fct: DataFrame, ordered: bool = True, unique_orders: bool = False) -> DataFrame:
    out = with_trends(daily_aggregates(fct, unique_orders))
    if ordered:
        # reference order: DESC puts NULLs first
        out = out.orderBy(F.col("sale_date").desc_nulls_first(),
                          F.col("gross_revenue").desc_nulls_first())
    return out


def cohort_size(stg_customers: DataFrame) -> DataFrame:
    """Customers per registration month (one row per month)."""
    return (stg_customers
            .select(month_start(F.col("registration_date")).alias("cohort_month"),
                    "customer_id")
            .groupBy("cohort_month")
            .agg(F.count_distinct("customer_id").alias("cohort_size")))


def customer_cohorts(stg_customers: DataFrame, stg_orders: DataFrame,
                     ordered: bool = True) -> DataFrame:
    """Active customers, revenue and retention per (cohort month, order month).

    Orders are first reduced to one row per (customer, order month) and
    customers to one row per (customer, cohort month), so active customers
    are counted as rows and the join sees at most one row per active month
    of a customer (a customer listed several times counts once, with its
    revenue as often as it is listed);
    the cohort sizes (one row per month) are joined only after the final
    aggregation, which is equivalent because the size is constant per
    cohort month.
    """
    monthly = (successful_orders(stg_orders)
               .select("customer_id", month_start(F.col("order_date")).alias("order_month"),
                       (F.col("total_amount") - F.col("estimated_discount")).alias("net"))
               .groupBy("customer_id", "order_month")
               .agg(F.sum("net").alias("net")))
    # the shuffle by customer serves the aggregate and the join
    cust = (stg_customers.select("customer_id", month_start(F.col("registration_date")).alias("cohort_month"))
            .repartition("customer_id").groupBy("customer_id", "cohort_month")
            .agg(F.count(F.lit(1)).alias("_listed")))
    revenue = F.sum("net")
    again = F.sum(F.when(F.col("_listed") > 1, F.col("net") * (F.col("_listed") - 1).cast("decimal(5,0)")))
    act = (cust.join(monthly, "customer_id")
           .groupBy("cohort_month", "order_month")
           .agg(F.count("customer_id").alias("active_customers"),
                (revenue + F.coalesce(again, F.lit(0))).alias("total_revenue")))
    # one row per registration month: bounded by the calendar
    sizes = F.broadcast(cohort_size(stg_customers))
    out = act.join(sizes, "cohort_month").select(
        "cohort_month", "order_month",
        months_between_starts(F.col("order_month"), F.col("cohort_month")).alias("period_number"),
        "active_customers", "total_revenue",
        R.safe_ratio(F.col("total_revenue"), F.col("active_customers"))
        .alias("avg_revenue_per_active_customer"),
        R.safe_ratio(F.col("active_customers") * 100, F.col("cohort_size"))
        .alias("retention_rate"),
    )
    if ordered:
        out = out.orderBy(F.col("cohort_month").asc_nulls_last(),
                          F.col("order_month").asc_nulls_last())
    return out
