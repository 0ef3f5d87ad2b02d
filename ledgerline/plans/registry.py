"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables through the test binding, runs the
library's operators over the whole tables and returns a lazy DataFrame.
Decimal money columns are exposed as doubles at this boundary only (one
exact decimal -> double cast per value), the library itself keeps them
exact.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import analytics as A
from ..operators import marts as M
from ..operators import staging as S
from ..sources import testbind as TB

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        _REGISTRY[name] = fn
        return fn
    return deco


def all_queries() -> dict[str, QueryFn]:
    # import the modules that register further queries
    from . import registry_more  # noqa: F401
    return dict(_REGISTRY)


def exposed(df: DataFrame) -> DataFrame:
    """Decimals -> double, the only conversion at the query boundary."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(cols)


class Inputs:
    """Lazily built layers over one sf directory (each a lazy DataFrame)."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of=TB.AS_OF, run_ts=TB.RUN_TS):
        self.spark, self.sf_dir, self.as_of, self.run_ts = spark, sf_dir, as_of, run_ts
        self.raw = TB.load_raw(spark, sf_dir)

    @property
    def stg_customers(self):
        return S.stg_customers(self.raw.customers, self.as_of)

    @property
    def stg_orders(self):
        return S.stg_orders(self.raw.orders)

    @property
    def stg_products(self):
        return S.stg_products(self.raw.products, self.as_of)

    @property
    def order_keys(self):
        """(order_id, customer_id) of the successful orders, from the orders table alone."""
        return S.successful_orders(S.stg_orders(TB.raw_orders_alone(self.spark, self.sf_dir))).select(
            "order_id", "customer_id")

    def dim_customers(self):
        return M.dim_customers(self.stg_customers, self.stg_orders, self.as_of, order_keys=self.order_keys)

    def fct_daily_sales(self, orders=None):
        return M.fct_daily_sales(self.stg_orders if orders is None else orders, self.stg_products,
                                 self.stg_customers)

    def daily_sales_summary(self, ordered=True):
        return A.daily_sales_summary(self.fct_daily_sales(), ordered)


@register("raw_customers")
def q_raw_customers(spark, sf_dir):
    return exposed(TB.raw_customers(spark, sf_dir))


@register("raw_products")
def q_raw_products(spark, sf_dir):
    return exposed(TB.raw_products(spark, sf_dir))


@register("raw_orders")
def q_raw_orders(spark, sf_dir):
    return exposed(TB.raw_orders(spark, sf_dir))


@register("stg_customers")
def q_stg_customers(spark, sf_dir):
    return exposed(Inputs(spark, sf_dir).stg_customers)


@register("stg_orders")
def q_stg_orders(spark, sf_dir):
    return exposed(Inputs(spark, sf_dir).stg_orders)


@register("stg_products")
def q_stg_products(spark, sf_dir):
    return exposed(Inputs(spark, sf_dir).stg_products)


@register("fct_daily_sales")
def q_fct_daily_sales(spark, sf_dir):
    return exposed(Inputs(spark, sf_dir).fct_daily_sales())


@register("daily_sales_summary")
def q_daily_sales_summary(spark, sf_dir):
    return exposed(Inputs(spark, sf_dir).daily_sales_summary())


@register("weekly_change")
def q_weekly_change(spark, sf_dir):
    d = Inputs(spark, sf_dir).daily_sales_summary(ordered=False)
    return exposed(d.select("sale_date", "country", "category", "price_segment",
                            "net_revenue", "weekly_revenue_change", "weekly_growth_rate"))


@register("rolling_avg")
def q_rolling_avg(spark, sf_dir):
    d = Inputs(spark, sf_dir).daily_sales_summary(ordered=False)
    return exposed(d.select("sale_date", "country", "category", "price_segment",
                            "net_revenue", "rolling_7day_avg_revenue"))


@register("rfm_metrics")
def q_rfm_metrics(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return exposed(M.rfm_metrics(i.stg_orders, i.as_of, order_keys=i.order_keys))


@register("rfm_scores")
def q_rfm_scores(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    s = M.rfm_scores(M.rfm_metrics(i.stg_orders, i.as_of, order_keys=i.order_keys))
    return exposed(s.select("customer_id", "recency", "frequency", "monetary",
                            "r_score", "f_score", "m_score"))


@register("rfm_segments")
def q_rfm_segments(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    d = i.dim_customers()
    return d.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


@register("dim_customers")
def q_dim_customers(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return exposed(i.dim_customers())


@register("cohort_size")
def q_cohort_size(spark, sf_dir):
    return A.cohort_size(Inputs(spark, sf_dir).stg_customers)


@register("customer_cohorts")
def q_customer_cohorts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return exposed(A.customer_cohorts(i.stg_customers, i.stg_orders))
