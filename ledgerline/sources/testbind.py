"""Bind the driver's TPC-H-style parquet tables to the three raw tables
(customers, products, orders) the warehouse is built on.

The mapping is deterministic, so the same raw rows come out of Spark and
of the SQL oracle.  Only the columns a mapping needs are read (column
pruning reaches the parquet scan).
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the test binding.
# ---------------------------------------------------------------------------
AS_OF = _dt.date(2028, 12, 31)
RUN_TS = _dt.datetime(2028, 12, 31, 0, 0, 0)
EPOCH = _dt.date(2022, 7, 1)
ORDER_DATE_SHIFT_DAYS = 10000
CREATED_EPOCH = _dt.date(2023, 1, 1)
# c_nationkey % 8 -> country
COUNTRIES = ["Russia", "USA", "UK", "Germany", "France", "Japan",
             "United States", "Brazil"]
# p_type -> category
CATEGORY_OF_TYPE = [
    ("STANDARD", "Electronics"),
    ("ECONOMY", "Electronics"),
    ("MEDIUM", "Clothing"),
    ("PROMO", "Books"),
    ("SMALL", "Home"),
    ("LARGE", "Garden"),
]
# ---------------------------------------------------------------------------


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money(cents_col):
    """Integer cents -> decimal(10,2), exactly."""
    return (cents_col * F.lit(Decimal("0.01"))).cast("decimal(10,2)")


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _table(spark, sf_dir, "customer").select("c_custkey", "c_name",
                                                   "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    reg = F.date_add(F.lit(EPOCH), ((k * 37) % 2300).cast("int"))
    country = F.element_at(F.array(*[F.lit(x) for x in COUNTRIES]),
                           (F.col("c_nationkey") % len(COUNTRIES) + 1).cast("int"))
    upd = F.when(k % 5 == 0, F.lit(None).cast("date")).otherwise(
        F.date_add(reg, (1 + (k * 17) % 365).cast("int")))
    return c.select(
        k.cast("long").alias("customer_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lower("c_mktsegment"), F.lit("."), k.cast("string"),
                 F.lit("@example.com")).alias("email"),
        reg.alias("registration_date"),
        country.alias("country"),
        upd.alias("updated_at"),
        ((k * 7) % 130).cast("int").alias("total_orders"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type",
                                               "p_size", "p_retailprice")
    pc = "cast(round(p_retailprice * 100) as bigint)"
    size_mod = F.col("p_size") % 3
    # integer division, exact
    cents = (F.when(size_mod == 0, F.expr(f"{pc} div 20"))
             .when(size_mod == 1, F.expr(f"{pc} div 2"))
             .otherwise(F.expr(f"({pc} * 3) div 2")))
    category = None
    for t, cat in CATEGORY_OF_TYPE:
        cond = F.col("p_type") == t
        category = F.when(cond, cat) if category is None else category.when(cond, cat)
    return p.select(
        F.col("p_partkey").cast("long").alias("product_id"),
        F.col("p_name").alias("product_name"),
        category.alias("category"),
        _money(cents).alias("price"),
        F.date_add(F.lit(CREATED_EPOCH), ((F.col("p_partkey") * 11) % 2190).cast("int"))
        .alias("created_at"),
    )


def first_lines(lineitem: DataFrame) -> DataFrame:
    """One row per order key: smallest part key and line number.

    Partial aggregation runs map-side, so even a key holding a third of
    lineitem shuffles as one row per map task."""
    return (lineitem.groupBy("l_orderkey")
            .agg(F.min("l_partkey").alias("l_partkey"),
                 F.min("l_linenumber").alias("l_linenumber")))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_orders_from(_table(spark, sf_dir, "orders"),
                           first_lines(_table(spark, sf_dir, "lineitem")))


def raw_orders_alone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders without what comes from their lines (product and quantity are NULL)."""
    no_lines = spark.createDataFrame([], "l_orderkey long, l_partkey long, l_linenumber int")
    return raw_orders_from(_table(spark, sf_dir, "orders"), no_lines)


def raw_orders_from(orders: DataFrame, first_line: DataFrame) -> DataFrame:
    """Raw orders from an orders frame (batch or stream) and the static
    per-order first line."""
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                      "o_orderdate")
    j = o.join(first_line, o.o_orderkey == first_line.l_orderkey, "left")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    status = (F.when(st == "F", "completed")
              .when(st == "P", F.when(k % 2 == 0, "pending").otherwise("shipped"))
              .when(st == "O", F.element_at(F.array(F.lit("cancelled"), F.lit("refunded"),
                                                    F.lit("on_hold")),
                                            (k % 3 + 1).cast("int"))))
    return j.select(
        k.cast("long").alias("order_id"),
        F.col("o_custkey").cast("long").alias("customer_id"),
        F.col("l_partkey").cast("long").alias("product_id"),
        F.coalesce(F.col("l_linenumber"), F.lit(0)).cast("int").alias("quantity"),
        F.date_add(F.to_date("o_orderdate"), ORDER_DATE_SHIFT_DAYS).alias("order_date"),
        status.alias("status"),
        _money(F.expr("cast(round(o_totalprice * 100) as bigint) div 300")).alias("total_amount"),
    )


@dataclass
class Raw:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame


def load_raw(spark: SparkSession, sf_dir: str) -> Raw:
    return Raw(raw_customers(spark, sf_dir), raw_products(spark, sf_dir),
               raw_orders(spark, sf_dir))


# ---------------------------------------------------------------------------
# Change scenarios for the stateful operators (incremental load, SCD2).
# The first load knows customers registered before
# 2028-06-01 and orders dated before 2028-01-01 that are not on hold; the
# second load sees every row, after these business changes:
#   * the shop leaves Brazil (those customers disappear: hard deletes);
#   * 'United States' is normalised to 'USA', updated_at moves 30 days on;
#   * AUTOMOBILE-segment customers gain 60 completed orders without
#     touching updated_at (a tier change only the check strategy sees);
#   * every pending order becomes completed.
# ---------------------------------------------------------------------------
CUSTOMERS_FIRST_LOAD_BEFORE = _dt.date(2028, 6, 1)
ORDERS_FIRST_LOAD_BEFORE = _dt.date(2028, 1, 1)
HELD_STATUS = "on_hold"
EXITED_COUNTRY = "Brazil"
RENAMED_COUNTRY = ("United States", "USA")
RENAME_UPDATE_DAYS = 30
BOOSTED_SEGMENT = "AUTOMOBILE"
BOOST_ORDERS = 60
SNAPSHOT_RUNS = [_dt.datetime(2029, 1, 1), _dt.datetime(2029, 2, 1),
                 _dt.datetime(2029, 3, 1), _dt.datetime(2029, 4, 1)]
LOAD_RUNS = [_dt.datetime(2028, 12, 31), _dt.datetime(2029, 1, 1)]


def customers_first_load(raw_customers_df: DataFrame) -> DataFrame:
    return raw_customers_df.where(F.col("registration_date") < F.lit(CUSTOMERS_FIRST_LOAD_BEFORE))


def customers_second_load(raw_customers_df: DataFrame) -> DataFrame:
    old, new = RENAMED_COUNTRY
    renamed = F.col("country") == old
    c = raw_customers_df.where(~F.col("country").eqNullSafe(EXITED_COUNTRY))
    return c.select(
        "customer_id", "first_name", "last_name", "email", "registration_date",
        F.when(renamed, F.lit(new)).otherwise(F.col("country")).alias("country"),
        F.when(renamed, F.date_add(F.coalesce("updated_at", "registration_date"),
                                   RENAME_UPDATE_DAYS))
        .otherwise(F.col("updated_at")).alias("updated_at"),
        F.when(F.col("first_name") == BOOSTED_SEGMENT, F.col("total_orders") + BOOST_ORDERS)
        .otherwise(F.col("total_orders")).alias("total_orders"),
    )


def orders_first_load(raw_orders_df: DataFrame) -> DataFrame:
    return raw_orders_df.where((F.col("order_date") < F.lit(ORDERS_FIRST_LOAD_BEFORE))
                               & ~F.col("status").eqNullSafe(HELD_STATUS))


def orders_second_load(raw_orders_df: DataFrame) -> DataFrame:
    return raw_orders_df.withColumn(
        "status", F.when(F.col("status") == "pending", F.lit("completed"))
        .otherwise(F.col("status")))


# Repeated keys, which the gates would stop: fixed rules of the distinct-count queries.
REPEAT_ORDERS, OTHER_CUSTOMER, REPEAT_CUSTOMERS = 3, 9, 4


def orders_with_repeats(raw_orders_df: DataFrame) -> DataFrame:
    """Every third order is loaded twice, every ninth the second time for the next customer."""
    k = F.col("order_id")
    again = raw_orders_df.where(k % REPEAT_ORDERS == 0).withColumn(
        "customer_id", F.when(k % OTHER_CUSTOMER == 0, F.col("customer_id") + 1).otherwise(F.col("customer_id")))
    return raw_orders_df.unionByName(again)


def customers_with_repeats(raw_customers_df: DataFrame) -> DataFrame:
    """Every fourth customer is listed twice."""
    return raw_customers_df.unionByName(raw_customers_df.where(F.col("customer_id") % REPEAT_CUSTOMERS == 0))
