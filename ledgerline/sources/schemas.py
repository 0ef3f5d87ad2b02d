"""Declared schemas for the raw tables and the seeds.

Keys are 64-bit: an order key passes 2^31 well before 100 TB.
"""

from pyspark.sql import types as T

RAW_CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("registration_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("updated_at", T.DateType()),
    T.StructField("total_orders", T.IntegerType()),
])

RAW_PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("price", T.DecimalType(10, 2)),
    T.StructField("created_at", T.DateType()),
])

RAW_ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("order_date", T.DateType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_amount", T.DecimalType(10, 2)),
])

RAW = {"customers": RAW_CUSTOMERS, "products": RAW_PRODUCTS, "orders": RAW_ORDERS}

# Seeds: declared column types win; others are strings.
SEED_REGIONS = T.StructType([
    T.StructField("region_code", T.StringType()),
    T.StructField("region_name", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("delivery_days", T.IntegerType()),
])

SEED_CATEGORIES = T.StructType([
    T.StructField("category_id", T.IntegerType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("parent_category", T.StringType()),
    T.StructField("is_active", T.BooleanType()),
])

SEEDS = {"regions": SEED_REGIONS, "categories": SEED_CATEGORIES}

# Length limits of the raw DDL, checked as data quality rather than types.
VARCHAR_LIMITS = {
    "customers": {"first_name": 50, "last_name": 50, "email": 100, "country": 50},
    "products": {"product_name": 100, "category": 50},
    "orders": {"status": 20},
}
SEED_VARCHAR_LIMITS = {"regions": {"region_code": 3}}
