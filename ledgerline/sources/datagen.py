"""Synthetic customers / products / orders, generated as Spark columns.

Every random draw is a hash of (row id, salt), so any partition can be
generated independently and the result does not depend on partitioning
or on the number of executors.  Distributions follow the reference's
generator; exact values do not (different random source).
"""

from __future__ import annotations

import datetime as _dt
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the generator.
# ---------------------------------------------------------------------------
FIRST_NAMES = ["John", "Sarah", "Michael", "Emma", "James", "Emily", "Robert", "Linda",
               "David", "Lisa"]
LAST_NAMES = ["Smith", "Johnson", "Williams", "Brown", "Jones", "Miller", "Davis", "Wilson",
              "Moore", "Taylor"]
DOMAINS = ["mail.ru", "gmail.com", "yahoo.com", "yandex.ru", "outlook.com"]
COUNTRIES = ["Russia", "USA", "UK", "Germany"]
CATALOG = [
    ("Electronics", (29.99, 2499.99),
     ["iPhone 15", "Samsung Galaxy", "MacBook Pro", "iPad", "AirPods", "Ноутбук Lenovo",
      "Монитор Dell", "Клавиатура Logitech", "Мышь Razer", "Наушники Sony", "Колонка JBL",
      "Power Bank", "SSD Samsung"]),
    ("Clothing", (9.99, 299.99),
     ["Футболка", "Джинсы", "Куртка", "Платье", "Рубашка", "Кроссовки Nike", "Ботинки",
      "Шорты", "Свитер", "Пальто", "Спортивный костюм", "Кепка", "Шарф"]),
    ("Books", (19.99, 89.99),
     ["Python для начинающих", "SQL Advanced", "Data Science", "Machine Learning",
      "Deep Learning", "Алгоритмы", "Java основы", "JavaScript полное руководство", "React",
      "Docker"]),
    ("Home", (49.99, 999.99),
     ["Лампа", "Стол", "Стул", "Шкаф", "Кровать", "Диван", "Ковер", "Зеркало", "Шторы",
      "Подушка"]),
]
STATUSES = ["completed", "pending", "cancelled", "refunded", "shipped"]
STATUS_WEIGHTS = [0.65, 0.15, 0.08, 0.05, 0.07]
MONTH_WEIGHTS = [1, 1, 1, 1, 1, 1, 1, 1, 1, 1, 1.5, 2]
RECENT_YEAR, OLDER_YEAR, RECENT_SHARE = 2024, 2023, 0.7
REGISTRATION_MEAN_DAYS, REGISTRATION_MAX_DAYS = 100, 730
UPDATE_MAX_DAYS, PRODUCT_MAX_AGE_DAYS, MAX_DAY_OF_MONTH = 365, 365, 28
AMOUNT_LOW, AMOUNT_HIGH = 0.8, 1.2
POISSON_MEAN = 1.0
# ---------------------------------------------------------------------------

UNIFORM_DIGITS = 13  # hexadecimal digits of the hash: 52 bits


def uniform(id_col: Column, salt: str) -> Column:
    """A [0, 1) double from the MD5 of 'id|salt', which any engine can repeat."""
    digits = F.substring(F.md5(F.concat_ws("|", id_col.cast("string"), F.lit(salt))), 1, UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / float(16 ** UNIFORM_DIGITS)


def randint(id_col: Column, salt: str, lo: int, hi: int) -> Column:
    """Uniform integer in [lo, hi]."""
    return (F.floor(uniform(id_col, salt) * (hi - lo + 1)) + lo).cast("int")


def choice(id_col: Column, salt: str, values: list) -> Column:
    idx = F.floor(uniform(id_col, salt) * len(values)).cast("int") + 1
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx)


def weighted_choice(id_col: Column, salt: str, values: list, weights: list[float]) -> Column:
    total = float(sum(weights))
    u = uniform(id_col, salt)
    expr, acc = None, 0.0
    for v, w in zip(values[:-1], weights[:-1]):
        acc += w / total
        expr = F.when(u < acc, F.lit(v)) if expr is None else expr.when(u < acc, F.lit(v))
    return expr.otherwise(F.lit(values[-1]))


def poisson(id_col: Column, salt: str, mean: float) -> Column:
    """Inverse-CDF Poisson draw.  The terms run until the largest
    uniform number cannot exceed the CDF (or another term adds nothing)."""
    u = uniform(id_col, salt)
    expr, cdf, p, k = None, 0.0, math.exp(-mean), 0
    while cdf <= 1.0 - 2.0 ** -53 and (k <= mean or cdf + p > cdf):
        cdf += p
        expr = F.when(u < cdf, F.lit(k)) if expr is None else expr.when(u < cdf, F.lit(k))
        k += 1
        p *= mean / k
    return expr.otherwise(F.lit(k))


def customers(ids: DataFrame, as_of: _dt.date) -> DataFrame:
    """One customer per ``id`` row (column ``id``)."""
    i = F.col("id")
    first, last = choice(i, "first", FIRST_NAMES), choice(i, "last", LAST_NAMES)
    days = F.least(-F.log(1 - uniform(i, "reg")) * REGISTRATION_MEAN_DAYS,
                   F.lit(float(REGISTRATION_MAX_DAYS)))
    reg = F.date_sub(F.lit(as_of), F.floor(days).cast("int"))
    return ids.select(
        i.cast("long").alias("customer_id"), first.alias("first_name"), last.alias("last_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last),
                 randint(i, "num", 1, 999).cast("string"), F.lit("@"),
                 choice(i, "domain", DOMAINS)).alias("email"),
        reg.alias("registration_date"),
        choice(i, "country", COUNTRIES).alias("country"),
        F.date_add(reg, randint(i, "upd", 1, UPDATE_MAX_DAYS)).alias("updated_at"),
        F.lit(0).alias("total_orders"),
    )


def products(spark: SparkSession, as_of: _dt.date) -> DataFrame:
    """The fixed catalogue (46 items), prices drawn per product id."""
    rows, pid = [], 1
    for category, (lo, hi), items in CATALOG:
        for name in items:
            rows.append((pid, name, category, lo, hi))
            pid += 1
    base = spark.createDataFrame(rows, "id long, product_name string, category string, "
                                       "lo double, hi double")
    i = F.col("id")
    price = F.round(F.col("lo") + uniform(i, "price") * (F.col("hi") - F.col("lo")), 2)
    return base.select(
        i.alias("product_id"), "product_name", "category",
        price.cast("decimal(10,2)").alias("price"),
        F.date_sub(F.lit(as_of), randint(i, "age", 1, PRODUCT_MAX_AGE_DAYS)).alias("created_at"),
    )


def orders(ids: DataFrame, n_customers: Column, product_df: DataFrame) -> DataFrame:
    """One order per ``id`` row; customers uniform in 1..n_customers.

    The product catalogue is fixed-size (46 rows), so it is broadcast.
    """
    i = F.col("id")
    n_products = sum(len(items) for _, _, items in CATALOG)
    recent = uniform(i, "year") < RECENT_SHARE
    month = F.when(recent, weighted_choice(i, "month_recent", list(range(1, 13)), MONTH_WEIGHTS)
                   ).otherwise(randint(i, "month_old", 1, 12))
    day = F.when(recent, randint(i, "day_recent", 1, MAX_DAY_OF_MONTH)
                 ).otherwise(randint(i, "day_old", 1, MAX_DAY_OF_MONTH))
    year = F.when(recent, F.lit(RECENT_YEAR)).otherwise(F.lit(OLDER_YEAR))
    o = ids.select(
        i.cast("long").alias("order_id"),
        (F.floor(uniform(i, "cust") * n_customers) + 1).cast("long").alias("customer_id"),
        randint(i, "prod", 1, n_products).cast("long").alias("product_id"),
        (poisson(i, "qty", POISSON_MEAN) + 1).alias("quantity"),
        F.make_date(year, month, day).alias("order_date"),
        weighted_choice(i, "status", STATUSES, STATUS_WEIGHTS).alias("status"),
        (F.lit(AMOUNT_LOW) + uniform(i, "amount") * (AMOUNT_HIGH - AMOUNT_LOW)).alias("_f"),
    )
    p = F.broadcast(product_df.select("product_id", "price"))
    j = o.join(p, "product_id", "left")
    total = F.round(F.col("price").cast("double") * F.col("quantity") * F.col("_f"), 2)
    return j.select("order_id", "customer_id", "product_id", "quantity", "order_date",
                    "status", total.cast("decimal(10,2)").alias("total_amount"))


def completed_orders_rollup(customers_df: DataFrame, orders_df: DataFrame) -> DataFrame:
    """total_orders = completed orders per customer (0 without any)."""
    done = (orders_df.where(F.col("status") == "completed")
            .groupBy("customer_id").agg(F.count(F.lit(1)).alias("_n")))
    return customers_df.join(done, "customer_id", "left").select(
        "customer_id", F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("total_orders"))


def generate(spark: SparkSession, n_customers: int, n_orders: int, as_of: _dt.date,
             num_partitions: int | None = None):
    """Customers, products, orders of the given sizes; customers carry
    their completed-order counts."""
    cust_ids = spark.range(1, n_customers + 1, numPartitions=num_partitions)
    order_ids = spark.range(1, n_orders + 1, numPartitions=num_partitions)
    prods = products(spark, as_of)
    o = orders(order_ids, F.lit(n_customers), prods)
    c = customers(cust_ids, as_of)
    rolled = completed_orders_rollup(c, o)
    c = c.drop("total_orders").join(rolled, "customer_id", "left")
    return c, prods, o

