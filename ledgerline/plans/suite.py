"""The declared data-quality suite (what the build gates on).

Fixed values: models, columns and arguments of the reference's declared
tests, in declaration order.
"""

from __future__ import annotations

from ..operators.quality import Check

COUNTRIES = ("Russia", "USA", "UK", "Germany")
COUNTRY_CODES = ("RU", "US", "GB", "DE")
TIERS = ("VIP", "Gold", "Silver", "Bronze", "New")
DIM_TIERS = ("VIP", "Gold", "Silver", "New", "Bronze")
STATUSES = ("completed", "pending", "cancelled", "refunded", "shipped")
ORDER_CATEGORIES = ("successful", "in_progress", "failed", "unknown")
CATEGORIES = ("Electronics", "Clothing", "Books", "Home")
PRICE_SEGMENTS = ("premium", "medium", "budget")


def _nn(model, col):
    return Check("not_null", model, col)


def _uq(model, col):
    return Check("unique", model, col)


SUITE: list[Check] = [
    # sources
    _uq("raw_customers", "customer_id"), _nn("raw_customers", "customer_id"),
    _nn("raw_customers", "email"),
    _uq("raw_products", "product_id"), _nn("raw_products", "product_id"),
    _uq("raw_orders", "order_id"), _nn("raw_orders", "order_id"),
    # stg_customers
    _uq("stg_customers", "customer_id"), _nn("stg_customers", "customer_id"),
    _nn("stg_customers", "email"),
    _nn("stg_customers", "country"),
    Check("accepted_values", "stg_customers", "country", values=COUNTRIES),
    _nn("stg_customers", "country_code"),
    Check("accepted_values", "stg_customers", "country_code", values=COUNTRY_CODES),
    _nn("stg_customers", "customer_tier"),
    Check("accepted_values", "stg_customers", "customer_tier", values=TIERS),
    _nn("stg_customers", "registration_date"),
    Check("expression_is_true", "stg_customers", "registration_date",
          expression="<= CURRENT_DATE"),
    # stg_orders
    _uq("stg_orders", "order_id"), _nn("stg_orders", "order_id"),
    _nn("stg_orders", "customer_id"),
    Check("relationships", "stg_orders", "customer_id", to="stg_customers",
          field_name="customer_id"),
    _nn("stg_orders", "product_id"),
    Check("relationships", "stg_orders", "product_id", to="stg_products",
          field_name="product_id"),
    _nn("stg_orders", "total_amount"),
    Check("accepted_range", "stg_orders", "total_amount", min_value=0.01),
    _nn("stg_orders", "quantity"),
    Check("accepted_range", "stg_orders", "quantity", min_value=1, max_value=100),
    _nn("stg_orders", "status"),
    Check("accepted_values", "stg_orders", "status", values=STATUSES),
    _nn("stg_orders", "order_date"),
    Check("expression_is_true", "stg_orders", "order_date", expression=">= '2023-01-01'"),
    Check("expression_is_true", "stg_orders", "order_date", expression="<= CURRENT_DATE"),
    _nn("stg_orders", "order_category"),
    Check("accepted_values", "stg_orders", "order_category", values=ORDER_CATEGORIES),
    # stg_products
    _uq("stg_products", "product_id"), _nn("stg_products", "product_id"),
    _nn("stg_products", "product_name"),
    _nn("stg_products", "category"),
    Check("accepted_values", "stg_products", "category", values=CATEGORIES),
    _nn("stg_products", "price"),
    Check("accepted_range", "stg_products", "price", min_value=0.01, max_value=10000),
    _nn("stg_products", "price_segment"),
    Check("accepted_values", "stg_products", "price_segment", values=PRICE_SEGMENTS),
    _nn("stg_products", "created_at"),
    # marts
    _uq("dim_customers", "customer_id"), _nn("dim_customers", "customer_id"),
    _nn("dim_customers", "customer_tier"),
    Check("accepted_values", "dim_customers", "customer_tier", values=DIM_TIERS),
    _uq("fct_orders_incremental", "order_id"), _nn("fct_orders_incremental", "order_id"),
    _nn("fct_orders_incremental", "customer_id"),
    Check("relationships", "fct_orders_incremental", "customer_id", to="dim_customers",
          field_name="customer_id"),
    _nn("fct_orders_incremental", "order_date"),
    _nn("fct_orders_incremental", "net_amount"),
    Check("accepted_range", "fct_orders_incremental", "net_amount", min_value=0),
    # snapshot
    _nn("customers_snapshot", "customer_id"),
    _nn("customers_snapshot", "dbt_valid_from"),
]

# The custom assertion: orders with a negative total.
SINGULAR_MODEL = "stg_orders"
SINGULAR_CONDITION = "total_amount < 0"
SINGULAR_COLUMNS = ["order_id", "total_amount"]

# Source freshness (hours).
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# Tables the post-build verification requires.
REQUIRED_TABLES = ["dim_customers", "fct_daily_sales", "fct_orders_incremental",
                   "daily_sales_summary", "customer_cohorts", "stg_customers", "stg_orders",
                   "stg_products"]


def suite_counts() -> dict[str, int]:
    out: dict[str, int] = {}
    for c in SUITE:
        out[c.kind] = out.get(c.kind, 0) + 1
    return out
