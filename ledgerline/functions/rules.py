"""Named business rules as ``Column -> Column`` functions.

All of them are plain Catalyst expressions (CASE / IN / arithmetic), so
they stay inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's rules exactly.
# ---------------------------------------------------------------------------
# Country -> code (first match wins; anything else is 'Other').
COUNTRY_CODES = [
    ("Russia", "RU"),
    ("USA", "US"),
    ("United States", "US"),
    ("UK", "GB"),
    ("United Kingdom", "GB"),
    ("Germany", "DE"),
    ("France", "FR"),
    ("Japan", "JP"),
]
OTHER_COUNTRY_CODE = "Other"
MAJOR_MARKETS = ["Russia", "USA", "UK", "Germany"]

# Customer tier by raw total_orders (>= threshold, first match wins).
TIER_THRESHOLDS = [(100, "VIP"), (50, "Gold"), (20, "Silver"), (5, "Bronze")]
TIER_DEFAULT = "New"
PREMIUM_TIERS = ["VIP", "Gold"]

# Price classification (> threshold, first match wins).
PRICE_THRESHOLDS = [(1000, "premium"), (100, "medium")]
PRICE_DEFAULT = "budget"
PRICE_UNKNOWN = "unknown"

# Tiered order discount: total > threshold -> rate; else bulk rate when
# quantity >= BULK_QUANTITY; else 0.
DISCOUNT_TIERS = [(1000, "0.15"), (500, "0.10"), (200, "0.05")]
BULK_QUANTITY = 5
BULK_RATE = "0.03"
# Flat discount (second, unused-by-models rule): total > 500 -> 20 %.
FLAT_DISCOUNT_THRESHOLD = 500
FLAT_DISCOUNT_RATE = "0.2"

# Order status -> category.
ORDER_CATEGORIES = [
    (["completed", "shipped"], "successful"),
    (["pending"], "in_progress"),
    (["cancelled", "refunded"], "failed"),
]
ORDER_CATEGORY_DEFAULT = "unknown"
SUCCESSFUL = "successful"
SUCCESSFUL_STATUSES = ["completed", "shipped"]

# Activity by days since last activity (<= threshold, first match wins).
ACTIVITY_THRESHOLDS = [(30, "Active"), (90, "Warm"), (180, "Cold")]
ACTIVITY_DEFAULT = "Churned"

# Churn risk.
CHURN_HIGH_RISK_DAYS = 90
CHURN_LIKELY_DAYS = 180

# Product category -> analytics group.
CATEGORY_GROUPS = [
    (["Electronics", "Home"], "High Value"),
    (["Clothing"], "Fashion"),
    (["Books"], "Education"),
]
CATEGORY_GROUP_DEFAULT = "Other"

NEW_ARRIVAL_DAYS = 30
HIGH_VALUE_AMOUNT = 500
BULK_ORDER_QUANTITY = 3
MARGIN_COST_SHARE = "0.7"
WEEKEND_DOW = [0, 6]  # 0 = Sunday ... 6 = Saturday

# RFM segments: (segment, r, f, m) where each bound is (op, value);
# first matching rule wins, 'Others' otherwise.
RFM_SEGMENTS = [
    ("Champions", (">=", 4), (">=", 4), (">=", 4)),
    ("Loyal Customers", (">=", 3), (">=", 3), (">=", 3)),
    ("Potential Loyalists", (">=", 3), (">=", 1), (">=", 2)),
    ("New Customers", (">=", 4), ("<=", 2), ("<=", 2)),
    ("At Risk", ("<=", 2), (">=", 2), (">=", 2)),
    ("Lost", ("<=", 2), ("<=", 2), ("<=", 2)),
]
RFM_DEFAULT = "Others"
# ---------------------------------------------------------------------------


def _dec(text: str) -> Column:
    """Exact decimal literal (a Python float literal would be a double)."""
    return F.lit(Decimal(text))


def _chain(branches, default) -> Column:
    """Build a searched CASE from (condition, value) pairs in order."""
    expr = None
    for cond, value in branches:
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default) if expr is not None else F.lit(default)


def country_code(country: Column) -> Column:
    return _chain([(country == name, code) for name, code in COUNTRY_CODES],
                  F.lit(OTHER_COUNTRY_CODE))


def is_major_market(country: Column) -> Column:
    return F.coalesce(country.isin(MAJOR_MARKETS), F.lit(False))


def customer_tier(total_orders: Column) -> Column:
    return _chain([(total_orders >= t, name) for t, name in TIER_THRESHOLDS],
                  F.lit(TIER_DEFAULT))


def price_category(price: Column) -> Column:
    """Price class; NULL price falls through to the default."""
    return _chain([(price > t, name) for t, name in PRICE_THRESHOLDS],
                  F.lit(PRICE_DEFAULT))


def price_segment(price: Column) -> Column:
    """Price class with an explicit 'unknown' for NULL prices."""
    return F.when(price.isNull(), F.lit(PRICE_UNKNOWN)).otherwise(price_category(price))


def estimated_discount(total_amount: Column, quantity: Column) -> Column:
    branches = [(total_amount > t, total_amount * _dec(rate)) for t, rate in DISCOUNT_TIERS]
    branches.append((quantity >= BULK_QUANTITY, total_amount * _dec(BULK_RATE)))
    return _chain(branches, F.lit(0))


def flat_discount(total_amount: Column) -> Column:
    return _chain([(total_amount > FLAT_DISCOUNT_THRESHOLD,
                    total_amount * _dec(FLAT_DISCOUNT_RATE))], F.lit(0))


def order_category(status: Column) -> Column:
    return _chain([(status.isin(values), name) for values, name in ORDER_CATEGORIES],
                  F.lit(ORDER_CATEGORY_DEFAULT))


def activity_status(days: Column) -> Column:
    """Activity bucket from a day count; NULL days fall to the default."""
    return _chain([(days <= t, name) for t, name in ACTIVITY_THRESHOLDS],
                  F.lit(ACTIVITY_DEFAULT))


def churn_risk(recency: Column, tier: Column) -> Column:
    return _chain([
        ((recency > CHURN_HIGH_RISK_DAYS) & tier.isin(PREMIUM_TIERS), "High Risk"),
        (recency > CHURN_LIKELY_DAYS, "Likely Churned"),
    ], F.lit("Active"))


def category_group(category: Column) -> Column:
    return _chain([(category.isin(values), name) for values, name in CATEGORY_GROUPS],
                  F.lit(CATEGORY_GROUP_DEFAULT))


def is_new_arrival(days_since_created: Column) -> Column:
    return F.coalesce(days_since_created <= NEW_ARRIVAL_DAYS, F.lit(False))


def is_weekend(dow0: Column) -> Column:
    return F.coalesce(dow0.isin(WEEKEND_DOW), F.lit(False))


def is_high_value(total_amount: Column) -> Column:
    return F.coalesce(total_amount > HIGH_VALUE_AMOUNT, F.lit(False))


def is_bulk_order(quantity: Column) -> Column:
    return F.coalesce(quantity >= BULK_ORDER_QUANTITY, F.lit(False))


def is_vip_customer(tier: Column) -> Column:
    return F.coalesce(tier.isin(PREMIUM_TIERS), F.lit(False))


def estimated_margin(total_amount: Column, discount: Column, price: Column,
                     quantity: Column) -> Column:
    """total - discount - price*qty*0.7; NULL when the product is unknown."""
    return total_amount - discount - price * quantity * _dec(MARGIN_COST_SHARE)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0) as one double division (same bits in any
    engine that divides IEEE doubles)."""
    return num.cast("double") / F.nullif(den, F.lit(0)).cast("double")


def _cmp(col: Column, bound) -> Column:
    op, v = bound
    return col >= v if op == ">=" else col <= v


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    return _chain([(_cmp(r, rb) & _cmp(f, fb) & _cmp(m, mb), name)
                   for name, rb, fb, mb in RFM_SEGMENTS], F.lit(RFM_DEFAULT))


def rfm_score(r: Column, f: Column, m: Column) -> Column:
    """Digits concatenated, NULL parts skipped (customers without orders
    get the empty string)."""
    return F.concat_ws("", r.cast("string"), f.cast("string"), m.cast("string"))
