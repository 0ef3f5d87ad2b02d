"""Oracle SQL (DuckDB dialect) for the registered queries.

Each statement derives its result from the driver tables in another way
than the Spark side does, so a misread rule shows: labels and limits are
looked up in threshold tables, quartiles come from rank arithmetic, the
weekday from a day count, lag and moving frame from a self-join on row
numbers.  Types are cast to what the Spark side exposes; money is exact
DECIMAL until the final CAST(... AS DOUBLE).
"""

from __future__ import annotations

AS_OF = "DATE '2028-12-31'"
RUN_TS = "TIMESTAMP '2028-12-31 00:00:00'"

CTES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def cte(name: str, deps: list[str], sql: str) -> None:
    CTES[name] = sql
    DEPS[name] = deps


def with_ctes(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS (\n{CTES[n]}\n)" for n in order) + "\n"


# --------------------------------------------------------------- raw binding
cte("raw_customers", [], """
SELECT CAST(c_custkey AS BIGINT) AS customer_id,
       c_mktsegment AS first_name,
       c_name AS last_name,
       lower(c_mktsegment) || '.' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
       DATE '2022-07-01' + CAST((c_custkey * 37) % 2300 AS INTEGER) AS registration_date,
       CASE c_nationkey % 8 WHEN 0 THEN 'Russia' WHEN 1 THEN 'USA' WHEN 2 THEN 'UK'
            WHEN 3 THEN 'Germany' WHEN 4 THEN 'France' WHEN 5 THEN 'Japan'
            WHEN 6 THEN 'United States' ELSE 'Brazil' END AS country,
       CASE WHEN c_custkey % 5 = 0 THEN NULL
            ELSE DATE '2022-07-01' + CAST((c_custkey * 37) % 2300 + 1 + (c_custkey * 17) % 365 AS INTEGER)
       END AS updated_at,
       CAST((c_custkey * 7) % 130 AS INTEGER) AS total_orders
FROM customer""")

cte("raw_products", [], """
SELECT CAST(p_partkey AS BIGINT) AS product_id,
       p_name AS product_name,
       CASE p_type WHEN 'STANDARD' THEN 'Electronics' WHEN 'ECONOMY' THEN 'Electronics'
            WHEN 'MEDIUM' THEN 'Clothing' WHEN 'PROMO' THEN 'Books' WHEN 'SMALL' THEN 'Home'
            WHEN 'LARGE' THEN 'Garden' END AS category,
       CAST((CASE p_size % 3 WHEN 0 THEN pc // 20 WHEN 1 THEN pc // 2 ELSE (pc * 3) // 2 END)
            * 0.01 AS DECIMAL(10,2)) AS price,
       DATE '2023-01-01' + CAST((p_partkey * 11) % 2190 AS INTEGER) AS created_at
FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS pc FROM part) p""")

cte("raw_orders", [], """
SELECT CAST(o.o_orderkey AS BIGINT) AS order_id,
       CAST(o.o_custkey AS BIGINT) AS customer_id,
       CAST(fl.l_partkey AS BIGINT) AS product_id,
       CAST(coalesce(fl.l_linenumber, 0) AS INTEGER) AS quantity,
       CAST(o.o_orderdate AS DATE) + 10000 AS order_date,
       CASE o.o_orderstatus WHEN 'F' THEN 'completed'
            WHEN 'P' THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'pending' ELSE 'shipped' END
            WHEN 'O' THEN CASE o.o_orderkey % 3 WHEN 0 THEN 'cancelled' WHEN 1 THEN 'refunded'
                               ELSE 'on_hold' END END AS status,
       CAST((CAST(round(o.o_totalprice * 100) AS BIGINT) // 300) * 0.01 AS DECIMAL(10,2)) AS total_amount
FROM orders o
LEFT JOIN (SELECT l_orderkey, min(l_partkey) AS l_partkey, min(l_linenumber) AS l_linenumber
           FROM lineitem GROUP BY l_orderkey) fl ON o.o_orderkey = fl.l_orderkey""")

# ---------------------------------------------------------- threshold tables
# Labels and limits of the rules, as rows that the statements
# below look up (the Spark side states them as conditions).
cte("country_codes", [], """
SELECT * FROM (VALUES ('Russia', 'RU', TRUE), ('USA', 'US', TRUE), ('United States', 'US', FALSE),
  ('UK', 'GB', TRUE), ('United Kingdom', 'GB', FALSE), ('Germany', 'DE', TRUE), ('France', 'FR', FALSE),
  ('Japan', 'JP', FALSE)) AS v(name, code, major)""")
cte("tier_floors", [], """
SELECT * FROM (VALUES (100, 'VIP'), (50, 'Gold'), (20, 'Silver'), (5, 'Bronze')) AS v(floor, tier)""")
cte("age_limits", [], """
SELECT * FROM (VALUES (30, 'Active'), (90, 'Warm'), (180, 'Cold')) AS v(days, label)""")
cte("discount_floors", [], """
SELECT above, CAST(rate AS DECIMAL(3,2)) AS rate
FROM (VALUES (1000, 0.15), (500, 0.10), (200, 0.05)) AS v(above, rate)""")
cte("price_floors", [], """
SELECT * FROM (VALUES (1000, 'premium'), (100, 'medium')) AS v(above, label)""")
cte("status_groups", [], """
SELECT * FROM (VALUES ('completed', 'successful'), ('shipped', 'successful'), ('pending', 'in_progress'),
  ('cancelled', 'failed'), ('refunded', 'failed')) AS v(status, grp)""")
cte("product_groups", [], """
SELECT * FROM (VALUES ('Electronics', 'High Value'), ('Home', 'High Value'), ('Clothing', 'Fashion'),
  ('Books', 'Education')) AS v(category, grp)""")
cte("segment_rules", [], """
SELECT * FROM (VALUES (1, 4, 9, 4, 9, 4, 9, 'Champions'), (2, 3, 9, 3, 9, 3, 9, 'Loyal Customers'),
  (3, 3, 9, 1, 9, 2, 9, 'Potential Loyalists'), (4, 4, 9, 0, 2, 0, 2, 'New Customers'),
  (5, 0, 2, 2, 9, 2, 9, 'At Risk'), (6, 0, 2, 0, 2, 0, 2, 'Lost'))
  AS v(place, r0, r1, f0, f1, m0, m1, label)""")

# ------------------------------------------------------------------ staging
cte("stg_customers", ["raw_customers", "country_codes", "tier_floors", "age_limits"], f"""
SELECT x.*, coalesce(t.tier, 'New') AS customer_tier, coalesce(a.label, 'Churned') AS activity_status
FROM (
  SELECT r.customer_id, first_name, last_name, email, registration_date, country,
         ifnull(k.code, 'Other') AS country_code, ifnull(k.major, FALSE) AS is_major_market,
         ifnull(updated_at, registration_date) AS updated_at, updated_at AS last_updated,
         CAST({AS_OF} - registration_date AS INTEGER) AS days_since_registration,
         {AS_OF} - ifnull(updated_at, registration_date) AS idle_days,
         make_date(year(registration_date), month(registration_date), 1) AS cohort_month,
         total_orders, first_name || ' ' || last_name AS full_name
  FROM raw_customers r LEFT JOIN country_codes k ON k.name = country) x
LEFT JOIN LATERAL (SELECT max_by(tier, floor) AS tier FROM tier_floors WHERE floor <= x.total_orders) t ON TRUE
LEFT JOIN LATERAL (SELECT min_by(label, days) AS label FROM age_limits WHERE days >= x.idle_days) a ON TRUE""")

cte("stg_orders", ["raw_orders", "status_groups", "discount_floors"], """
SELECT x.*, weekday_no AS order_day_of_week, weekday_no % 6 = 0 AS is_weekend,
       total_amount * coalesce(d.rate, CASE WHEN quantity >= 5 THEN CAST(0.03 AS DECIMAL(3,2)) END,
                               CAST(0 AS DECIMAL(3,2))) AS estimated_discount
FROM (
  SELECT r.order_id, customer_id, product_id, quantity, order_date, r.status, total_amount,
         CASE WHEN quantity <> 0 THEN CAST(total_amount AS DOUBLE) / quantity END AS unit_price,
         ifnull(s.grp, 'unknown') AS order_category,
         CAST(year(order_date) AS INTEGER) AS order_year, CAST(month(order_date) AS INTEGER) AS order_month,
         CAST((month(order_date) + 2) // 3 AS INTEGER) AS order_quarter,
         -- days since a Sunday
         CAST((order_date - DATE '1970-01-04') % 7 AS INTEGER) AS weekday_no
  FROM raw_orders r LEFT JOIN status_groups s ON s.status = r.status
  WHERE year(order_date) >= 2023) x
LEFT JOIN LATERAL (SELECT max(rate) AS rate FROM discount_floors WHERE x.total_amount > above) d ON TRUE""")

cte("stg_products", ["raw_products", "price_floors", "product_groups"], f"""
SELECT x.*, CASE WHEN price IS NULL THEN 'unknown' ELSE price_category END AS price_segment
FROM (
  SELECT r.product_id, product_name, r.category, price, created_at,
         ifnull(f.label, 'budget') AS price_category,
         CAST({AS_OF} - created_at AS INTEGER) AS days_since_created,
         created_at >= {AS_OF} - 30 AS is_new_arrival,
         ifnull(g.grp, 'Other') AS category_group
  FROM raw_products r LEFT JOIN product_groups g ON g.category = r.category
  LEFT JOIN LATERAL (SELECT max_by(label, above) AS label FROM price_floors WHERE r.price > above) f ON TRUE) x""")

# -------------------------------------------------------------------- marts
cte("fct_daily_sales", ["stg_orders", "stg_products", "stg_customers"], """
WITH sold AS (
  SELECT *, total_amount - estimated_discount AS net FROM stg_orders WHERE order_category = 'successful')
SELECT order_id, order_date AS sale_date, order_year, order_month, order_quarter, order_day_of_week,
       is_weekend, order_category, quantity, total_amount, estimated_discount, net AS net_revenue,
       unit_price AS avg_item_price, customer_id, country, country_code, customer_tier, is_major_market,
       product_id, product_name, category, price_segment, price AS current_price,
       net - price * quantity * 0.7 AS estimated_margin,
       ifnull(total_amount > 500, FALSE) AS is_high_value, ifnull(quantity > 2, FALSE) AS is_bulk_order,
       ifnull(list_contains(['Gold', 'VIP'], customer_tier), FALSE) AS is_vip_customer
FROM sold LEFT JOIN stg_customers USING (customer_id) LEFT JOIN stg_products USING (product_id)""")

cte("customer_totals", ["stg_orders"], f"""
WITH months AS (
  SELECT customer_id, order_year, order_month, min(order_date) AS first_day,
         max(order_date) AS last_day, sum(total_amount - estimated_discount) AS net,
         count(total_amount - estimated_discount) AS priced, sum(quantity) AS items,
         count(*) FILTER (WHERE is_weekend) AS weekend
  FROM stg_orders WHERE order_category = 'successful' GROUP BY ALL),
ordered AS (
  SELECT customer_id, count(DISTINCT order_id) AS frequency
  FROM stg_orders WHERE order_category = 'successful' GROUP BY ALL)
SELECT m.customer_id, max(last_day) AS last_order_date, any_value(frequency) AS frequency,
       sum(net) AS monetary,
       CASE WHEN sum(priced) > 0 THEN CAST(sum(net) AS DOUBLE) / CAST(sum(priced) AS DOUBLE) END AS avg_order_value,
       min(first_day) AS first_order_date, CAST({AS_OF} - max(last_day) AS INTEGER) AS recency,
       count(*) AS active_months, CAST(sum(weekend) AS BIGINT) AS weekend_orders,
       CAST(sum(items) AS BIGINT) AS total_items_bought
FROM months m JOIN ordered o ON o.customer_id IS NOT DISTINCT FROM m.customer_id GROUP BY m.customer_id""")

# quartile of a 0-based rank among n rows: the first n % 4 quartiles hold one row more
cte("customer_quartiles", ["customer_totals"], """
WITH placed AS (
  SELECT *, count(*) OVER () AS n,
         row_number() OVER (ORDER BY recency DESC NULLS FIRST, customer_id) - 1 AS r,
         row_number() OVER (ORDER BY frequency ASC NULLS LAST, customer_id) - 1 AS f,
         row_number() OVER (ORDER BY monetary ASC NULLS LAST, customer_id) - 1 AS m
  FROM customer_totals),
sized AS (SELECT *, n // 4 AS size, n % 4 AS longer FROM placed)
SELECT * EXCLUDE (r, f, m, n, size, longer), CAST(1 + CASE WHEN r < longer * (size + 1) THEN r // (size + 1)
         ELSE (r - longer) // size END AS INTEGER) AS r_score,
       CAST(1 + CASE WHEN f < longer * (size + 1) THEN f // (size + 1)
         ELSE (f - longer) // size END AS INTEGER) AS f_score,
       CAST(1 + CASE WHEN m < longer * (size + 1) THEN m // (size + 1)
         ELSE (m - longer) // size END AS INTEGER) AS m_score
FROM sized""")

cte("dim_customers", ["stg_customers", "customer_quartiles", "segment_rules", "age_limits"], """
SELECT c.customer_id, c.first_name, c.last_name, c.email, c.registration_date, c.country, c.country_code,
       c.customer_tier, ifnull(q.first_order_date, c.registration_date) AS first_order_date, q.last_order_date,
       ifnull(q.frequency, 0) AS total_orders, ifnull(q.monetary, 0) AS lifetime_value,
       ifnull(q.avg_order_value, 0) AS avg_order_value, q.recency AS days_since_last_order,
       ifnull(q.active_months, 0) AS active_months, ifnull(q.total_items_bought, 0) AS total_items_bought,
       concat_ws('', q.r_score, q.f_score, q.m_score) AS rfm_score,
       ifnull(s.label, 'Others') AS rfm_segment, ifnull(a.label, 'Churned') AS activity_status,
       list_extract(['Active', 'Likely Churned', 'High Risk'],
         1 + greatest(CASE WHEN q.recency > 180 THEN 1 ELSE 0 END,
                      CASE WHEN q.recency > 90 AND list_contains(['Gold', 'VIP'], c.customer_tier) THEN 2 ELSE 0 END))
         AS churn_risk
FROM stg_customers c LEFT JOIN customer_quartiles q ON q.customer_id = c.customer_id
LEFT JOIN LATERAL (SELECT min_by(label, place) AS label FROM segment_rules
                   WHERE q.r_score BETWEEN r0 AND r1 AND q.f_score BETWEEN f0 AND f1
                     AND q.m_score BETWEEN m0 AND m1) s ON TRUE
LEFT JOIN LATERAL (SELECT min_by(label, days) AS label FROM age_limits WHERE days >= q.recency) a ON TRUE""")

# ---------------------------------------------------------------- analytics
_DAY = ("sale_date, order_year, order_month, order_quarter, country, country_code, is_major_market, "
        "category, price_segment")
cte("daily_grain", ["fct_daily_sales"], f"""
SELECT {_DAY}, count(DISTINCT order_id) AS total_orders, count(DISTINCT customer_id) AS unique_customers,
       CAST(sum(quantity) AS BIGINT) AS total_items_sold, sum(total_amount) AS gross_revenue,
       sum(net_revenue) AS net_revenue, sum(estimated_margin) AS estimated_margin,
       CAST(sum(total_amount) AS DOUBLE) / CAST(nullif(count(total_amount), 0) AS DOUBLE) AS avg_order_value,
       CAST(sum(CAST(CAST(net_revenue AS DOUBLE) / nullif(quantity, 0) AS DECIMAL(28,10))) AS DOUBLE)
         / CAST(nullif(count(CAST(net_revenue AS DOUBLE) / nullif(quantity, 0)), 0) AS DOUBLE) AS avg_revenue_per_item,
       CAST(sum(net_revenue) AS DOUBLE) / CAST(nullif(count(DISTINCT customer_id), 0) AS DOUBLE) AS avg_revenue_per_customer,
       count(*) FILTER (WHERE is_high_value) AS high_value_orders, count(*) FILTER (WHERE is_bulk_order) AS bulk_orders,
       count(*) FILTER (WHERE is_vip_customer) AS vip_orders,
       CAST(sum(CASE WHEN is_high_value THEN net_revenue ELSE 0 END) AS DOUBLE)
         / CAST(nullif(sum(net_revenue), 0) AS DOUBLE) AS high_value_revenue_share,
       CAST(sum(CASE WHEN is_weekend THEN net_revenue ELSE 0 END) AS DOUBLE)
         / CAST(nullif(sum(net_revenue), 0) AS DOUBLE) AS weekend_revenue_share
FROM fct_daily_sales GROUP BY ALL""")

# the row seven places before, and the seven rows up to this one, by row number
cte("daily_sales_summary", ["daily_grain"], """
WITH numbered AS (
  SELECT *, dense_rank() OVER (ORDER BY country, category) AS line,
         row_number() OVER (PARTITION BY country, category
                            ORDER BY sale_date NULLS LAST, price_segment NULLS LAST) AS place
  FROM daily_grain),
recent AS (
  SELECT a.line, a.place, sum(b.net_revenue) AS net, count(b.net_revenue) AS days
  FROM numbered a JOIN numbered b ON b.line = a.line AND b.place BETWEEN a.place - 6 AND a.place
  GROUP BY a.line, a.place)
SELECT a.*, a.net_revenue - b.net_revenue AS weekly_revenue_change,
       CAST(a.net_revenue AS DOUBLE) / CAST(nullif(b.net_revenue, 0) AS DOUBLE) - 1 AS weekly_growth_rate,
       CAST(r.net AS DOUBLE) / CAST(r.days AS DOUBLE) AS rolling_7day_avg_revenue
FROM numbered a JOIN recent r ON r.line = a.line AND r.place = a.place
LEFT JOIN numbered b ON b.line = a.line AND b.place = a.place - 7""")

cte("cohort_size", ["stg_customers"], """
SELECT cohort_month, count(DISTINCT customer_id) AS cohort_size FROM stg_customers GROUP BY cohort_month""")

cte("customer_cohorts", ["stg_customers", "stg_orders", "cohort_size"], """
WITH spent AS (
  SELECT customer_id, make_date(order_year, order_month, 1) AS order_month,
         sum(total_amount - estimated_discount) AS net
  FROM stg_orders WHERE order_category = 'successful' GROUP BY ALL),
active AS (
  SELECT cohort_month, order_month, count(DISTINCT customer_id) AS active_customers, sum(net) AS total_revenue
  FROM spent JOIN stg_customers USING (customer_id) GROUP BY ALL)
SELECT cohort_month, order_month,
       CAST(datediff('month', cohort_month, order_month) AS INTEGER) AS period_number,
       active_customers, total_revenue,
       CAST(total_revenue AS DOUBLE) / active_customers AS avg_revenue_per_active_customer,
       CAST(active_customers * 100 AS DOUBLE) / cohort_size AS retention_rate
FROM active JOIN cohort_size USING (cohort_month)""")


def money(*cols: str) -> dict[str, str]:
    return {c: f"CAST({c} AS DOUBLE) AS {c}" for c in cols}


def select_from(source: str, columns: list[str], casts: dict[str, str] | None = None,
                where: str = "") -> str:
    casts = casts or {}
    cols = ",\n       ".join(casts.get(c, c) for c in columns)
    tail = f"\nWHERE {where}" if where else ""
    return with_ctes(source) + f"SELECT {cols}\nFROM {source}{tail}"


SQL: dict[str, str] = {}

RAW_CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "registration_date",
                     "country", "updated_at", "total_orders"]
RAW_PRODUCT_COLS = ["product_id", "product_name", "category", "price", "created_at"]
RAW_ORDER_COLS = ["order_id", "customer_id", "product_id", "quantity", "order_date", "status",
                  "total_amount"]
STG_CUSTOMER_COLS = ["customer_id", "first_name", "last_name", "email", "registration_date",
                     "country", "country_code", "updated_at", "customer_tier",
                     "days_since_registration", "is_major_market", "activity_status",
                     "cohort_month", "total_orders", "last_updated", "full_name"]
STG_ORDER_COLS = RAW_ORDER_COLS + ["unit_price", "order_category", "order_year", "order_month",
                                   "order_quarter", "order_day_of_week", "estimated_discount",
                                   "is_weekend"]
STG_PRODUCT_COLS = RAW_PRODUCT_COLS + ["price_segment", "price_category", "days_since_created",
                                       "is_new_arrival", "category_group"]
FCT_COLS = ["sale_date", "order_year", "order_month", "order_quarter", "order_day_of_week",
            "is_weekend", "order_id", "order_category", "quantity", "total_amount",
            "estimated_discount", "net_revenue", "avg_item_price", "customer_id", "country",
            "country_code", "customer_tier", "is_major_market", "product_id", "product_name",
            "category", "price_segment", "current_price", "estimated_margin", "is_high_value",
            "is_bulk_order", "is_vip_customer"]
DSS_COLS = ["sale_date", "order_year", "order_month", "order_quarter", "country",
            "country_code", "is_major_market", "category", "price_segment", "total_orders",
            "unique_customers", "total_items_sold", "gross_revenue", "net_revenue",
            "estimated_margin", "avg_order_value", "avg_revenue_per_item",
            "avg_revenue_per_customer", "high_value_orders", "bulk_orders", "vip_orders",
            "high_value_revenue_share", "weekend_revenue_share", "weekly_revenue_change",
            "weekly_growth_rate", "rolling_7day_avg_revenue"]
DIM_COLS = ["customer_id", "first_name", "last_name", "email", "registration_date", "country",
            "country_code", "customer_tier", "first_order_date", "last_order_date",
            "total_orders", "lifetime_value", "avg_order_value", "days_since_last_order",
            "active_months", "total_items_bought", "rfm_score", "rfm_segment",
            "activity_status", "churn_risk"]

SQL["raw_customers"] = select_from("raw_customers", RAW_CUSTOMER_COLS)
SQL["raw_products"] = select_from("raw_products", RAW_PRODUCT_COLS, money("price"))
SQL["raw_orders"] = select_from("raw_orders", RAW_ORDER_COLS, money("total_amount"))
SQL["stg_customers"] = select_from("stg_customers", STG_CUSTOMER_COLS)
SQL["stg_orders"] = select_from("stg_orders", STG_ORDER_COLS,
                                money("total_amount", "estimated_discount"))
SQL["stg_products"] = select_from("stg_products", STG_PRODUCT_COLS, money("price"))
SQL["fct_daily_sales"] = select_from(
    "fct_daily_sales", FCT_COLS,
    money("total_amount", "estimated_discount", "net_revenue", "current_price",
          "estimated_margin"))
SQL["daily_sales_summary"] = select_from(
    "daily_sales_summary", DSS_COLS,
    money("gross_revenue", "net_revenue", "estimated_margin", "weekly_revenue_change"))
SQL["weekly_change"] = select_from(
    "daily_sales_summary", ["sale_date", "country", "category", "price_segment", "net_revenue",
                            "weekly_revenue_change", "weekly_growth_rate"],
    money("net_revenue", "weekly_revenue_change"))
SQL["rolling_avg"] = select_from(
    "daily_sales_summary", ["sale_date", "country", "category", "price_segment", "net_revenue",
                            "rolling_7day_avg_revenue"], money("net_revenue"))
SQL["rfm_metrics"] = select_from(
    "customer_totals", ["customer_id", "last_order_date", "frequency", "monetary", "avg_order_value",
                 "first_order_date", "recency", "active_months", "weekend_orders",
                 "total_items_bought"], money("monetary"))
SQL["rfm_scores"] = select_from(
    "customer_quartiles", ["customer_id", "recency", "frequency", "monetary", "r_score", "f_score",
                      "m_score"], money("monetary"))
SQL["rfm_segments"] = (with_ctes("dim_customers")
                       + "SELECT rfm_segment, COUNT(*) AS customers FROM dim_customers "
                         "GROUP BY rfm_segment")
SQL["dim_customers"] = select_from(
    "dim_customers", DIM_COLS,
    {**money("lifetime_value"), "avg_order_value": "CAST(avg_order_value AS DOUBLE) AS avg_order_value"})
SQL["cohort_size"] = select_from("cohort_size", ["cohort_month", "cohort_size"])
SQL["customer_cohorts"] = select_from(
    "customer_cohorts", ["cohort_month", "order_month", "period_number", "active_customers",
                         "total_revenue", "avg_revenue_per_active_customer", "retention_rate"],
    money("total_revenue"))


def all_sql() -> dict[str, str]:
    from . import oracle_more  # noqa: F401  (adds further statements)
    return dict(SQL)
