"""Oracle statements for the stateful queries (incremental load, SCD2)."""

from __future__ import annotations

import re

from .oracle import AS_OF, CTES, DEPS, SQL, cte, money, select_from, with_ctes


def variant(base: str, name: str, deps: list[str], replacements: list[tuple[str, str]]):
    body = CTES[base]
    for a, b in replacements:
        assert a in body, (base, a)
        body = body.replace(a, b)
    cte(name, deps + [d for d in DEPS[base] if not d.startswith("raw_")], body)


def ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


LOAD_RUN_1, LOAD_RUN_2 = ts("2028-12-31 00:00:00"), ts("2029-01-01 00:00:00")
SNAP_RUNS = [ts(f"2029-0{n}-01 00:00:00") for n in (1, 2, 3, 4)]

# ------------------------------------------------------------ load batches
cte("raw_orders_b1", ["raw_orders"], """
SELECT * FROM raw_orders
WHERE order_date < DATE '2028-01-01' AND status IS DISTINCT FROM 'on_hold'""")
cte("raw_orders_b2", ["raw_orders"], """
SELECT order_id, customer_id, product_id, quantity, order_date,
       CASE WHEN status = 'pending' THEN 'completed' ELSE status END AS status, total_amount
FROM raw_orders""")
variant("stg_orders", "stg_orders_b1", ["raw_orders_b1"], [("FROM raw_orders", "FROM raw_orders_b1")])
variant("stg_orders", "stg_orders_b2", ["raw_orders_b2"], [("FROM raw_orders", "FROM raw_orders_b2")])

ORDER_FACT_COLS = ["order_id", "customer_id", "product_id", "first_name", "last_name",
                   "product_name", "category", "quantity", "order_date", "status",
                   "total_amount", "estimated_discount", "net_amount", "loaded_at"]


def order_rows(name: str, src: str, run_ts: str):
    cte(name, [src, "stg_products", "stg_customers"], f"""
SELECT o.order_id, o.customer_id, o.product_id, c.first_name, c.last_name, p.product_name,
       p.category, o.quantity, o.order_date, o.status, o.total_amount, o.estimated_discount,
       o.total_amount - o.estimated_discount AS net_amount,
       {run_ts} AS loaded_at
FROM {src} o
LEFT JOIN stg_products p ON o.product_id = p.product_id
LEFT JOIN stg_customers c ON o.customer_id = c.customer_id""")


order_rows("fct_orders_full", "stg_orders", LOAD_RUN_1)
order_rows("load1_target", "stg_orders_b1", LOAD_RUN_1)
order_rows("load2_source", "stg_orders_b2", LOAD_RUN_2)
cte("load2_delta", ["load1_target", "load2_source"], """
SELECT s.* FROM load2_source s
WHERE NOT EXISTS (SELECT 1 FROM load1_target t WHERE t.order_id = s.order_id)
   OR s.order_date >= (SELECT coalesce(max(order_date), DATE '1900-01-01') FROM load1_target)""")
cte("load2_target", ["load1_target", "load2_delta"], """
SELECT * FROM load1_target t
WHERE NOT EXISTS (SELECT 1 FROM load2_delta d WHERE d.order_id = t.order_id)
UNION ALL
SELECT * FROM load2_delta""")

_ORDER_MONEY = money("total_amount", "estimated_discount", "net_amount")


def _select(src: str, cols: list[str], casts: dict[str, str]) -> str:
    return with_ctes(src) + "SELECT " + ", ".join(casts.get(c, c) for c in cols) + f" FROM {src}"


SQL["fct_orders_incremental_full"] = _select("fct_orders_full", ORDER_FACT_COLS, _ORDER_MONEY)
SQL["incremental_delta"] = _select("load2_delta", ORDER_FACT_COLS, _ORDER_MONEY)
SQL["incremental_upsert"] = _select("load2_target", ORDER_FACT_COLS, _ORDER_MONEY)

# ------------------------------------------------------------ SCD2 history
cte("raw_customers_b1", ["raw_customers"], """
SELECT * FROM raw_customers WHERE registration_date < DATE '2028-06-01'""")
cte("raw_customers_b2", ["raw_customers"], """
SELECT customer_id, first_name, last_name, email, registration_date,
       CASE WHEN country = 'United States' THEN 'USA' ELSE country END AS country,
       CASE WHEN country = 'United States' THEN COALESCE(updated_at, registration_date) + 30
            ELSE updated_at END AS updated_at,
       CASE WHEN first_name = 'AUTOMOBILE' THEN total_orders + 60 ELSE total_orders END
           AS total_orders
FROM raw_customers
WHERE country IS DISTINCT FROM 'Brazil'""")
variant("stg_customers", "snap_src1", ["raw_customers_b1"],
        [("FROM raw_customers", "FROM raw_customers_b1"), (AS_OF, "DATE '2029-01-01'")])
for _n, _load in ((2, "b2"), (3, "b2"), (4, "b1")):
    variant("stg_customers", f"snap_src{_n}", [f"raw_customers_{_load}"],
            [("FROM raw_customers", f"FROM raw_customers_{_load}"), (AS_OF, f"DATE '2029-0{_n}-01'")])

STG_COLS = ["customer_id", "first_name", "last_name", "email", "registration_date", "country",
            "country_code", "updated_at", "customer_tier", "days_since_registration",
            "is_major_market", "activity_status", "cohort_month", "total_orders",
            "last_updated", "full_name"]
CHECK_COLS = ["first_name", "last_name", "email", "country", "customer_tier"]
META = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _scd_id(key: str, version: str) -> str:
    return (f"md5(coalesce(CAST({key} AS VARCHAR), '') || '|' || "
            f"coalesce(CAST({version} AS VARCHAR), ''))")


def scd2_sql(strategy: str, runs: int = 2) -> str:
    def version(run: str) -> str:
        return "CAST(s.updated_at AS TIMESTAMP)" if strategy == "timestamp" else run

    if strategy == "timestamp":
        changed = "h.dbt_valid_from < CAST(s.updated_at AS TIMESTAMP)"
    else:
        changed = "(" + " OR ".join(f"h.{c} IS DISTINCT FROM s.{c}" for c in CHECK_COLS) + ")"
    scols = ", ".join(f"s.{c}" for c in STG_COLS)
    hcols = ", ".join(f"h.{c}" for c in STG_COLS)
    name = ""
    for n, run in enumerate(SNAP_RUNS[:runs], 1):
        v, last, name = version(run), name, f"h{n}_{strategy}"
        fresh = f"""
SELECT {scols}, {_scd_id('s.customer_id', v)} AS dbt_scd_id, {v} AS dbt_updated_at,
       {v} AS dbt_valid_from, CAST(NULL AS TIMESTAMP) AS dbt_valid_to
FROM snap_src{n} s"""
        if n == 1:
            cte(name, ["snap_src1"], fresh)
            continue
        cte(name, [last, f"snap_src{n}"], f"""
SELECT * FROM {last} WHERE dbt_valid_to IS NOT NULL
UNION ALL
SELECT {hcols}, h.dbt_scd_id, h.dbt_updated_at, h.dbt_valid_from,
       CASE WHEN s.customer_id IS NULL THEN {run}
            WHEN {changed} THEN {v}
            ELSE h.dbt_valid_to END AS dbt_valid_to
FROM (SELECT * FROM {last} WHERE dbt_valid_to IS NULL) h
LEFT JOIN snap_src{n} s ON h.customer_id = s.customer_id
UNION ALL{fresh}
LEFT JOIN (SELECT * FROM {last} WHERE dbt_valid_to IS NULL) h ON h.customer_id = s.customer_id
WHERE h.customer_id IS NULL OR {changed}""")
    return with_ctes(name) + f"SELECT {', '.join(STG_COLS + META)} FROM {name}"


for _strategy in ("timestamp", "check"):
    SQL[f"scd2_{_strategy}"] = scd2_sql(_strategy)
    SQL[f"scd2_{_strategy}_four_runs"] = scd2_sql(_strategy, 4)

# ------------------------------------------------------------------ quality
# The declared checks, written out here on their own: a check that the
# suite lacks or states differently shows as a difference.

MODEL_CTE = {"raw_customers": "raw_customers", "raw_products": "raw_products",
             "raw_orders": "raw_orders", "stg_customers": "stg_customers",
             "stg_orders": "stg_orders", "stg_products": "stg_products",
             "dim_customers": "dim_customers", "fct_orders_incremental": "fct_orders_full",
             "customers_snapshot": "h2_timestamp"}
UNIQUE = {"raw_customers": "customer_id", "raw_products": "product_id", "raw_orders": "order_id",
          "stg_customers": "customer_id", "stg_orders": "order_id", "stg_products": "product_id",
          "dim_customers": "customer_id", "fct_orders_incremental": "order_id"}
NOT_NULL = {
    "raw_customers": "customer_id email", "raw_products": "product_id", "raw_orders": "order_id",
    "stg_customers": "customer_id email country country_code customer_tier registration_date",
    "stg_orders": "order_id customer_id product_id total_amount quantity status order_date order_category",
    "stg_products": "product_id product_name category price price_segment created_at",
    "dim_customers": "customer_id customer_tier",
    "fct_orders_incremental": "order_id customer_id order_date net_amount",
    "customers_snapshot": "customer_id dbt_valid_from"}
ACCEPTED = [
    ("stg_customers", "country", "Russia, USA, UK, Germany"),
    ("stg_customers", "country_code", "RU, US, GB, DE"),
    ("stg_customers", "customer_tier", "VIP, Gold, Silver, Bronze, New"),
    ("stg_orders", "status", "completed, pending, cancelled, refunded, shipped"),
    ("stg_orders", "order_category", "successful, in_progress, failed, unknown"),
    ("stg_products", "category", "Electronics, Clothing, Books, Home"),
    ("stg_products", "price_segment", "premium, medium, budget"),
    ("dim_customers", "customer_tier", "VIP, Gold, Silver, New, Bronze")]
RELATED = [("stg_orders", "customer_id", "stg_customers"), ("stg_orders", "product_id", "stg_products"),
           ("fct_orders_incremental", "customer_id", "dim_customers")]
RANGES = [("stg_orders", "total_amount", ">= 0.01"), ("stg_orders", "quantity", ">= 1 and <= 100"),
          ("stg_products", "price", ">= 0.01 and <= 10000"), ("fct_orders_incremental", "net_amount", ">= 0")]
EXPRESSIONS = [("stg_customers", "registration_date", "<= CURRENT_DATE"),
               ("stg_orders", "order_date", ">= '2023-01-01'"), ("stg_orders", "order_date", "<= CURRENT_DATE")]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _count(test: str, model: str, column: str, rule: str, failing: str) -> str:
    """One result row; ``failing`` is a query whose rows are the failures."""
    return (f"SELECT {_q(test)} AS test, {_q(model)} AS model, {_q(column)} AS column_name, "
            f"{_q(rule)} AS rule, (SELECT count(*) FROM ({failing}) AS bad) AS failures")


def dq_sql(test: str) -> str:
    t = MODEL_CTE
    rows, used = [], set()

    def add(model, column, rule, failing):
        used.add(t[model])
        rows.append(_count(test, model, column, rule, failing))

    if test == "unique":
        for m, c in UNIQUE.items():
            add(m, c, "", f"SELECT {c} FROM {t[m]} GROUP BY {c} HAVING count({c}) > 1")
    elif test == "not_null":
        for m, cols in NOT_NULL.items():
            for c in cols.split():
                add(m, c, "", f"SELECT 1 FROM {t[m]} WHERE {c} IS NULL")
    elif test == "accepted_values":
        for m, c, values in ACCEPTED:
            known = ", ".join(_q(v) for v in values.split(", "))
            add(m, c, f"in ({values})", f"SELECT DISTINCT {c} FROM {t[m]} WHERE {c} NOT IN ({known})")
    elif test == "relationships":
        for m, c, parent in RELATED:
            used.add(t[parent])
            add(m, c, f"{parent}.{c}",
                f"SELECT 1 FROM {t[m]} x WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {c} FROM {t[parent]})")
    else:
        for m, c, rule in RANGES if test == "accepted_range" else EXPRESSIONS:
            holds = " AND ".join(f"{c} {part}" for part in rule.split(" and "))
            add(m, c, rule, f"SELECT 1 FROM {t[m]} WHERE NOT ({holds.replace('CURRENT_DATE', AS_OF)})")
    return with_ctes(*sorted(used)) + "\nUNION ALL\n".join(rows)


for _key, _kind in [("dq_unique", "unique"), ("dq_not_null", "not_null"),
                    ("dq_accepted_values", "accepted_values"),
                    ("dq_relationships", "relationships"),
                    ("dq_accepted_range", "accepted_range"),
                    ("dq_expression", "expression_is_true")]:
    SQL[_key] = dq_sql(_kind)

SQL["dq_singular"] = (with_ctes("stg_orders") + "SELECT order_id, CAST(total_amount AS DOUBLE) "
                      "AS total_amount FROM stg_orders WHERE total_amount < 0")

SQL["source_freshness"] = """
SELECT event_type, max(ts) AS max_loaded_at,
       date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS age_microseconds,
       CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3.6e9
           AS age_hours,
       CASE WHEN max(ts) IS NULL THEN 'error'
            WHEN CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3.6e9 > 48 THEN 'error'
            WHEN CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01 00:00:00') AS DOUBLE) / 3.6e9 > 24 THEN 'warn'
            ELSE 'pass' END AS status
FROM events GROUP BY event_type"""

SQL["preflight_counts"] = with_ctes("raw_customers", "raw_orders") + """
SELECT c.customers, o.completed_orders,
       c.customers > 0 AS customers_present, o.completed_orders > 0 AS completed_present,
       CASE WHEN c.customers > 0 AND o.completed_orders > 0 THEN 'pass' ELSE 'fail' END AS status
FROM (SELECT count(*) AS customers FROM raw_customers) c,
     (SELECT count(*) FILTER (WHERE status = 'completed') AS completed_orders FROM raw_orders) o"""

_POST = [("dim_customers", "dim_customers"), ("fct_daily_sales", "fct_daily_sales"),
         ("fct_orders_incremental", "fct_orders_full"),
         ("daily_sales_summary", "daily_sales_summary"), ("customer_cohorts", "customer_cohorts"),
         ("stg_customers", "stg_customers"), ("stg_orders", "stg_orders"),
         ("stg_products", "stg_products")]
SQL["postflight_row_counts"] = with_ctes(*[c for _, c in _POST]) + "\nUNION ALL\n".join(
    f"SELECT {_q(n)} AS table_name, TRUE AS table_exists, count(*) AS row_count, "
    f"CASE WHEN count(*) = 0 THEN 'empty' ELSE 'ok' END AS status FROM {c}" for n, c in _POST)

SQL["completed_orders_rollup"] = with_ctes("raw_customers", "raw_orders") + """
SELECT c.customer_id, COALESCE(d.n, 0) AS total_orders
FROM raw_customers c
LEFT JOIN (SELECT customer_id, count(*) AS n FROM raw_orders WHERE status = 'completed'
           GROUP BY customer_id) d ON c.customer_id = d.customer_id"""

SQL["date_parts"] = with_ctes("raw_orders") + f"""
SELECT order_id, order_date,
       CAST(date_trunc('month', order_date) AS DATE) AS order_month_start,
       CAST(EXTRACT(YEAR FROM order_date) AS INTEGER) AS y,
       CAST(EXTRACT(MONTH FROM order_date) AS INTEGER) AS m,
       CAST(EXTRACT(QUARTER FROM order_date) AS INTEGER) AS q,
       CAST(EXTRACT(DOW FROM order_date) AS INTEGER) AS dow,
       CASE WHEN EXTRACT(DOW FROM order_date) IN (0, 6) THEN TRUE ELSE FALSE END AS is_weekend,
       CAST(date_diff('day', order_date, {AS_OF}) AS INTEGER) AS days_to_as_of,
       CAST((EXTRACT(YEAR FROM {AS_OF}) - EXTRACT(YEAR FROM order_date)) * 12
            + EXTRACT(MONTH FROM {AS_OF}) - EXTRACT(MONTH FROM order_date) AS INTEGER) AS months_to_as_of,
       CAST(EXTRACT(YEAR FROM order_date) * 100 + EXTRACT(MONTH FROM order_date) AS INTEGER) AS year_month
FROM raw_orders"""

SQL["null_semantics"] = with_ctes("raw_orders", "raw_products") + """
SELECT o.order_id, o.product_id, o.quantity,
       CAST(o.total_amount AS DOUBLE) / CAST(NULLIF(o.quantity, 0) AS DOUBLE) AS unit_price,
       CASE WHEN p.price IS NULL THEN 'unknown' WHEN p.price > 1000 THEN 'premium'
            WHEN p.price > 100 THEN 'medium' ELSE 'budget' END AS price_segment,
       CASE WHEN p.price > 1000 THEN 'premium' WHEN p.price > 100 THEN 'medium'
            ELSE 'budget' END AS price_category,
       o.status || '/' || p.category AS label_strict,
       CONCAT(o.status, '/', p.category) AS label_concat,
       COALESCE(p.category, 'none') AS category_or_none
FROM raw_orders o LEFT JOIN raw_products p ON o.product_id = p.product_id"""

SQL["flat_discount"] = with_ctes("stg_orders") + """
SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(estimated_discount AS DOUBLE) AS estimated_discount,
       CAST(CASE WHEN total_amount > 500 THEN total_amount * 0.2 ELSE 0 END AS DOUBLE) AS flat_discount
FROM stg_orders"""

SEED_REGIONS_SQL = """(VALUES ('NYC', 'New York City', 'USA', 2), ('LAX', 'Los Angeles', 'USA', 3),
        ('LON', 'London', 'UK', 5), ('BER', 'Berlin', 'Germany', 4),
        ('TYO', 'Tokyo', 'Japan', 7)) AS r(region_code, region_name, country, delivery_days)"""
SEED_CATEGORIES_SQL = """(VALUES (1, 'Electronics', 'Technology', TRUE),
        (2, 'Smartphones', 'Electronics', TRUE), (3, 'Laptops', 'Electronics', TRUE),
        (4, 'Clothing', 'Apparel', TRUE), (5, 'Books', 'Media', FALSE))
        AS k(category_id, category_name, parent_category, is_active)"""

SQL["seed_regions_lookup"] = with_ctes("stg_customers") + f"""
SELECT c.customer_id, c.country, COALESCE(r.region_count, 0) AS region_count,
       r.fastest_delivery_days
FROM stg_customers c
LEFT JOIN (SELECT country, count(*) AS region_count,
                  CAST(min(delivery_days) AS INTEGER) AS fastest_delivery_days
           FROM {SEED_REGIONS_SQL} GROUP BY country) r ON c.country = r.country"""

SQL["seed_categories_lookup"] = with_ctes("stg_products") + f"""
SELECT p.product_id, p.category, CAST(k.category_id AS INTEGER) AS category_id,
       k.parent_category, k.is_active AS category_is_active
FROM stg_products p LEFT JOIN {SEED_CATEGORIES_SQL} ON p.category = k.category_name"""

SQL["stream_incremental_load"] = SQL["stored_upsert"] = SQL["incremental_upsert"]


# ---------------------------------------------------------------- generator
# Fixed values of the generator, written out: price ranges by product number,
# cumulated status weights, Poisson(1) terms.
GEN_PRICES = [(1, 13, 29.99, 2499.99), (14, 26, 9.99, 299.99), (27, 36, 19.99, 89.99), (37, 46, 49.99, 999.99)]
GEN_STATUS = [("completed", 0.65), ("pending", 0.15), ("cancelled", 0.08), ("refunded", 0.05), ("shipped", 0.07)]


def _u(id_sql: str, salt: str) -> str:
    return (f"(CAST(CAST('0x' || substr(md5(CAST({id_sql} AS VARCHAR) || '|{salt}'), 1, 13) AS BIGINT) AS DOUBLE)"
            " / 4503599627370496.0)")


def _double(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def _steps(u: str, terms: list[tuple[str, float]], last: str) -> str:
    """CASE over a running sum of weights."""
    run, out = 0.0, "CASE"
    for label, weight in terms:
        run += weight
        out += f" WHEN {u} < {_double(run)} THEN {label}"
    return f"{out} ELSE {last} END"


def _gen_orders() -> str:
    import math
    whole = sum(w for _, w in GEN_STATUS)
    status = _steps("us", [(_q(n), w / whole) for n, w in GEN_STATUS[:-1]], _q(GEN_STATUS[-1][0]))
    poisson = _steps("uq", [(str(k), math.exp(-1.0) / math.factorial(k)) for k in range(17)], "17")
    ranges = ", ".join(f"({a}, {b}, {_double(lo)}, {_double(hi)})" for a, b, lo, hi in GEN_PRICES)
    return f"""
WITH draws AS (
  SELECT o_orderkey AS id, {_u('o_orderkey', 'year')} AS uy, {_u('o_orderkey', 'status')} AS us,
         {_u('o_orderkey', 'qty')} AS uq, {_u('o_orderkey', 'amount')} AS ua,
         CAST(floor({_u('o_orderkey', 'cust')} * (SELECT count(*) FROM customer)) AS BIGINT) + 1 AS cust,
         CAST(floor({_u('o_orderkey', 'prod')} * 46) AS BIGINT) + 1 AS prod
  FROM orders),
prices AS (
  SELECT p AS prod, CAST(round(lo + {_u('p', 'price')} * (hi - lo), 2) AS DECIMAL(10,2)) AS price
  FROM range(1, 47) AS t(p) JOIN (VALUES {ranges}) AS r(a, b, lo, hi) ON p BETWEEN a AND b),
made AS (
  SELECT CASE WHEN uy < {_double(0.7)} THEN 2024 ELSE 2023 END AS order_year, {status} AS status,
         {poisson} + 1 AS quantity, cust, price, {_double(0.8)} + ua * {_double(1.2 - 0.8)} AS factor
  FROM draws JOIN prices USING (prod))
SELECT CAST(order_year AS INTEGER) AS order_year, status, count(*) AS orders, CAST(sum(quantity) AS BIGINT) AS items,
       CAST(sum(CAST(round(CAST(price AS DOUBLE) * quantity * factor, 2) AS DECIMAL(10,2))) AS DOUBLE) AS revenue,
       count(DISTINCT cust) AS customers
FROM made GROUP BY ALL"""


SQL["gen_orders_profile"] = _gen_orders()

# Fixed values of the generator: names, mail domains, countries.
GEN_LISTS = {
    "first": ["John", "Sarah", "Michael", "Emma", "James", "Emily", "Robert", "Linda", "David", "Lisa"],
    "last": ["Smith", "Johnson", "Williams", "Brown", "Jones", "Miller", "Davis", "Wilson", "Moore", "Taylor"],
    "domain": ["mail.ru", "gmail.com", "yahoo.com", "yandex.ru", "outlook.com"],
    "country": ["Russia", "USA", "UK", "Germany"]}


def _pick(salt: str) -> str:
    values = GEN_LISTS[salt]
    return f"list_extract([{', '.join(map(_q, values))}], CAST(floor({_u('c_custkey', salt)} * {len(values)}) AS INTEGER) + 1)"


SQL["gen_customers"] = f"""
WITH drawn AS (
  SELECT CAST(c_custkey AS BIGINT) AS customer_id, {_pick('first')} AS first_name, {_pick('last')} AS last_name,
         CAST(floor({_u('c_custkey', 'num')} * 999) AS INTEGER) + 1 AS number, {_pick('domain')} AS domain,
         {AS_OF} - CAST(floor(least(-ln(1 - {_u('c_custkey', 'reg')}) * 100, 730)) AS INTEGER) AS registration_date,
         {_pick('country')} AS country, CAST(floor({_u('c_custkey', 'upd')} * 365) AS INTEGER) + 1 AS update_days
  FROM customer)
SELECT customer_id, first_name, last_name,
       lower(first_name) || '.' || lower(last_name) || CAST(number AS VARCHAR) || '@' || domain AS email,
       registration_date, country, registration_date + update_days AS updated_at, CAST(0 AS INTEGER) AS total_orders
FROM drawn"""

# a raw table written as CSV and loaded again is the raw table
for _table in ("customers", "products", "orders"):
    SQL[f"csv_{_table}"] = SQL[f"raw_{_table}"]

SQL["dq_singular_rows"] = with_ctes("stg_orders") + """SELECT order_id, CAST(total_amount AS DOUBLE) AS total_amount, quantity
FROM stg_orders WHERE quantity < 1 OR product_id IS NULL"""

# ------------------------------------------- distinct counts over repeated keys
cte("raw_orders_twice", ["raw_orders"], """
SELECT * FROM raw_orders
UNION ALL
SELECT order_id, CASE WHEN order_id % 9 = 0 THEN customer_id + 1 ELSE customer_id END, product_id, quantity,
       order_date, status, total_amount
FROM raw_orders WHERE order_id % 3 = 0""")
cte("raw_customers_twice", ["raw_customers"], """
SELECT * FROM raw_customers UNION ALL SELECT * FROM raw_customers WHERE customer_id % 4 = 0""")


def over(base: str, old: str, new: str) -> None:
    """``base`` computed over table ``new`` in place of ``old``, as <base>_twice."""
    cte(f"{base}_twice", [new if d == old else d for d in DEPS[base]],
        re.sub(rf"\b{old}\b", new, CTES[base]))


over("stg_orders", "raw_orders", "raw_orders_twice")
over("fct_daily_sales", "stg_orders", "stg_orders_twice")
over("daily_grain", "fct_daily_sales", "fct_daily_sales_twice")
over("customer_totals", "stg_orders", "stg_orders_twice")
over("stg_customers", "raw_customers", "raw_customers_twice")
over("cohort_size", "stg_customers", "stg_customers_twice")
cte("cohorts_once_replaced", ["stg_customers_twice", "stg_orders", "cohort_size_twice"],
    CTES["customer_cohorts"].replace("stg_customers", "stg_customers_twice").replace("cohort_size USING",
                                                                                      "cohort_size_twice USING"))
SQL["repeated_orders_summary"] = select_from("daily_grain_twice", [
    "sale_date", "order_year", "order_month", "order_quarter", "country", "country_code", "is_major_market",
    "category", "price_segment", "total_orders", "unique_customers", "total_items_sold", "gross_revenue",
    "avg_revenue_per_customer"], money("gross_revenue"))
SQL["repeated_orders_rfm"] = with_ctes("customer_totals_twice") + """SELECT * REPLACE (CAST(monetary AS DOUBLE) AS monetary)
FROM customer_totals_twice"""
SQL["repeated_customers_cohorts"] = (with_ctes("cohorts_once_replaced")
                                     + "SELECT * REPLACE (CAST(total_revenue AS DOUBLE) AS total_revenue) "
                                       "FROM cohorts_once_replaced")

# the whole run over the rows that keep the suite's rules
SQL["published_build"] = with_ctes("fct_orders_full") + f"""SELECT {', '.join(
    f"CAST(f.{c} AS DOUBLE) AS {c}" if c in ("total_amount", "estimated_discount", "net_amount") else f"f.{c}"
    for c in ORDER_FACT_COLS)}, c.country_code
FROM fct_orders_full f JOIN stg_customers c ON c.customer_id = f.customer_id
JOIN stg_products p ON p.product_id = f.product_id
WHERE c.country IN ('Russia', 'USA', 'UK', 'Germany') AND p.category IN ('Electronics', 'Clothing', 'Books', 'Home')
  AND p.price BETWEEN 0.01 AND 10000 AND f.quantity BETWEEN 1 AND 100 AND f.total_amount >= 0.01
  AND f.status IN ('completed', 'pending', 'cancelled', 'refunded', 'shipped')"""
