"""Further registered queries: incremental load, SCD2 history, quality,
expression coverage, seeds, generator, streaming."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators import analytics as A
from ..operators import history as H
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import staging as S
from ..operators import upsert as U
from ..sources import files as FILES
from ..sources import testbind as TB
from . import suite as SUITE
from .registry import Inputs, exposed, register

CHECK_COLS = ["first_name", "last_name", "email", "country", "customer_tier"]


def _two_loads(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    r1, r2 = TB.LOAD_RUNS
    first = M.fct_orders_rows(S.stg_orders(TB.orders_first_load(i.raw.orders)), i.stg_products, i.stg_customers, r1)
    return U.incremental_load(
        S.stg_orders(TB.orders_second_load(i.raw.orders)), U.incremental_load(first, None)[1],
        enrich=lambda o: M.fct_orders_rows(o, i.stg_products, i.stg_customers, r2))


@register("fct_orders_incremental_full")
def q_fct_orders_incremental_full(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    rows = M.fct_orders_rows(i.stg_orders, i.stg_products, i.stg_customers, TB.LOAD_RUNS[0])
    return exposed(U.incremental_load(rows, None)[1])


@register("incremental_delta")
def q_incremental_delta(spark, sf_dir):
    return exposed(_two_loads(spark, sf_dir)[0])


@register("incremental_upsert")
def q_incremental_upsert(spark, sf_dir):
    return exposed(_two_loads(spark, sf_dir)[1])


@register("stored_upsert")
def q_stored_upsert(spark, sf_dir):
    """Both loads as a stored target takes them: by month, from its key sets."""
    from ..session import new_run_id, scratch_path
    from .build import upsert_by_month
    i = Inputs(spark, sf_dir)
    products, customers = i.stg_products, i.stg_customers
    folder, table, keys = scratch_path(spark, "upsert", new_run_id()), None, None
    loads = [TB.orders_first_load(i.raw.orders), TB.orders_second_load(i.raw.orders)]
    for n, (orders, run_ts) in enumerate(zip(loads, TB.LOAD_RUNS)):
        up = upsert_by_month(spark, S.stg_orders(orders), lambda o, ts=run_ts: M.fct_orders_rows(
            o, products, customers, ts), table, f"{folder}/{n}", keys)
        table, keys = up.table, up.keys
    return exposed(up.rows.drop("order_month"))


# ----------------------------------------------------- distinct counts over repeated keys
@register("repeated_orders_summary")
def q_repeated_orders_summary(spark, sf_dir):
    """Distinct orders and customers a day where order ids are on several rows."""
    i = Inputs(spark, sf_dir)
    d = A.daily_sales_summary(i.fct_daily_sales(S.stg_orders(TB.orders_with_repeats(i.raw.orders))), ordered=False)
    return exposed(d.select(*A.SUMMARY_KEYS, "total_orders", "unique_customers", "total_items_sold",
                            "gross_revenue", "avg_revenue_per_customer"))


@register("repeated_orders_rfm")
def q_repeated_orders_rfm(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return exposed(M.rfm_metrics(S.stg_orders(TB.orders_with_repeats(i.raw.orders)), i.as_of))


@register("repeated_customers_cohorts")
def q_repeated_customers_cohorts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    c = S.stg_customers(TB.customers_with_repeats(i.raw.customers), i.as_of)
    return exposed(A.customer_cohorts(c, i.stg_orders, ordered=False))


def _snapshot_source(raw_customers, run_ts):
    return S.stg_customers(raw_customers, run_ts.date())


def snapshot_runs(spark, sf_dir, strategy: str, runs: int = 2):
    """History after ``runs`` snapshot runs over the load scenario
    (first load, second load, second load again, first load again)."""
    raw = TB.raw_customers(spark, sf_dir)
    loads = [TB.customers_first_load(raw), TB.customers_second_load(raw),
             TB.customers_second_load(raw), TB.customers_first_load(raw)]
    hist = None
    for n in range(runs):
        run_ts = TB.SNAPSHOT_RUNS[n]
        hist = H.snapshot(_snapshot_source(loads[n], run_ts), hist, "customer_id", strategy,
                          run_ts, updated_at="updated_at", check_cols=CHECK_COLS)
    return hist


@register("scd2_timestamp")
def q_scd2_timestamp(spark, sf_dir):
    return exposed(snapshot_runs(spark, sf_dir, "timestamp"))


@register("scd2_check")
def q_scd2_check(spark, sf_dir):
    return exposed(snapshot_runs(spark, sf_dir, "check"))


def _four_runs(strategy: str):
    """New, changed, unchanged, deleted and revived keys; each run's history is stored, as a build
    stores it, so the next run reads one table."""
    def q(spark, sf_dir):
        from ..session import new_run_id, scratch_path
        raw = TB.raw_customers(spark, sf_dir)
        loads = [TB.customers_first_load(raw), TB.customers_second_load(raw),
                 TB.customers_second_load(raw), TB.customers_first_load(raw)]
        folder, hist = scratch_path(spark, "history", new_run_id()), None
        for n, (load, run_ts) in enumerate(zip(loads, TB.SNAPSHOT_RUNS)):
            hist = H.snapshot(_snapshot_source(load, run_ts), hist, "customer_id", strategy, run_ts,
                              updated_at="updated_at", check_cols=CHECK_COLS)
            if n < len(loads) - 1:
                hist.write.parquet(f"{folder}/{n}")
                hist = spark.read.schema(hist.schema).parquet(f"{folder}/{n}")
        return exposed(hist)
    return q


register("scd2_timestamp_four_runs")(_four_runs("timestamp"))
register("scd2_check_four_runs")(_four_runs("check"))


# ------------------------------------------------------------------ quality


# Fixed value: run time the event freshness is measured against.
FRESHNESS_RUN_TS = datetime.datetime(2024, 2, 1, 0, 0, 0)


class LazyModels(dict):
    """Model name -> DataFrame, built on first access only (building
    dim_customers runs its ranking checkpoints)."""

    def __init__(self, factories):
        super().__init__()
        self._factories = factories

    def __missing__(self, name):
        df = self._factories[name]()
        self[name] = df
        return df

    def __contains__(self, name):
        return name in self._factories


def quality_models(spark, sf_dir) -> LazyModels:
    """The tables the declared suite reads."""
    i = Inputs(spark, sf_dir)
    return LazyModels({
        "raw_customers": lambda: i.raw.customers, "raw_products": lambda: i.raw.products,
        "raw_orders": lambda: i.raw.orders,
        "stg_customers": lambda: i.stg_customers, "stg_orders": lambda: i.stg_orders,
        "stg_products": lambda: i.stg_products,
        "dim_customers": lambda: i.dim_customers(),
        "fct_orders_incremental": lambda: U.incremental_load(
            M.fct_orders_rows(i.stg_orders, i.stg_products, i.stg_customers,
                              TB.LOAD_RUNS[0]), None)[1],
        "customers_snapshot": lambda: snapshot_runs(spark, sf_dir, "timestamp"),
    })


def _dq(kinds: set[str]):
    def q(spark, sf_dir):
        models = quality_models(spark, sf_dir)
        return Q.run_checks(models, SUITE.SUITE, as_of=TB.AS_OF, kinds=kinds)
    return q


for _key, _kinds in [("dq_unique", {"unique"}), ("dq_not_null", {"not_null"}),
                     ("dq_accepted_values", {"accepted_values"}),
                     ("dq_relationships", {"relationships"}),
                     ("dq_accepted_range", {"accepted_range"}),
                     ("dq_expression", {"expression_is_true"})]:
    register(_key)(_dq(_kinds))


@register("dq_singular")
def q_dq_singular(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    return exposed(Q.singular(i.stg_orders, F.expr(SUITE.SINGULAR_CONDITION), "singular",
                              SUITE.SINGULAR_MODEL, SUITE.SINGULAR_COLUMNS))


@register("dq_singular_rows")
def q_dq_singular_rows(spark, sf_dir):
    """The custom assertion with a condition that the given tables do violate."""
    i = Inputs(spark, sf_dir)
    return exposed(Q.singular(i.stg_orders, F.expr("quantity < 1 OR product_id IS NULL"), "singular",
                              SUITE.SINGULAR_MODEL, [*SUITE.SINGULAR_COLUMNS, "quantity"]))


@register("source_freshness")
def q_source_freshness(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    rule = Q.Freshness(SUITE.FRESHNESS_WARN_HOURS, SUITE.FRESHNESS_ERROR_HOURS)
    return Q.source_freshness(events, "ts", FRESHNESS_RUN_TS, rule, by=["event_type"])


@register("preflight_counts")
def q_preflight_counts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    from .build import preflight
    return preflight(i.raw.customers, i.raw.orders)


@register("postflight_row_counts")
def q_postflight_row_counts(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    from .build import postflight
    tables = {
        "dim_customers": i.dim_customers(),
        "fct_daily_sales": i.fct_daily_sales(),
        "fct_orders_incremental": M.fct_orders_rows(i.stg_orders, i.stg_products,
                                                    i.stg_customers, TB.LOAD_RUNS[0]),
        "daily_sales_summary": i.daily_sales_summary(ordered=False),
        "customer_cohorts": A.customer_cohorts(i.stg_customers, i.stg_orders, ordered=False),
        "stg_customers": i.stg_customers, "stg_orders": i.stg_orders,
        "stg_products": i.stg_products,
    }
    return postflight(tables, SUITE.REQUIRED_TABLES)


@register("completed_orders_rollup")
def q_completed_orders_rollup(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    from ..sources.datagen import completed_orders_rollup
    return completed_orders_rollup(i.raw.customers, i.raw.orders)


# ------------------------------------------------------- expression coverage
@register("date_parts")
def q_date_parts(spark, sf_dir):
    from ..functions.dates import days_between, dow0, month_start, months_between_starts
    i = Inputs(spark, sf_dir)
    o = i.raw.orders
    d = F.col("order_date")
    return o.select(
        "order_id", "order_date",
        month_start(d).alias("order_month_start"),
        F.year(d).alias("y"), F.month(d).alias("m"), F.quarter(d).alias("q"),
        dow0(d).alias("dow"),
        R.is_weekend(dow0(d)).alias("is_weekend"),
        days_between(i.as_of, d).alias("days_to_as_of"),
        months_between_starts(month_start(F.lit(i.as_of)), month_start(d)).alias("months_to_as_of"),
        (F.year(d) * 100 + F.month(d)).alias("year_month"),
    )


@register("null_semantics")
def q_null_semantics(spark, sf_dir):
    i = Inputs(spark, sf_dir)
    o = i.raw.orders.alias("o")
    p = i.raw.products.alias("p")
    j = o.join(p, F.col("o.product_id") == F.col("p.product_id"), "left")
    return exposed(j.select(
        "o.order_id", F.col("o.product_id").alias("product_id"), "o.quantity",
        R.safe_ratio(F.col("o.total_amount"), F.col("o.quantity")).alias("unit_price"),
        R.price_segment(F.col("p.price")).alias("price_segment"),
        R.price_category(F.col("p.price")).alias("price_category"),
        # '||' is NULL when a part is NULL; CONCAT skips NULL parts
        F.concat(F.col("o.status"), F.lit("/"), F.col("p.category")).alias("label_strict"),
        F.concat_ws("", F.col("o.status"), F.lit("/"), F.col("p.category")).alias("label_concat"),
        F.coalesce(F.col("p.category"), F.lit("none")).alias("category_or_none"),
    ))


@register("flat_discount")
def q_flat_discount(spark, sf_dir):
    o = Inputs(spark, sf_dir).stg_orders
    return exposed(o.select("order_id", "total_amount", "estimated_discount",
                            R.flat_discount(F.col("total_amount")).alias("flat_discount")))


# -------------------------------------------------------------------- seeds
@register("seed_regions_lookup")
def q_seed_regions_lookup(spark, sf_dir):
    c = Inputs(spark, sf_dir).stg_customers
    regions = FILES.read_seed(spark, "regions")
    per_country = regions.groupBy("country").agg(
        F.count(F.lit(1)).alias("region_count"),
        F.min("delivery_days").alias("fastest_delivery_days"))
    # seeds are a handful of reference rows: a proven size bound
    j = c.join(F.broadcast(per_country), "country", "left")
    return j.select("customer_id", "country",
                    F.coalesce("region_count", F.lit(0).cast("long")).alias("region_count"),
                    "fastest_delivery_days")


@register("seed_categories_lookup")
def q_seed_categories_lookup(spark, sf_dir):
    p = Inputs(spark, sf_dir).stg_products
    cats = FILES.read_seed(spark, "categories").select(
        F.col("category_name").alias("category"), "category_id", "parent_category",
        F.col("is_active").alias("category_is_active"))
    return p.join(F.broadcast(cats), "category", "left").select(
        "product_id", "category", "category_id", "parent_category", "category_is_active")


# ---------------------------------------------------------------- CSV
def _through_csv(table: str):
    """The raw table written by the CSV sink and read back by the typed raw load."""
    def q(spark, sf_dir):
        from ..session import new_run_id, scratch_path
        path = scratch_path(spark, "csv", new_run_id(), table)
        FILES.write_csv(getattr(Inputs(spark, sf_dir).raw, table), path)
        return exposed(FILES.read_raw_csv(spark, table, path))
    return q


for _table in ("customers", "products", "orders"):
    register(f"csv_{_table}")(_through_csv(_table))


# ---------------------------------------------------------------- the whole run
@register("published_build")
def q_published_build(spark, sf_dir):
    """The rows that keep the suite's rules, through the whole run: written as CSV, loaded under the
    raw constraints, staged, gated, built, published with its staging views and checked again; the
    order fact is read back from the published state, its customers through the published view."""
    from ..session import new_run_id, scratch_path
    from .build import build_or_raise, load_raw_csv, open_warehouse, published_table
    i = Inputs(spark, sf_dir)
    customers = i.raw.customers.where(F.col("country").isin(*SUITE.COUNTRIES))
    products = i.raw.products.where(F.col("category").isin(*SUITE.CATEGORIES) & F.col("price").between(0.01, 10000))
    orders = (i.raw.orders.where(F.col("status").isin(*SUITE.STATUSES) & F.col("quantity").between(1, 100)
                                 & (F.col("total_amount") >= 0.01))
              .join(customers.select("customer_id"), "customer_id", "left_semi")
              .join(products.select("product_id"), "product_id", "left_semi").select(i.raw.orders.columns))
    root = scratch_path(spark, "published", new_run_id())
    paths = {}
    for name, df in (("customers", customers), ("products", products), ("orders", orders)):
        paths[name] = f"{root}/csv/{name}"
        FILES.write_csv(df, paths[name])
    load_raw_csv(spark, paths, root)
    raw = [published_table(spark, root, f"raw_{t}") for t in ("customers", "products", "orders")]
    build_or_raise(spark, *raw, root, i.as_of, i.run_ts, tags={"incremental"}, views=True)
    open_warehouse(spark, root)
    listed = spark.table("ledger_staging.stg_customers").select("customer_id", "country_code")
    return exposed(published_table(spark, root, "fct_orders_incremental").drop("order_month")
                   .join(listed, "customer_id"))


# ---------------------------------------------------------------- generator
@register("gen_customers")
def q_gen_customers(spark, sf_dir):
    """One synthetic customer per customer key of the driver table."""
    from ..sources import datagen as G
    ids = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet").select(F.col("c_custkey").alias("id"))
    return G.customers(ids, TB.AS_OF)


@register("gen_orders_profile")
def q_gen_orders_profile(spark, sf_dir):
    """Synthetic orders, one per order key of the driver table, profiled.

    Customers are drawn from 1..count(customer) through a scalar subquery,
    so the generated volume follows the given tables."""
    from ..sources import datagen as G
    base = f"{sf_dir.rstrip('/')}"
    ids = spark.read.parquet(f"{base}/orders.parquet").select(F.col("o_orderkey").alias("id"))
    n_cust = spark.read.parquet(f"{base}/customer.parquet").agg(F.count(F.lit(1))).scalar()
    o = G.orders(ids, n_cust, G.products(spark, TB.AS_OF))
    return exposed(o.groupBy(F.year("order_date").alias("order_year"), "status").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("quantity").alias("items"),
        F.sum("total_amount").alias("revenue"),
        F.count_distinct("customer_id").alias("customers")))


# ---------------------------------------------------------------- streaming
@register("stream_incremental_load")
def q_stream_incremental_load(spark, sf_dir):
    """Both load waves as arriving order files, streamed through
    foreachBatch(upsert) until caught up (AvailableNow) after each wave;
    returns the published target."""
    from ..plans import state as ST
    from ..session import new_run_id, scratch_path
    from ..streaming.incremental import start_incremental_stream
    i = Inputs(spark, sf_dir)
    products, customers = i.stg_products, i.stg_customers
    run = new_run_id()
    table = f"ledger_stream.fct_orders_incremental_{run}"
    root, incoming = scratch_path(spark, "stream", run, "data"), scratch_path(spark, "stream", run, "in")
    waves = [TB.orders_first_load(i.raw.orders), TB.orders_second_load(i.raw.orders)]
    for n, (wave, run_ts) in enumerate(zip(waves, TB.LOAD_RUNS)):
        wave.write.parquet(f"{incoming}/wave={n}")
        stream = (spark.readStream.schema(wave.schema).option("recursiveFileLookup", True)
                  .parquet(incoming))
        q = start_incremental_stream(
            S.stg_orders(stream), table, root, scratch_path(spark, "stream", run, "checkpoint"),
            transform=lambda o, ts=run_ts: M.fct_orders_rows(o, products, customers, ts))
        q.awaitTermination()
    return exposed(ST.read(spark, ST.load(spark, root).tables[table]).drop("order_month"))
