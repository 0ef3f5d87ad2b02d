"""Build: gates, ordered materialisation, all-or-nothing publish.

Order of a run (the reference's DAG, as one Spark application):

1. pre-flight: customers present and at least one completed order; the
   source freshness, when a load time is given;
2. staging views are registered, the checks on sources and staging run;
3. each further model is written under ``<root>/_runs/<run_id>/`` (never
   into a folder that exists) and checked at once; a failed check stops
   the run there and its folder is removed;
4. publish: one manifest version under ``<root>`` names every table's
   folders (state.py).  A crash before it leaves the old version, after
   it the new one; catalog entries follow the manifest;
5. the checks run again over the published tables;
6. post-flight: required tables read from the catalog, row counts, empty
   ones flagged; a missing one is an error.

Targets and histories come from the manifest, so they survive the
process.  Incremental and snapshot tables rewrite only the partitions a
run changes: order months, and the open versions (plus one new partition
of versions closed by the run).
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, SparkRuntimeException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import state as ST
from ..operators import analytics as A
from ..operators import history as H
from ..operators import keysets as KS
from ..operators import marts as M
from ..operators import quality as Q
from ..operators import skew as SK
from ..operators import staging as S
from ..operators import upsert as U
from ..session import new_run_id
from ..sources.files import read_seed
from . import suite as SUITE
from .views import view_sql

LAYERS = {"staging": "ledger_staging", "marts": "ledger_marts",
          "analytics": "ledger_analytics", "snapshots": "ledger_snapshots"}

# (name, layer, tags) in dependency order.
MODELS = [
    ("stg_customers", "staging", {"staging", "customers"}),
    ("stg_orders", "staging", {"staging", "orders"}),
    ("stg_products", "staging", {"staging", "products"}),
    ("dim_customers", "marts", {"marts", "customers", "core"}),
    ("fct_daily_sales", "marts", {"marts", "sales", "core"}),
    ("fct_orders_incremental", "marts", {"marts", "incremental", "orders"}),
    ("daily_sales_summary", "analytics", {"analytics", "reporting"}),
    ("customer_cohorts", "analytics", {"analytics", "cohorts"}),
    ("customers_snapshot", "snapshots", {"snapshots"}),
    ("customers_snapshot_check", "snapshots", {"snapshots"}),
]
PARTITION_COLUMNS = {"fct_daily_sales": ["order_year", "order_month"]}
CHECK_COLUMNS = ["first_name", "last_name", "email", "country", "customer_tier"]


class PreflightError(RuntimeError):
    pass


class QualityGateError(RuntimeError):
    pass


def preflight(raw_customers: DataFrame, raw_orders: DataFrame) -> DataFrame:
    """One row: source counts and whether the run may start."""
    completed = raw_orders.agg(F.count_if(F.col("status") == "completed")).scalar()
    j = raw_customers.agg(F.count(F.lit(1)).alias("customers"),
                          F.first(completed).alias("completed_orders"))
    ok = (F.col("customers") > 0) & (F.col("completed_orders") > 0)
    return j.select("customers", "completed_orders",
                    (F.col("customers") > 0).alias("customers_present"),
                    (F.col("completed_orders") > 0).alias("completed_present"),
                    F.when(ok, "pass").otherwise("fail").alias("status"))


def postflight(tables: dict[str, DataFrame], required: list[str]) -> DataFrame:
    """Required tables: present?, row count, ok / empty / missing."""
    spark = SparkSession.getActiveSession()
    parts = []
    for name in required:
        if name in tables:
            parts.append(tables[name].agg(F.count(F.lit(1)).alias("row_count"))
                         .select(F.lit(name).alias("table_name"),
                                 F.lit(True).alias("table_exists"), "row_count"))
        else:
            parts.append(spark.range(1).select(F.lit(name).alias("table_name"),
                                               F.lit(False).alias("table_exists"),
                                               F.lit(None).cast("long").alias("row_count")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(~F.col("table_exists"), "missing")
              .when(F.col("row_count") == 0, "empty").otherwise("ok"))
    return out.withColumn("status", status)


@dataclass
class BuildResult:
    run_id: str
    published: bool
    tables: dict[str, str] = field(default_factory=dict)
    failures: list = field(default_factory=list)
    postflight: list = field(default_factory=list)


def published_table(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The published version of a table, from the root's manifest."""
    t = ST.load(spark, root).tables.get(name)
    return None if t is None else ST.read(spark, t)


INCREMENTAL = "fct_orders_incremental"
INCREMENTAL_KEY, INCREMENTAL_DATE, INCREMENTAL_PART = "order_id", "order_date", "order_month"


def keys_of(name: str) -> str:
    """Manifest entry of a table's stored key sets."""
    return f"{name}.keys"


@dataclass
class Upsert:
    """An incremental run: the entries to publish and the rows it loaded."""
    spark: SparkSession
    table: ST.Table
    keys: ST.Table
    delta: DataFrame
    metrics: Q.Metrics | None = None

    @property
    def rows(self) -> DataFrame:
        """The would-be table."""
        return ST.read(self.spark, self.table)


def _month_keys(rows: DataFrame, months: list, path: str, kept: list) -> ST.Table:
    """Stored key sets of ``rows``, which lie in ``months``, beside those of the months kept."""
    sets = KS.key_sets(rows, INCREMENTAL_KEY, (INCREMENTAL_PART,))
    sets.write.parquet(path)  # few files: the months of a run lie together
    return ST.Table(schema=sets.schema.json(), parts=kept + [[v, path] for v in months])


def read_keys(spark: SparkSession, keys: ST.Table) -> DataFrame:
    """The key sets of the months that each run's folder still stands for."""
    schema = T.StructType.fromJson(json.loads(keys.schema))
    by_folder: dict[str, list] = {}
    for (month,), path in keys.parts:
        by_folder.setdefault(path, []).append(_dt.date.fromisoformat(month))
    out = None
    for path, months in by_folder.items():
        df = spark.read.schema(schema).parquet(path).where(F.col(INCREMENTAL_PART).isin(months))
        out = df if out is None else out.unionByName(df)
    return out if out is not None else spark.createDataFrame([], schema)


def choose_changes(spark: SparkSession, orders: DataFrame, table: ST.Table, keys: ST.Table,
                   path: str) -> tuple[DataFrame, DataFrame]:
    """(chosen order rows, replaced keys with their months), each written once under ``path``.

    Of the target only its newest month (for the latest date) and its key sets are read."""
    newest = max((p[0][0] for p in table.parts), default=None)
    latest = U.EMPTY_TARGET_DATE
    if newest is not None:
        latest = ST.read(spark, ST.only(table, [newest])).agg(F.max(INCREMENTAL_DATE)).first()[0]
    held = read_keys(spark, keys)

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    missing = written(U.missing_keys(orders, held, INCREMENTAL_KEY, INCREMENTAL_DATE, latest), "missing")
    chosen = written(U.chosen_rows(orders, missing, INCREMENTAL_KEY, INCREMENTAL_DATE, latest), "chosen")
    return chosen, written(U.replaced_keys(chosen, held, INCREMENTAL_KEY, INCREMENTAL_PART), "replaced")


def upsert_by_month(spark: SparkSession, orders: DataFrame, enrich, table: ST.Table | None,
                    path: str, keys: ST.Table | None = None, checks=(), as_of=None) -> Upsert:
    """Keyed upsert of an order fact, rewriting only touched months.

    First load: the whole fact, partitioned by order month, and the sets of
    its keys per month.  Later loads choose their rows from those sets
    (``choose_changes``); only the months that chosen or replaced rows lie
    in are read and written anew, with their key sets.  ``keys``: the entry
    that goes with ``table``; made from the table where it is missing.
    ``checks``: row checks whose metrics are taken of the rows written.
    """
    month = F.trunc(INCREMENTAL_DATE, "month")

    def rows(o: DataFrame) -> DataFrame:
        return enrich(o).withColumn(INCREMENTAL_PART, month)

    data, by = f"{path}/data", [INCREMENTAL_PART]
    if table is None:
        whole, seen = Q.observed(rows(orders), checks, as_of)
        _write_partitioned(whole, data, by)
        back = _read_back(spark, data, whole)
        months = ST.partition_values(spark, data)
        found = Q.settle(checks, seen.get)
        entry = ST.partitioned(back, by, [[v, data] for v in months], rows=found.rows)
        return Upsert(spark, entry, _month_keys(back, months, f"{path}/keys", []), back, found)
    if keys is None:
        keys = _month_keys(ST.read(spark, table), [p[0] for p in table.parts], f"{path}/keys-of-target", [])
    chosen, replaced = choose_changes(spark, orders, table, keys, path)
    columns = ST.columns(table)
    delta = rows(chosen).select(columns)
    # one value per touched month: bounded by the calendar
    touched = [r[0] for r in chosen.select(month.alias(INCREMENTAL_PART))
               .unionByName(replaced.select(INCREMENTAL_PART)).distinct().collect()]
    if any(v is None for v in touched):
        raise ValueError("orders without a date cannot be loaded incrementally")
    if not touched:
        return Upsert(spark, table, keys, delta, Q.Metrics(0, [], []))
    gone = {str(v) for v in touched}
    old, before = Q.observed(ST.read(spark, ST.only(table, touched)).select(columns), ())
    new, after = Q.observed(U.rewritten(old, delta, replaced, INCREMENTAL_KEY), checks, as_of)
    _write_partitioned(new, data, by)
    found = Q.settle(checks, after.get)
    total = None if table.rows is None else table.rows - before.get["rows"] + found.rows
    fresh = _read_back(spark, data, old)
    months = ST.partition_values(spark, data)
    entry = ST.partitioned(old, by, [p for p in table.parts if p[0][0] not in gone] + [[v, data] for v in months], rows=total)
    new_keys = _month_keys(fresh, months, f"{path}/keys", [p for p in keys.parts if p[0][0] not in gone])
    return Upsert(spark, entry, new_keys, delta, found)


SNAPSHOTS = {"customers_snapshot": "timestamp", "customers_snapshot_check": "check"}
SNAPSHOT_STATE, OPEN_STATE, SNAPSHOT_KEY = "version_state", "open", "customer_id"


def _snapshot_step(spark: SparkSession, name: str, source: DataFrame, run_ts, path: str,
                   run_id: str, table: ST.Table | None, checks=(), as_of=None
                   ) -> tuple[DataFrame, ST.Table, Q.Metrics]:
    """SCD2 run that reads and rewrites only the open versions.

    The history is partitioned by ``version_state``: 'open' for current
    versions and 'closed-<run id>' for the versions a run closed, each in
    buckets by key.  A run merges the open partition with the source, of
    which alone rows are exchanged, writes the new open rows and this run's
    closed rows, and publishes both partitions.
    """
    strategy = SNAPSHOTS[name]
    parts, open_rows = [], None
    buckets = [SNAPSHOT_KEY, int(spark.conf.get("spark.sql.shuffle.partitions"))]
    if table is not None:
        parts = [p for p in table.parts if p[0][0] != OPEN_STATE]
        buckets = table.buckets
        current = ST.only(table, [OPEN_STATE])
        if current.parts:
            open_rows = ST.read_bucketed(spark, current).drop(SNAPSHOT_STATE)
    # the check of the source's key ran before: it is not NULL
    merged = H.snapshot(source, open_rows, SNAPSHOT_KEY, strategy, run_ts,
                        check_cols=CHECK_COLUMNS if strategy == "check" else (),
                        keys_not_null=True, only_open=True)
    merged = merged.withColumn(SNAPSHOT_STATE, F.when(F.col(H.VALID_TO).isNull(), OPEN_STATE)
                               .otherwise(f"closed-{run_id}"))
    data, by = f"{path}/data", [SNAPSHOT_STATE]
    opened = Observation()
    merged = merged.observe(opened, F.count_if(F.col(SNAPSHOT_STATE) == OPEN_STATE).alias("rows"))
    merged, seen = Q.observed(merged, checks, as_of)
    ST.write_bucketed(merged, data, by, buckets)
    if open_rows is not None:
        ST.forget_bucketed(spark, current)
    fresh = _read_back(spark, data, merged)
    found = Q.settle(checks, seen.get)
    total = found.rows
    if table is not None:
        total = None if table.rows is None else table.rows - table.open_rows + total
    new = ST.partitioned(fresh, by, parts + [[v, data] for v in ST.partition_values(spark, data)],  # <= 2 new
                         rows=total, open_rows=opened.get["rows"], buckets=buckets)
    return ST.read(spark, new), new, found


def _write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """Rows of a partition meet in few files: dealt by partition, large
    partitions split and small ones joined by AQE's rebalancing."""
    df.hint("rebalance", *by).write.partitionBy(*by).parquet(path)


def _read_back(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    # partition columns come back last; restore the model's column order
    return spark.read.schema(like.schema).parquet(path).select(like.columns)


SEED_LAYER = "ledger_reference"


def _seed_checks() -> list:
    from ..sources.schemas import SEED_VARCHAR_LIMITS
    return [Q.Check("max_length", t, c, max_length=n)
            for t, limits in SEED_VARCHAR_LIMITS.items() for c, n in limits.items()]


def catalog_names(tables) -> dict[str, str]:
    """Catalog entry of every manifest table."""
    layers = {name: LAYERS[layer] for name, layer, _ in MODELS}
    out = {}
    for t in tables:
        if t.startswith("raw_"):
            out[t] = f"{RAW_LAYER}.{t[4:]}"
        elif t.startswith("seed_"):
            out[t] = f"{SEED_LAYER}.{t[5:]}"
        elif t in layers:
            out[t] = f"{layers[t]}.{t}"
    return out


def open_warehouse(spark: SparkSession, root: str) -> ST.Manifest:
    """Catalog entries for everything the root has published (new process)."""
    m = ST.load(spark, root)
    ST.sync_catalog(spark, m, catalog_names(m.tables))
    return m


class PostflightError(RuntimeError):
    pass


def build(spark: SparkSession, raw_customers: DataFrame, raw_products: DataFrame,
          raw_orders: DataFrame, root: str, as_of: _dt.date, run_ts: _dt.datetime,
          tags: set[str] | None = None, run_id: str | None = None,
          loaded_at: DataFrame | None = None, views: bool = False) -> BuildResult:
    """``loaded_at``: one timestamp column, when the sources were loaded;
    with it, a source too old for the freshness rule stops the run.
    ``views``: the sources are the raw tables this root has published; the
    staging views over them are published too, for any session."""
    run_id = run_id or new_run_id()
    run_dir = f"{root.rstrip('/')}/_runs/{run_id}"
    if ST.exists(spark, run_dir):
        raise ValueError(f"run folder {run_dir} exists already")

    pf = preflight(raw_customers, raw_orders).first()
    if pf["status"] != "pass":
        raise PreflightError(f"pre-flight failed: {pf.asDict()}")
    if loaded_at is not None:
        rule = Q.Freshness(SUITE.FRESHNESS_WARN_HOURS, SUITE.FRESHNESS_ERROR_HOURS)
        fresh = Q.source_freshness(loaded_at, loaded_at.columns[0], run_ts, rule).first()
        if fresh["status"] == "error":
            raise PreflightError(f"sources are stale: {fresh.asDict()}")
    try:
        res = _build(spark, raw_customers, raw_products, raw_orders, root, run_dir, as_of, run_ts,
                     tags, run_id, views)
    except BaseException:
        ST.remove_folder(spark, run_dir)
        raise
    if not res.published:
        ST.remove_folder(spark, run_dir)
    return res


def staging_views(spark: SparkSession, manifest: ST.Manifest, as_of: _dt.date) -> dict[str, ST.Table]:
    """The staging layer as views over the published raw tables."""
    ST.sync_catalog(spark, manifest, {f"raw_{t}": f"{RAW_LAYER}.{t}" for t in ("customers", "products", "orders")})
    out = {}
    for t, stage in (("customers", lambda df: S.stg_customers(df, as_of)), ("orders", S.stg_orders),
                     ("products", lambda df: S.stg_products(df, as_of))):
        table = f"{RAW_LAYER}.{t}"
        df = stage(spark.table(table))
        out[f"stg_{t}"] = ST.Table(schema=df.schema.json(), sql=view_sql(df, table))
    return out


def _build(spark, raw_customers, raw_products, raw_orders, root, run_dir, as_of, run_ts, tags,
           run_id, views=False) -> BuildResult:
    manifest = ST.load(spark, root)
    # frequent order keys, as the raw load found them (older ones cost balance, never rows)
    hot = manifest.tables["raw_orders"].hot if "raw_orders" in manifest.tables else None

    def wanted(model_tags):
        return tags is None or bool(tags & model_tags)

    stg = {
        "stg_customers": S.stg_customers(raw_customers, as_of),
        "stg_orders": S.stg_orders(raw_orders),
        "stg_products": S.stg_products(raw_products, as_of),
    }
    for name, df in stg.items():
        df.createOrReplaceTempView(name)

    builders = {
        "dim_customers": lambda: M.dim_customers(stg["stg_customers"], stg["stg_orders"], as_of,
                                                   unique_orders=True),  # a check before says so
        "fct_daily_sales": lambda: M.fct_daily_sales(stg["stg_orders"], stg["stg_products"],
                                                     stg["stg_customers"], hot),
        "daily_sales_summary": lambda: A.daily_sales_summary(built["fct_daily_sales"],
                                                             ordered=False, unique_orders=True),
        "customer_cohorts": lambda: A.customer_cohorts(stg["stg_customers"], stg["stg_orders"],
                                                       ordered=False),
    }
    built: dict[str, DataFrame] = dict(stg)
    models = {**stg, "raw_customers": raw_customers, "raw_products": raw_products,
              "raw_orders": raw_orders}
    entries: dict[str, ST.Table] = {}
    paths: dict[str, str] = {}
    done: set[int] = set()
    row_checks = {m: [c for c in SUITE.SUITE if c.model == m and c.kind in Q.METRIC_LEVEL]
                  for m in {c.model for c in SUITE.SUITE}}
    counted: dict[str, int] = {}

    def settled(name: str, metrics: Q.Metrics) -> list:
        """Failures of the row checks, from metrics of the pass that wrote (or profiled) the rows."""
        if metrics.open:
            return metrics.failures + Q.gate(Q.run_checks(models, metrics.open, as_of=as_of)).failures
        return metrics.failures

    def key_failures() -> list:
        """The uniqueness and relationship checks that have become possible with the models so far."""
        ready = [(i, c) for i, c in enumerate(SUITE.SUITE) if i not in done and c.kind not in Q.METRIC_LEVEL
                 and c.model in models and (c.kind != "relationships" or c.to in models)]
        done.update(i for i, _ in ready)
        return Q.gate(Q.run_checks(models, [c for _, c in ready], as_of=as_of)).failures if ready else []

    found = []
    for name, df in list(models.items()):
        metrics = Q.profile(df, row_checks.get(name, []), as_of)
        counted[name] = metrics.rows
        found += settled(name, metrics)
    found += key_failures() + Q.gate(Q.singular_result(
        models[SUITE.SINGULAR_MODEL], SUITE.SINGULAR_CONDITION, SUITE.SINGULAR_MODEL,
        "total_amount")).failures
    if wanted({"seeds"}) and not found:
        seeds = {}
        for seed in ("regions", "categories"):
            paths[f"seed_{seed}"] = path = f"{run_dir}/seed_{seed}"
            read_seed(spark, seed).write.parquet(path)
            seeds[seed] = spark.read.parquet(path)
            entries[f"seed_{seed}"] = ST.plain(seeds[seed], path)
        found = Q.gate(Q.run_checks(seeds, _seed_checks())).failures
    for name, layer, model_tags in MODELS:
        if found:
            break  # what would come after a failed model is not built
        if layer == "staging" or not wanted(model_tags):
            continue
        if name == "daily_sales_summary" and "fct_daily_sales" not in built:
            built["fct_daily_sales"] = builders["fct_daily_sales"]()
        path = paths[name] = f"{run_dir}/{name}"
        checks = row_checks.get(name, [])
        if name == INCREMENTAL:
            up = upsert_by_month(
                spark, stg["stg_orders"],
                lambda o: M.fct_orders_rows(o, stg["stg_products"], stg["stg_customers"], run_ts, hot),
                manifest.tables.get(name), path, manifest.tables.get(keys_of(name)), checks, as_of)
            built[name], entries[name], entries[keys_of(name)] = up.rows, up.table, up.keys
            metrics = up.metrics
        elif name in SNAPSHOTS:
            built[name], entries[name], metrics = _snapshot_step(
                spark, name, stg["stg_customers"], run_ts, path, run_id, manifest.tables.get(name), checks, as_of)
        else:
            df, seen = Q.observed(builders[name](), checks, as_of)
            by = PARTITION_COLUMNS.get(name, [])
            if by:
                _write_partitioned(df, path, by)
            else:
                df.write.parquet(path)
            built[name], metrics = _read_back(spark, path, df), Q.settle(checks, seen.get)
            entries[name] = ST.partitioned(
                built[name], by, [[v, path] for v in ST.partition_values(spark, path, len(by))],
                rows=metrics.rows) if by else ST.plain(built[name], path, rows=metrics.rows)
        models[name] = built[name]
        found = settled(name, metrics) + key_failures()
    res = BuildResult(run_id=run_id, published=False, tables=paths, failures=found)
    if found:
        return res
    if views:
        entries.update(staging_views(spark, manifest, as_of))
    manifest = ST.commit(spark, root, manifest, run_id, entries)
    res.published = True
    names = catalog_names(manifest.tables)
    ST.sync_catalog(spark, manifest, {k: q for k, q in names.items()
                                      if k in entries or not spark.catalog.tableExists(q)})
    # test again, over what readers now get
    now = {**models, **{k: spark.table(names[k]) for k in entries if k in names}}
    again = [c for c in SUITE.SUITE if c.model in now and (c.kind != "relationships" or c.to in now)]
    res.failures = Q.gate(Q.run_checks(now, again, as_of=as_of)).failures
    required = [t for t in SUITE.REQUIRED_TABLES if tags is None or t in entries or t in stg]
    res.postflight = []
    for t in required:  # counts as the manifest or the gate has them: nothing is read again
        there = spark.catalog.tableExists(names.get(t, t))
        n = counted[t] if t in counted else manifest.tables[t].rows if t in manifest.tables else None
        if there and n is None:
            n = spark.table(names.get(t, t)).count()  # written before counts were kept
        res.postflight.append({"table_name": t, "table_exists": there, "row_count": n if there else None,
                               "status": "missing" if not there else "ok" if n else "empty"})
    missing = [r["table_name"] for r in res.postflight if r["status"] == "missing"]
    if missing:
        raise PostflightError(f"not published: {missing}")
    return res


#: Manifests that ``prune`` leaves in the log.
KEPT_VERSIONS = 10


def prune(spark: SparkSession, root: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Remove run, raw and stream folders that the newest manifest does not name, and all but the
    newest ``keep`` manifests.  Not to be run beside a build or stream, whose folders are not
    named yet."""
    m = ST.load(spark, root)
    ST.drop_versions(spark, root, keep)
    named = {p for t in m.tables.values() for p in ([t.path] if t.path else [b for _, b in t.parts])}
    gone = []
    for top in ("_runs", "_raw", "_epochs"):
        for folder in ST.children(spark, f"{root.rstrip('/')}/{top}"):
            if not any(p.startswith(folder + "/") for p in named):
                ST.remove_folder(spark, folder)
                gone.append(folder)
    return gone


RAW_LAYER = "ledger_raw"


#: Rows that the report of a stopped load names.
REPORTED_ROWS = 20


class RawLoadError(RuntimeError):
    pass


def raw_constraints() -> list:
    """The raw DDL's constraints as checks: primary keys, the orders'
    foreign keys, and VARCHAR lengths."""
    from ..operators.quality import Check
    from ..sources.schemas import VARCHAR_LIMITS
    checks = []
    for table, pk in (("customers", "customer_id"), ("products", "product_id"),
                      ("orders", "order_id")):
        checks += [Check("unique", table, pk), Check("not_null", table, pk)]
    checks += [Check("relationships", "orders", "customer_id", to="customers",
                     field_name="customer_id"),
               Check("relationships", "orders", "product_id", to="products",
                     field_name="product_id")]
    for table, limits in VARCHAR_LIMITS.items():
        checks += [Check("max_length", table, col, max_length=n) for col, n in limits.items()]
    return checks


#: Columns whose frequent values a raw load keeps.
HOT_KEYS = {"orders": ["product_id", "customer_id"]}


def key_statistics(spark: SparkSession, rows: DataFrame, keys: list[str], path: str) -> dict:
    """Writes the rows' key sketch beside them (it merges with others') and returns its frequent keys."""
    SK.key_sketch(rows, keys).write.parquet(path)
    return SK.hot_keys(spark.read.parquet(path))


def load_raw_csv(spark: SparkSession, paths: dict[str, str], root: str,
                 run_id: str | None = None) -> dict[str, str]:
    """Full-refresh load of the three raw tables from CSV, all or nothing.

    Each file is read with its declared schema and FAILFAST and written to
    ``<root>/_raw/<run_id>/<table>``; the written tables must then pass the
    DDL's constraints (keys, foreign keys, lengths).  Only then one manifest
    version names the three new folders; any failure removes them and leaves
    the previous raw tables in place (the rollback).  A field that does not
    fit its type stops the load with the files and rows at fault."""
    from ..sources.files import read_raw_csv, rejected_rows
    run_id = run_id or new_run_id()
    folder = f"{root.rstrip('/')}/_raw/{run_id}"
    if ST.exists(spark, folder):
        raise ValueError(f"raw folder {folder} exists already")
    manifest = ST.load(spark, root)
    written = {t: f"{folder}/{t}" for t in ("customers", "products", "orders")}
    try:
        for table, out in written.items():
            try:
                read_raw_csv(spark, table, paths[table]).write.parquet(out)
            except (SparkRuntimeException, AnalysisException, Py4JJavaError) as e:
                bad = rejected_rows(spark, table, paths[table]).limit(REPORTED_ROWS).collect()
                if not bad:
                    raise
                raise RawLoadError(f"{table}: " + "; ".join(
                    f"{r.file}: {r.row!r} ({', '.join(r.columns) or 'number of fields'})" for r in bad)) from e
        tables = {t: spark.read.parquet(p) for t, p in written.items()}
        verdict = Q.gate(Q.run_checks(tables, raw_constraints()))
        if not verdict.passed:
            raise RawLoadError(f"raw constraints violated: {verdict.failures}")
        hot = {t: key_statistics(spark, tables[t], keys, f"{folder}/{t}_keys") for t, keys in HOT_KEYS.items()}
        manifest = ST.commit(spark, root, manifest, run_id,
                             {f"raw_{t}": ST.plain(df, written[t], hot=hot.get(t)) for t, df in tables.items()})
    except BaseException:
        ST.remove_folder(spark, folder)
        raise
    ST.sync_catalog(spark, manifest, {f"raw_{t}": f"{RAW_LAYER}.{t}" for t in written})
    return written


def build_or_raise(*args, **kwargs) -> BuildResult:
    res = build(*args, **kwargs)
    if not res.published:
        raise QualityGateError(f"{len(res.failures)} checks failed: {res.failures[:5]}")
    return res

