"""Data-quality checks with "violating rows" semantics (zero = pass).

Row-level checks (not_null, accepted_values, accepted_range,
expression_is_true) of one table are folded into a single aggregate pass
(one ``count_if`` per check), so a table is scanned once however many
checks it has.  ``unique`` needs one shuffle per column, ``relationships``
one anti-join.  The result is a small table (one row per check) that the
build gate may collect.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

RESULT_SCHEMA = T.StructType([
    T.StructField("test", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("rule", T.StringType()),
    T.StructField("failures", T.LongType()),
])


@dataclass(frozen=True)
class Check:
    kind: str
    model: str
    column: str
    values: tuple = ()
    to: str | None = None
    field_name: str | None = None
    min_value: object = None
    max_value: object = None
    inclusive: bool = True
    max_length: int | None = None
    expression: str | None = None
    severity: str = "error"

    @property
    def rule(self) -> str:
        if self.kind == "accepted_values":
            return "in (" + ", ".join(map(str, self.values)) + ")"
        if self.kind == "relationships":
            return f"{self.to}.{self.field_name}"
        if self.kind == "accepted_range":
            lo = "" if self.min_value is None else f">= {self.min_value}"
            hi = "" if self.max_value is None else f"<= {self.max_value}"
            return " and ".join(x for x in (lo, hi) if x)
        if self.kind == "expression_is_true":
            return self.expression or ""
        if self.kind == "max_length":
            return f"length <= {self.max_length}"
        return ""

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.model}.{self.column}" + (f" {self.rule}" if self.rule else "")


def _lit_sql(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    if isinstance(v, _dt.date):
        return f"DATE '{v.isoformat()}'"
    return str(v)


def violation(check: Check, as_of: _dt.date | None = None) -> Column:
    """Row-level violation predicate (NULL-safe: a NULL verdict passes)."""
    c = F.col(check.column)
    if check.kind == "not_null":
        return c.isNull()
    if check.kind == "accepted_values":
        return c.isNotNull() & ~c.isin(list(check.values))
    if check.kind == "accepted_range":
        ok = F.lit(True)
        if check.min_value is not None:
            ok = ok & ((c >= check.min_value) if check.inclusive else (c > check.min_value))
        if check.max_value is not None:
            ok = ok & ((c <= check.max_value) if check.inclusive else (c < check.max_value))
        return F.coalesce(~ok, F.lit(False))
    if check.kind == "expression_is_true":
        expr = check.expression or ""
        if as_of is not None:
            expr = expr.replace("CURRENT_DATE", _lit_sql(as_of))
        return F.coalesce(~F.expr(f"`{check.column}` {expr}"), F.lit(False))
    if check.kind == "max_length":
        return F.coalesce(F.length(c) > check.max_length, F.lit(False))
    raise ValueError(f"not a row-level check: {check.kind}")


ROW_LEVEL = {"not_null", "accepted_range", "expression_is_true", "max_length"}


def _result_row(check: Check, failures: Column) -> list[Column]:
    return [F.lit(check.kind).alias("test"), F.lit(check.model).alias("model"),
            F.lit(check.column).alias("column_name"), F.lit(check.rule).alias("rule"),
            failures.cast("long").alias("failures")]


def failure_count(check: Check, as_of=None) -> Column:
    """Aggregate giving a row-level check's failure count: one per row."""
    return F.count_if(violation(check, as_of))


def row_level_results(df: DataFrame, checks: list[Check], as_of=None) -> DataFrame:
    """All row-level checks of one table in one aggregate pass, unpivoted."""
    aggs = [failure_count(ch, as_of).alias(f"c{i}") for i, ch in enumerate(checks)]
    counts = df.agg(*aggs)
    rows = F.array(*[F.struct(*_result_row(ch, F.col(f"c{i}"))) for i, ch in enumerate(checks)])
    return counts.select(F.explode(rows).alias("r")).select("r.*")


#: Checks that metrics of a table's rows decide, without another look at them.
METRIC_LEVEL = ROW_LEVEL | {"accepted_values"}


def metric_columns(checks: list[Check], as_of=None) -> list[Column]:
    """Row count and, per check, the rows that violate it: aggregates for one pass over a table,
    its write included (``DataFrame.observe``)."""
    return [F.count(F.lit(1)).alias("rows"),
            *[failure_count(ch, as_of).alias(f"c{i}") for i, ch in enumerate(checks)]]


@dataclass
class Metrics:
    """What one pass over a table found: its rows, the failures that are settled, and the checks
    that need a second look (invalid values are counted once each, so they are looked up only
    where there are any)."""
    rows: int
    failures: list
    open: list


def settle(checks: list[Check], values: dict) -> Metrics:
    out = Metrics(values["rows"], [], [])
    for i, ch in enumerate(checks):
        if values[f"c{i}"] and ch.kind == "accepted_values":
            out.open.append(ch)
        elif values[f"c{i}"]:
            out.failures.append({"test": ch.kind, "model": ch.model, "column_name": ch.column, "rule": ch.rule,
                                 "failures": values[f"c{i}"]})
    return out


def observed(df: DataFrame, checks: list[Check], as_of=None) -> tuple[DataFrame, Observation]:
    """The frame with its metrics observed by whatever action runs it."""
    seen = Observation()
    return df.observe(seen, *metric_columns(checks, as_of)), seen


def profile(df: DataFrame, checks: list[Check], as_of=None) -> Metrics:
    """The metrics of a table that is not written: one aggregate."""
    return settle(checks, df.agg(*metric_columns(checks, as_of)).first().asDict())


def unique_result(df: DataFrame, check: Check) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    c = F.col(check.column)
    dups = (df.where(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > 1))
    return dups.agg(*_result_row(check, F.count(F.lit(1))))


def accepted_values_result(df: DataFrame, check: Check, as_of=None) -> DataFrame:
    """One failure per distinct invalid value: a grouped count of the
    column's values, of which there are few after partial aggregation."""
    values = df.where(violation(check, as_of)).groupBy(check.column).agg(F.count(F.lit(1)).alias("_n"))
    return values.agg(*_result_row(check, F.count(F.col(check.column))))


def relationships_result(child: DataFrame, parent: DataFrame, check: Check) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    Child keys are counted first (partial aggregation map-side), so a key
    holding a third of the child rows reaches the anti-join as one row.
    """
    c = F.col(check.column)
    keys = (child.where(c.isNotNull()).groupBy(c.alias("_k"))
            .agg(F.count(F.lit(1)).alias("_n")))
    orphans = keys.join(parent.select(F.col(check.field_name).alias("_k")), "_k", "left_anti")
    return orphans.agg(*_result_row(check, F.coalesce(F.sum("_n"), F.lit(0))))


def run_checks(models: dict[str, DataFrame], checks: list[Check], as_of=None,
               kinds: set[str] | None = None) -> DataFrame:
    """Evaluate ``checks`` (optionally only some kinds) over ``models``."""
    selected = [c for c in checks if kinds is None or c.kind in kinds]
    parts: list[DataFrame] = []
    by_model: dict[str, list[Check]] = {}
    for ch in selected:
        if ch.kind in ROW_LEVEL:
            by_model.setdefault(ch.model, []).append(ch)
        elif ch.kind == "unique":
            parts.append(unique_result(models[ch.model], ch))
        elif ch.kind == "accepted_values":
            parts.append(accepted_values_result(models[ch.model], ch, as_of))
        elif ch.kind == "relationships":
            parts.append(relationships_result(models[ch.model], models[ch.to], ch))
        else:
            raise ValueError(ch.kind)
    for model, chs in by_model.items():
        parts.append(row_level_results(models[model], chs, as_of))
    if not parts:
        raise ValueError("no checks selected")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def singular(df: DataFrame, condition: Column, name: str, model: str,
             columns: list[str]) -> DataFrame:
    """A custom assertion: the rows matching ``condition`` are violations."""
    return df.where(F.coalesce(condition, F.lit(False))).select(*columns)


def singular_result(df: DataFrame, condition_sql: str, model: str, column: str) -> DataFrame:
    """A custom assertion as one result row (failures = violating rows)."""
    bad = F.coalesce(F.expr(condition_sql), F.lit(False))
    return df.agg(F.lit("singular").alias("test"), F.lit(model).alias("model"),
                  F.lit(column).alias("column_name"), F.lit(condition_sql).alias("rule"),
                  F.count_if(bad).cast("long").alias("failures"))


@dataclass
class Freshness:
    warn_after_hours: float = 24
    error_after_hours: float = 48


def source_freshness(df: DataFrame, ts_col: str, run_ts, rule: Freshness = Freshness(),
                     by: list[str] | None = None) -> DataFrame:
    """Latest load time vs the run time -> pass / warn / error."""
    from ..functions.dates import as_ts_col
    run = as_ts_col(run_ts)
    g = df.groupBy(*(by or [])).agg(F.max(ts_col).alias("max_loaded_at"))
    age_us = F.timestamp_diff("MICROSECOND", F.col("max_loaded_at"), run)
    age_h = age_us.cast("double") / F.lit(3.6e9)
    status = (F.when(F.col("max_loaded_at").isNull(), "error")
              .when(age_h > rule.error_after_hours, "error")
              .when(age_h > rule.warn_after_hours, "warn").otherwise("pass"))
    return g.select(*(by or []), "max_loaded_at", age_us.alias("age_microseconds"),
                    age_h.alias("age_hours"), status.alias("status"))


@dataclass
class GateResult:
    passed: bool
    failures: list = field(default_factory=list)


def gate(results: DataFrame) -> GateResult:
    """Collect the (small, one row per check) results; errors fail."""
    bad = [r.asDict() for r in results.where(F.col("failures") > 0).collect()]
    return GateResult(passed=not bad, failures=bad)
