"""Driver contract: entry(), queries(), oracle_sql() agree with DuckDB."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

from scripts.check_oracle import TABLES, rows_of


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "rolling_7day_avg_revenue" in df.columns


# the training-data operators have tests of their own
TRAINING_DATA = re.compile(r"op\d+_|pipeline$")

PLANNED = """raw_customers raw_products raw_orders seed_regions_lookup stg_customers
stg_orders stg_products date_parts null_semantics flat_discount fct_daily_sales
fct_orders_incremental_full incremental_delta incremental_upsert rfm_metrics rfm_scores
rfm_segments dim_customers cohort_size customer_cohorts daily_sales_summary weekly_change
rolling_avg completed_orders_rollup scd2_timestamp scd2_check dq_unique dq_not_null
dq_accepted_values dq_relationships dq_accepted_range dq_expression dq_singular
source_freshness preflight_counts postflight_row_counts gen_orders_profile""".split()


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(PLANNED) <= set(E.queries())
    # every query of the library itself has an oracle
    assert {n for n in E.queries() if not TRAINING_DATA.match(n)} <= set(E.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(n for n in E.oracle_sql() if not TRAINING_DATA.match(n)))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert rows_of(sdf.columns, srows) == rows_of(rel.columns, rel.fetchall())
