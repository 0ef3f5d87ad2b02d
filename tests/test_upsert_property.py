"""Property test: incremental_load equals a plain model of delete+insert."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerline.operators.upsert import EMPTY_TARGET_DATE, incremental_load

SCHEMA = "order_id int, order_date date, v int"
row = st.tuples(st.one_of(st.none(), st.integers(0, 6)),
                st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 1, 8))),
                st.integers(0, 3))


def model(target, source):
    dates = [d for _, d, _ in target if d is not None]
    cutoff = max(dates) if dates else EMPTY_TARGET_DATE
    keys = {k for k, _, _ in target if k is not None}
    delta = [r for r in source
             if (r[0] is None or r[0] not in keys) or (r[1] is not None and r[1] >= cutoff)]
    gone = {k for k, _, _ in delta if k is not None}
    kept = [r for r in target if r[0] is None or r[0] not in gone]
    return sorted(delta, key=repr), sorted(kept + delta, key=repr)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, max_size=8), st.lists(row, max_size=8))
def test_matches_model(spark, target, source):
    t = spark.createDataFrame(target, SCHEMA)
    s = spark.createDataFrame(source, SCHEMA)
    delta, new = incremental_load(s, t)
    exp_delta, exp_new = model(target, source)
    assert sorted(map(tuple, delta.collect()), key=repr) == exp_delta
    assert sorted(map(tuple, new.collect()), key=repr) == exp_new
