"""Incremental keyed load: delete+insert semantics and idempotence."""

import datetime as dt

from ledgerline.operators.upsert import incremental_load

D = dt.date
SCHEMA = "order_id int, order_date date, status string"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_first_run_loads_everything(spark):
    src = spark.createDataFrame([(1, D(2024, 1, 1), "a"), (2, D(2024, 1, 2), "b")], SCHEMA)
    delta, target = incremental_load(src, None)
    assert _rows(target) == _rows(src) == _rows(delta)


def test_delta_rule_and_replace(spark):
    target = spark.createDataFrame([
        (1, D(2024, 1, 1), "pending"),    # older, changed in source -> kept as is
        (2, D(2024, 1, 5), "pending"),    # last loaded day, changed -> replaced
        (3, D(2024, 1, 3), "completed"),  # deleted from source -> kept
    ], SCHEMA)
    src = spark.createDataFrame([
        (1, D(2024, 1, 1), "completed"),
        (2, D(2024, 1, 5), "completed"),
        (4, D(2023, 12, 1), "new-old"),   # new key with an old date -> loaded
        (5, D(2024, 1, 6), "new"),
    ], SCHEMA)
    delta, new_target = incremental_load(src, target)
    assert _rows(delta) == [(2, D(2024, 1, 5), "completed"), (4, D(2023, 12, 1), "new-old"),
                            (5, D(2024, 1, 6), "new")]
    assert _rows(new_target) == [(1, D(2024, 1, 1), "pending"), (2, D(2024, 1, 5), "completed"),
                                 (3, D(2024, 1, 3), "completed"),
                                 (4, D(2023, 12, 1), "new-old"), (5, D(2024, 1, 6), "new")]
    # rerun with the same source: nothing changes
    _, again = incremental_load(src, new_target)
    assert _rows(again) == _rows(new_target)


def test_empty_target_uses_floor_date(spark):
    target = spark.createDataFrame([], SCHEMA)
    src = spark.createDataFrame([(1, D(1950, 1, 1), "x")], SCHEMA)
    delta, new_target = incremental_load(src, target)
    assert _rows(delta) == _rows(src) == _rows(new_target)


def test_literal_two_step_form_equals_single_pass(spark):
    """select_delta (NOT EXISTS ... OR date >= scalar max) + replace_keys
    (anti-join + union) give the same rows as incremental_load."""
    from conftest import SF_SMALL
    from ledgerline.operators import marts as M
    from ledgerline.operators import staging as S
    from ledgerline.operators.upsert import replace_keys, select_delta
    from ledgerline.sources import testbind as TB
    raw = TB.load_raw(spark, SF_SMALL)
    p = S.stg_products(raw.products, TB.AS_OF)
    c = S.stg_customers(raw.customers, TB.AS_OF)
    first = M.fct_orders_rows(S.stg_orders(TB.orders_first_load(raw.orders)), p, c,
                              TB.LOAD_RUNS[0])
    second = M.fct_orders_rows(S.stg_orders(TB.orders_second_load(raw.orders)), p, c,
                               TB.LOAD_RUNS[1])
    delta, new = incremental_load(second, first)
    lit_delta = select_delta(second, first)
    lit_new = replace_keys(first, lit_delta)
    assert sorted(map(tuple, lit_delta.collect()), key=repr) == \
        sorted(map(tuple, delta.collect()), key=repr)
    assert sorted(map(tuple, lit_new.collect()), key=repr) == \
        sorted(map(tuple, new.collect()), key=repr)
    assert delta.count() > 0


def test_lookback_days_reloads_recent_changes(spark):
    target = spark.createDataFrame([(1, D(2024, 1, 3), "pending"), (2, D(2024, 1, 5), "pending"),
                                    (3, D(2023, 12, 1), "pending")], SCHEMA)
    src = spark.createDataFrame([(1, D(2024, 1, 3), "completed"), (2, D(2024, 1, 5), "completed"),
                                 (3, D(2023, 12, 1), "completed")], SCHEMA)
    _, plain = incremental_load(src, target)
    _, wide = incremental_load(src, target, lookback_days=3)
    assert _rows(plain) == [(1, D(2024, 1, 3), "pending"), (2, D(2024, 1, 5), "completed"),
                            (3, D(2023, 12, 1), "pending")]
    assert _rows(wide) == [(1, D(2024, 1, 3), "completed"), (2, D(2024, 1, 5), "completed"),
                           (3, D(2023, 12, 1), "pending")]
