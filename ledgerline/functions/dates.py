"""Date helpers that pin the reference's date semantics onto Spark's.

* day of week is 0 = Sunday ... 6 = Saturday (Spark's ``dayofweek`` is
  1-based);
* ``a - b`` on dates means an integer day count (Spark would give an
  interval);
* month distance on month starts is plain year*12+month arithmetic, also
  when negative.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date_col(value) -> Column:
    """Accept a ``datetime.date``, an ISO string or a Column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def as_ts_col(value) -> Column:
    """Timestamp without time zone (so no session-zone shift)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    # from text, so neither the Python nor the session time zone applies
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def dow0(d: Column) -> Column:
    return F.dayofweek(d) - 1


def days_between(later, earlier: Column) -> Column:
    """Whole days ``later - earlier`` as an int."""
    return F.datediff(as_date_col(later), earlier)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_index(d: Column) -> Column:
    return F.year(d) * 12 + F.month(d)


def months_between_starts(later: Column, earlier: Column) -> Column:
    return month_index(later) - month_index(earlier)
