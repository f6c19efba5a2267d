"""Date helpers (H7-H13): parts, month ends, semesters, look-back intervals."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_lit(d) -> Column:
    if isinstance(d, (_dt.date, _dt.datetime)):
        d = d.strftime("%Y-%m-%d")
    return F.to_date(F.lit(str(d)[:10]))


def ts_lit(ts) -> Column:
    if isinstance(ts, _dt.datetime):
        ts = ts.strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp_ntz(F.lit(str(ts)))


def eomonth(c) -> Column:
    return F.last_day(as_col(c))


def year_end(d) -> Column:
    """31 December of the year of ``d`` (last_day(make_date(year(d), 12, 1)))."""
    return F.last_day(F.make_date(F.year(as_col(d)), F.lit(12), F.lit(1)))


def semester(c) -> Column:
    return F.when(F.month(as_col(c)) <= 6, F.lit(1)).otherwise(F.lit(2))


def expiry(updated, created, days: int = 50) -> Column:
    """date_add(coalesce(updated, created), days) as a date."""
    return F.date_add(F.to_date(F.coalesce(as_col(updated), as_col(created))), days)


def shift_hours(ts, hours: int) -> Column:
    return as_col(ts) + F.make_interval(hours=F.lit(hours))


def look_back(ts, run_ts, delta_days: int) -> Column:
    """``ts > run_ts + delta_days`` (delta negative: a sliding look-back window)."""
    return as_col(ts) > (ts_lit(run_ts) + F.make_interval(days=F.lit(int(delta_days))))


def format_ntz(c, pattern: str) -> Column:
    """Format a wall-clock (timestamp_ntz) value without passing through the session time zone.

    ``date_format`` converts through the session zone, so in a zone with a daylight-saving gap a
    midnight that does not exist there would print as 01:00. Date-only patterns go through the date;
    'yyyy-MM-dd HH:mm:ss' is the value's own text to the second."""
    c = as_col(c)
    if pattern == "yyyy-MM-dd HH:mm:ss":
        return F.substring(c.cast("timestamp_ntz").cast("string"), 1, 19)
    if not any(ch in pattern for ch in "HhmsSaKk"):
        return F.date_format(F.to_date(c), pattern)
    raise ValueError(f"pattern {pattern!r} needs a time zone; format a timestamp with date_format instead")
