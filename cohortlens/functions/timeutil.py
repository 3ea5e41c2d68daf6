"""Time helpers on ``timestamp_ntz`` columns (UTC wall clock, exact 24 h days)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_HOUR = 3_600_000_000.0
MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def plus_days(ts, days) -> Column:
    """ts + N x 24 h (never a calendar-month interval); stays ``timestamp_ntz``."""
    return _c(ts) + F.make_dt_interval(F.lit(days) if not isinstance(days, Column) else days)


def minus_days(ts, days) -> Column:
    return _c(ts) - F.make_dt_interval(F.lit(days) if not isinstance(days, Column) else days)


def micros_between(start, end) -> Column:
    """end - start in microseconds, independent of the session time zone."""
    return F.timestamp_diff("MICROSECOND", _c(start), _c(end))


def hours_between(start, end) -> Column:
    return micros_between(start, end) / MICROS_PER_HOUR


def day_index(start, end) -> Column:
    """Whole 24 h periods elapsed from start to end (floor, like ``timedelta.days``)."""
    return F.floor(micros_between(start, end) / F.lit(MICROS_PER_DAY)).cast("bigint")


def week_start(ts) -> Column:
    """Monday of the ISO week containing ts, as DATE."""
    d = F.to_date(_c(ts))
    return F.date_sub(d, F.weekday(d))


def week_label(ts) -> Column:
    """Monday-Sunday period text, e.g. ``2026-03-02/2026-03-08``."""
    monday = week_start(ts)
    return F.concat(F.date_format(monday, "yyyy-MM-dd"), F.lit("/"),
                    F.date_format(F.date_add(monday, 6), "yyyy-MM-dd"))
