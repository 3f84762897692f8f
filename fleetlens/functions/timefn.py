"""Date / time scalars (P25-P31). The session time zone is UTC (``ensure_session``)."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.functions.text import py_strip

UTC_TEXT = "yyyy-MM-dd HH:mm:ss 'UTC'"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_utc(c) -> Column:
    """P25: ``YYYY-MM-DD HH:MM:SS UTC`` text -> timestamp, null when it does not match exactly."""
    t = py_strip(_c(c))
    ok = t.rlike(r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2} UTC$")
    return F.when(ok, F.try_to_timestamp(t, F.lit(UTC_TEXT)))


def fmt_utc(c) -> Column:
    """Timestamp -> ``YYYY-MM-DD HH:MM:SS UTC`` (second precision, like the reference text)."""
    return F.date_format(_c(c), UTC_TEXT)


def stamp(c) -> Column:
    """File-name stamp ``YYYY-MM-DD_HH-MM-SS``."""
    return F.date_format(_c(c), "yyyy-MM-dd_HH-mm-ss")


def slot_key(c) -> Column:
    """Minute slot as text."""
    return F.date_format(F.date_trunc("minute", _c(c)), "yyyy-MM-dd HH:mm")


def weekday_mon0(c) -> Column:
    """Monday=0 .. Sunday=6."""
    return F.weekday(_c(c))


def age_seconds(as_of, ts, floor_zero: bool = True) -> Column:
    """``as_of - ts`` in whole seconds, floored at 0 when asked."""
    d = F.unix_timestamp(_c(as_of)) - F.unix_timestamp(_c(ts))
    return F.greatest(d, F.lit(0)) if floor_zero else d


def uptime_days(days, hours, minutes) -> Column:
    """Days + h/24 + m/1440."""
    return (F.coalesce(_c(days), F.lit(0)).cast("double") + _c(hours) / F.lit(24.0) + _c(minutes) / F.lit(1440.0))


def as_of_lit(as_of: str | datetime) -> Column:
    """An explicit "now": literal timestamp (never ``current_timestamp()``)."""
    if isinstance(as_of, datetime):
        as_of = as_of.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    return F.to_timestamp(F.lit(str(as_of).replace(" UTC", "")))


def window_bounds(as_of: str, days: int = 7) -> tuple[Column, Column]:
    """``[as_of - days, as_of]`` (both inclusive); non-positive days -> 7."""
    days = days if days and days > 0 else 7
    end = as_of_lit(as_of)
    return end - F.make_dt_interval(F.lit(days)), end


def in_window(c, as_of: str, days: int = 7) -> Column:
    """Second-precision inclusive window test, like the reference's text comparison."""
    lo, hi = window_bounds(as_of, days)
    t = F.date_trunc("second", _c(c))
    return (t >= lo) & (t <= hi)
