"""Calendar expressions (all built-in, whole-stage-codegen friendly)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: Column | str) -> Column:
    """YYYYMMDD as an int."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def week_of_year_monday(d: Column | str) -> Column:
    """Monday-start week number, days before the first Monday are week 1
    (``strftime('%W') + 1``); not the ISO week."""
    d = _col(d)
    return (F.floor((F.dayofyear(d) + 6 - F.weekday(d)) / 7) + 1).cast("int")


def day_of_week_sunday0(d: Column | str) -> Column:
    """0 = Sunday ... 6 = Saturday (``strftime('%w')``)."""
    return (F.dayofweek(_col(d)) - 1).cast("int")


def month_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "MMMM")


def day_name(d: Column | str) -> Column:
    return F.date_format(_col(d), "EEEE")


def hour_text(ts: Column | str) -> Column:
    """Two-digit hour of a timestamp, as ``strftime('%H')``."""
    return F.date_format(_col(ts), "HH")


def days_before(as_of, n: int) -> Column:
    """``DATE(as_of, '-n days')``: the calendar date n days before the as-of date."""
    return F.date_sub(F.to_date(as_of_col(as_of)), n)


def as_of_col(as_of) -> Column:
    """An ``as_of`` argument as a TIMESTAMP_NTZ column (UTC wall clock).

    Accepts a datetime, a date, an ISO string, a Column, or None (current time in UTC).
    """
    if as_of is None:
        # session-zone wall clock -> UTC wall clock
        return F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    if isinstance(as_of, Column):
        return as_of.cast("timestamp_ntz")
    # literals are built from ISO text: a Python datetime literal would pass through the
    # session time zone and shift "now" by its offset
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        return F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(as_of, _dt.date):
        return F.lit(f"{as_of.isoformat()} 00:00:00").cast("timestamp_ntz")
    return F.lit(str(as_of)).cast("timestamp_ntz")


def to_utc_ntz(ts: Column, session_tz: str) -> Column:
    """Instant (TIMESTAMP) -> UTC wall clock (TIMESTAMP_NTZ), whatever the session zone."""
    return F.convert_timezone(F.lit(session_tz), F.lit("UTC"), ts.cast("timestamp_ntz"))


def utc_instant(ntz: Column, session_tz: str) -> Column:
    """UTC wall clock (TIMESTAMP_NTZ) -> the instant (TIMESTAMP), whatever the session zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(session_tz), ntz).cast("timestamp")
