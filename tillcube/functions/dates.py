"""Calendar column expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d) -> Column:
    """``yyyymmdd`` as an integer."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def weekday_monday0(d) -> Column:
    """Monday = 0 ... Sunday = 6 (not ``dayofweek``, which is Sunday = 1)."""
    return F.weekday(_c(d))


def is_weekend(d) -> Column:
    """F7."""
    return F.weekday(_c(d)) >= 5


def month_name(d) -> Column:
    """full English month name."""
    return F.date_format(_c(d), "MMMM")


def day_name(d) -> Column:
    """full English day name."""
    return F.date_format(_c(d), "EEEE")


def day_spine(start, end) -> Column:
    """one row per day in ``[start, end]`` once exploded."""
    return F.explode(F.sequence(_c(start), _c(end), F.expr("interval 1 day")))


def ntz(value: dt.datetime) -> Column:
    """A timestamp-without-zone literal (the driver tables store NTZ values),
    so comparisons never depend on the session time zone."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
