"""Week calendar: week w of year y starts on Jan 1 + 7*(w-1) days.

Not ISO weeks: every (year, week) maps to one date, dates increase strictly,
and ``epi_year``/``epi_week`` invert ``epi_week_start`` exactly.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epi_week_start(year, week) -> Column:
    return F.date_add(F.make_date(_c(year), F.lit(1), F.lit(1)), ((_c(week) - 1) * 7).cast("int"))


def epi_year(d) -> Column:
    return F.year(_c(d))


def epi_week(d) -> Column:
    return (F.floor((F.dayofyear(_c(d)) - 1) / 7) + 1).cast("int")


def week_sin(week, period: int = 52) -> Column:
    return F.sin(F.lit(2 * math.pi) * _c(week).cast("double") / F.lit(float(period)))


def week_cos(week, period: int = 52) -> Column:
    return F.cos(F.lit(2 * math.pi) * _c(week).cast("double") / F.lit(float(period)))


def circular_distance(a, b, period: int = 52) -> Column:
    d = F.abs(_c(a) - _c(b))
    return F.least(d, F.lit(period) - d)


def roll_week(year, week, steps, period: int = 52) -> tuple[Column, Column]:
    """(year, week) advanced by ``steps`` weeks on a 52-week projected calendar
    (a week above 52 is read as 52 first; projected calendars have no week 53)."""
    w0 = F.least(_c(week), F.lit(period)) - 1 + _c(steps)
    return (_c(year) + F.floor(w0 / period)).cast("int"), (F.pmod(w0, F.lit(period)) + 1).cast("int")
