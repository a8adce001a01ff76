"""Calendar expressions: date attributes and the exchange-holiday rule set.

Every rule is a predicate on the date itself (year, month, day, weekday),
so the holiday flag is a plain column expression evaluated in codegen; no
per-year holiday list is generated or shipped.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# One-off full-day exchange closures (public exchange history).
ONE_OFF_CLOSURES = [
    dt.date(2001, 9, 11), dt.date(2001, 9, 12), dt.date(2001, 9, 13),
    dt.date(2001, 9, 14), dt.date(2004, 6, 11), dt.date(2007, 1, 2),
    dt.date(2012, 10, 29), dt.date(2012, 10, 30), dt.date(2018, 12, 5),
    dt.date(2025, 1, 9),
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def date_key(d) -> Column:
    """YYYYMMDD as an int."""
    return F.date_format(_c(d), "yyyyMMdd").cast("int")


def quarter_label(d) -> Column:
    return F.concat(F.lit("Q"), F.quarter(_c(d)).cast("string"))


def month_name(d) -> Column:
    return F.date_format(_c(d), "MMMM")


def weekday_name(d) -> Column:
    return F.date_format(_c(d), "EEEE")


def weekday0(d) -> Column:
    """Monday = 0 ... Sunday = 6."""
    return F.weekday(_c(d))


def is_weekend(d) -> Column:
    return weekday0(d) >= 5


def easter_sunday(year) -> Column:
    """Gregorian Easter Sunday of ``year`` by integer arithmetic."""
    y = _c(year).cast("int")

    def div(a, b):  # operands are non-negative here, so floor = truncation
        return F.floor(a / F.lit(b)).cast("int")

    a = y % 19
    b = div(y, 100)
    c = y % 100
    d = div(b, 4)
    e = b % 4
    f = div(b + 8, 25)
    g = div(b - f + 1, 3)
    h = (a * 19 + b - d - g + 15) % 30
    i = div(c, 4)
    k = c % 4
    l_ = (F.lit(32) + e * 2 + i * 2 - h - k) % 7
    m = div(a + h * 11 + l_ * 22, 451)
    n = h + l_ - m * 7 + 114
    month = div(n, 31)
    day = n % 31 + 1
    return F.make_date(y, month, day)


def _observed(d: Column, month: int, day: int) -> Column:
    """Fixed-date holiday moved to Friday when on Saturday, Monday when on Sunday."""
    y = F.year(d)
    base = F.make_date(y, F.lit(month), F.lit(day))
    wd = weekday0(base)
    observed = (F.when(wd == 5, F.date_sub(base, 1))
                .when(wd == 6, F.date_add(base, 1))
                .otherwise(base))
    return d == observed


def _nth_weekday(d: Column, month: int, weekday: int, first_day: int) -> Column:
    """``weekday`` (Monday = 0) falling in the 7-day span starting ``first_day``."""
    dom = F.dayofmonth(d)
    return ((F.month(d) == month) & (weekday0(d) == weekday)
            & (dom >= first_day) & (dom <= first_day + 6))


def is_market_holiday(d) -> Column:
    """Full-day exchange closure rule set (supported years: 1995 on)."""
    d = _c(d)
    y = F.year(d)
    m = F.month(d)
    dom = F.dayofmonth(d)
    wd = weekday0(d)
    new_year = (((m == 1) & (dom == 1) & (wd <= 4))
                | ((m == 1) & (dom == 2) & (wd == 0)))
    mlk = _nth_weekday(d, 1, 0, 15) & (y >= 1998)
    presidents = _nth_weekday(d, 2, 0, 15)
    good_friday = d == F.date_sub(easter_sunday(y), 2)
    memorial = _nth_weekday(d, 5, 0, 25)
    juneteenth = _observed(d, 6, 19) & (y >= 2022)
    independence = _observed(d, 7, 4)
    labor = _nth_weekday(d, 9, 0, 1)
    thanksgiving = _nth_weekday(d, 11, 3, 22)
    christmas = _observed(d, 12, 25)
    one_off = d.isin([F.lit(x) for x in ONE_OFF_CLOSURES])
    return (new_year | mlk | presidents | good_friday | memorial | juneteenth
            | independence | labor | thanksgiving | christmas | one_off)


def days_between(start: dt.date, end: dt.date) -> int:
    """Row count of a daily calendar from ``start`` to ``end`` inclusive."""
    return max((end - start).days + 1, 0)
