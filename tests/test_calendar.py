"""Calendar dimension and holiday rules (FIXTURES 3.4)."""

import datetime as dt

from pyspark.sql import functions as F

from pricelake.operators.calendar import dim_date
from pricelake.functions.calendar import easter_sunday

D = dt.date


def test_reference_calendar_rows(spark):
    cal = dim_date(spark, D(2025, 3, 9), D(2035, 12, 31))
    assert cal.count() == 3950
    first = cal.where(F.col("full_date") == D(2025, 3, 10)).first()
    assert first.date_key == 20250310
    assert (first.year, first.quarter, first.month) == (2025, "Q1", 3)
    assert (first.month_name, first.day_of_week) == ("March", "Monday")
    assert first.is_weekend is False
    sunday = cal.where(F.col("full_date") == D(2025, 3, 9)).first()
    assert sunday.is_weekend is True and sunday.is_market_holiday is False


def test_holidays(spark):
    cal = dim_date(spark, D(1995, 1, 1), D(2035, 12, 31))
    hol = {r.full_date for r in cal.where("is_market_holiday").collect()}
    for d in [D(2025, 4, 18), D(2025, 6, 19), D(2025, 7, 4), D(2025, 11, 27),
              D(2025, 12, 25), D(2026, 7, 3), D(2027, 12, 24),
              D(2001, 9, 11), D(2001, 9, 14)]:
        assert d in hol, d
    for d in [D(2025, 3, 9), D(2027, 12, 31), D(2021, 6, 18)]:
        assert d not in hol, d
    # every holiday falls on a weekday
    assert all(d.weekday() < 5 for d in hol)
    # rule set without the one-off closures: 374 dates in 1995-2035
    one_off = {D(2001, 9, 11), D(2001, 9, 12), D(2001, 9, 13), D(2001, 9, 14),
               D(2004, 6, 11), D(2007, 1, 2), D(2012, 10, 29),
               D(2012, 10, 30), D(2018, 12, 5), D(2025, 1, 9)}
    assert len(hol - one_off) == 374


def test_easter(spark):
    known = {2000: D(2000, 4, 23), 2008: D(2008, 3, 23), 2019: D(2019, 4, 21),
             2025: D(2025, 4, 20), 2038: D(2038, 4, 25)}
    df = spark.createDataFrame([(y,) for y in known], "y int")
    got = {r.y: r.e for r in df.select("y", easter_sunday(F.col("y")).alias("e"))
           .collect()}
    assert got == known
