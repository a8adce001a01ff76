"""Calendar dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import calendar as cal
from pricelake.schemas import DIM_DATE_COLS


def with_attributes(days: DataFrame) -> DataFrame:
    """Calendar attributes of a frame of ``full_date`` values."""
    d = F.col("full_date")
    return days.select(
        d.alias("full_date"),
        cal.date_key(d).alias("date_key"),
        F.year(d).alias("year"),
        cal.quarter_label(d).alias("quarter"),
        F.month(d).alias("month"),
        cal.month_name(d).alias("month_name"),
        cal.weekday_name(d).alias("day_of_week"),
        cal.is_weekend(d).alias("is_weekend"),
        cal.is_market_holiday(d).alias("is_market_holiday"),
    ).select(*DIM_DATE_COLS)


def dim_date(spark: SparkSession, start: dt.date, end: dt.date,
             partitions: int | None = None) -> DataFrame:
    """One row per calendar day from ``start`` to ``end`` with its attributes.

    Built from ``sequence`` + ``explode`` over a one-row frame, then spread
    over ``partitions`` so attribute evaluation is parallel.  Its row count
    is ``days_between(start, end)``, known without reading data, which is the
    size proof used when it is broadcast.
    """
    days = spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end),
                             F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    if partitions:
        days = days.repartition(partitions)
    return with_attributes(days)


def dim_date_span(prices: DataFrame, date_col: str = "trade_date") -> DataFrame:
    """A calendar covering exactly the span of dates present in ``prices``.

    Lazy: the span is a one-row aggregate exploded into days, so the row
    count is bounded by the span (max - min + 1 days), not by the data size.
    """
    span = prices.agg(F.min(F.to_date(date_col)).alias("lo"),
                      F.max(F.to_date(date_col)).alias("hi"))
    days = span.select(F.explode(F.sequence(
        F.col("lo"), F.col("hi"), F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return with_attributes(days)


def dim_date_rows(start: dt.date, end: dt.date) -> int:
    return cal.days_between(start, end)


def market_holidays(dates: DataFrame, col: str = "full_date") -> DataFrame:
    """The holiday flag for any frame of dates."""
    return dates.withColumn("is_market_holiday",
                            cal.is_market_holiday(F.col(col)))
