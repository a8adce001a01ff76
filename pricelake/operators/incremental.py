"""Incremental load of the raw layer, by high-water mark or by ledger.

The mark is ``MAX(trade_date)`` of the cleaned layer.  ``mark_value`` fetches
it as one scalar (like the reference) so the load filter becomes a literal
that Parquet min/max statistics can skip row groups with; ``incremental_load``
also accepts a column (scalar subquery) to stay fully lazy.

A mark loses rows that arrive late, dated before it.  ``ledger_load`` goes by
what was loaded instead: the ingest partitions that no earlier load has read, as
a partition filter, of whose rows those with a new key are kept (``new_keys``).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake.functions.text import clean_ticker


def high_water_mark(silver: DataFrame) -> DataFrame:
    """One row: the newest trade date already cleaned (null when empty)."""
    return silver.agg(F.max("trade_date").alias("high_water_mark"))


def mark_value(silver: DataFrame | None) -> dt.date | None:
    """The mark as a Python date; ``None`` for a missing or empty layer."""
    if silver is None:
        return None
    row = high_water_mark(silver).first()
    return None if row is None else row["high_water_mark"]


def incremental_load(bronze: DataFrame, mark: dt.date | Column | None,
                     date_col: str = "Date") -> DataFrame:
    """Raw rows strictly newer than the mark; all rows when there is none."""
    if mark is None:
        return bronze
    if isinstance(mark, Column):
        return bronze.where(mark.isNull() | (F.to_date(date_col) > mark))
    # A date literal: Spark unwraps the cast into a range filter on the raw
    # timestamp column, which reaches the Parquet scan.
    return bronze.where(F.to_date(date_col) > F.lit(mark))


def incremental_load_per_ticker(bronze: DataFrame, silver: DataFrame,
                                date_col: str = "Date") -> DataFrame:
    """Per-instrument marks: a ticker that missed a day is not skipped for good.

    The marks are one row per cleaned ticker (a grouped max).  Raw tickers may
    carry blanks or lower case, so they are cleaned for the join; else their
    whole history would come in again on every run.
    """
    marks = silver.groupBy(F.col("ticker_symbol").alias("__ticker")).agg(
        F.max("trade_date").alias("__mark"))
    j = bronze.join(marks, clean_ticker("ticker_symbol") == F.col("__ticker"),
                    "left")
    return j.where(F.col("__mark").isNull()
                   | (F.to_date(date_col) > F.col("__mark"))) \
        .drop("__ticker", "__mark")


def unloaded(present: dict[str, tuple], ledger: dict[str, set]) -> list[str]:
    """Ingest dates whose partition no load has read in its present form."""
    return sorted(d for d, form in present.items()
                  if form not in ledger.get(d, ()))


def ledger_load(bronze: DataFrame, dates: list[str]) -> DataFrame:
    """Raw rows of some ingest dates: only their partitions are read."""
    return bronze.where(F.col("ingested_date").isin(dates))


def new_keys(cleaned: DataFrame, raw: DataFrame, silver: DataFrame,
             keys: list[str], date_col: str = "Date") -> DataFrame:
    """Cleaned rows whose key the cleaned layer does not hold yet.  The layer
    is read only within the date range of the ``raw`` rows (scalar subqueries
    over one raw column; the cleaning itself is not repeated)."""
    day = F.to_date(date_col)
    known = silver.where(F.col("trade_date").between(
        raw.agg(F.min(day)).scalar(), raw.agg(F.max(day)).scalar()))
    return cleaned.join(known.select(*keys), keys, "left_anti")


def has_rows(df: DataFrame) -> bool:
    """The no-op gate: false when there is nothing new (reads one row)."""
    return not df.isEmpty()
