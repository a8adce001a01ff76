"""Price fact: surrogate keys, daily return, portfolio value, price key.

Plan shape (see ``.explain``): the cleaned prices are joined to the current
dimension rows, the calendar and the baseline values -- broadcast hash joins
while Spark finds those sides below its size limit, so the price rows are not
shuffled for them.  One
exchange on ``stock_key`` feeds both ``lag`` and ``first`` (same window
spec, one sort).  The price key is numbered by ``sequential_ids`` over
(trade date, stock key) instead of a global ``ROW_NUMBER``; in the stored form
by ``laid_out_ids``, whose exchange and sort are those of the written files.

Window size bound: after de-duplication a stock has at most one row per
calendar day, so one ``stock_key`` partition holds at most
``days_between(calendar_start, calendar_end)`` rows whatever the skew in
the raw data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions.numeric import round_half_away
from pricelake.operators.calendar import dim_date_rows
from pricelake.operators.joins import broadcast_known
from pricelake.operators.numbering import (laid_out_ids, layout_offsets,
                                           sequential_ids)
from pricelake.operators.scd2 import current_versions
from pricelake.params import RunParams
from pricelake.schemas import FACT_COLS


def by_stock():
    return Window.partitionBy("stock_key").orderBy("trade_date")


def surrogate_stock(prices: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """Ticker -> ``stock_key`` of the current dimension version (inner)."""
    cur = current_versions(dim_stock).select("ticker_symbol", "stock_key")
    return prices.join(cur, "ticker_symbol")


def surrogate_date(prices: DataFrame, dim_date: DataFrame,
                   known_rows: int | None = None) -> DataFrame:
    """``CAST(trade_date AS DATE) = full_date`` -> ``date_key`` (inner)."""
    cal = dim_date.select("full_date", "date_key")
    cal = broadcast_known(cal, known_rows)
    return prices.join(cal, F.to_date(F.col("trade_date")) == F.col("full_date")
                       ).drop("full_date")


def baseline_join(prices: DataFrame, holdings: DataFrame) -> DataFrame:
    base = holdings.select("ticker_symbol", "baseline_value_usd")
    return prices.join(base, "ticker_symbol")


def previous_close(close: str = "close_price") -> F.Column:
    return F.lag(F.col(close), 1).over(by_stock())


def first_close(close: str = "close_price") -> F.Column:
    """The running frame gives the same first value as the reference's full
    frame and lets Spark evaluate it in the same streaming pass as ``lag``."""
    return F.first(F.col(close)).over(
        by_stock().rowsBetween(Window.unboundedPreceding, Window.currentRow))


def return_from(close, prev) -> F.Column:
    """ROUND((p - prev) / NULLIF(prev, 0) * 100, 4)."""
    close = F.col(close) if isinstance(close, str) else close
    prev = F.col(prev) if isinstance(prev, str) else prev
    change = F.try_divide(close - prev, F.nullif(prev, F.lit(0.0)))
    return round_half_away(change * F.lit(100.0), 4)


def value_from(close, first, baseline) -> F.Column:
    """ROUND(baseline * p / NULLIF(first, 0), 2)."""
    close = F.col(close) if isinstance(close, str) else close
    first = F.col(first) if isinstance(first, str) else first
    baseline = F.col(baseline) if isinstance(baseline, str) else baseline
    ratio = F.try_divide(close, F.nullif(first, F.lit(0.0)))
    return round_half_away(baseline * ratio, 2)


def daily_return(close: str = "close_price") -> F.Column:
    """ROUND((p - LAG(p)) / NULLIF(LAG(p), 0) * 100, 4) per stock by date."""
    return return_from(close, previous_close(close))


def portfolio_value(close: str = "close_price",
                    baseline: str = "baseline_value_usd") -> F.Column:
    """ROUND(baseline * p / FIRST_VALUE(p), 2) per stock by date."""
    return value_from(close, first_close(close), baseline)


def with_measures(keyed: DataFrame, carried: bool = False) -> DataFrame:
    """Daily return and portfolio value with each window function computed
    once (one exchange on stock_key, one sort, two window functions).

    ``carried``: the rows continue a fact whose last and first close per stock
    come with them (``last_close``, ``opening_close``; null for a stock without
    prices so far).
    """
    prev, first = previous_close(), first_close()
    if carried:
        prev = F.coalesce(prev, F.col("last_close"))
        first = F.coalesce(F.col("opening_close"), first)
    w = keyed.select("*", prev.alias("__prev"), first.alias("__first"))
    return w.select(
        "date_key", "stock_key", "trade_date", "close_price",
        return_from("close_price", "__prev").alias("daily_return_pct"),
        value_from("close_price", "__first", "baseline_value_usd")
        .alias("portfolio_value"),
        "ingested_at", "processed_at")


def price_key(df: DataFrame) -> DataFrame:
    """Dense key in (trade date, stock key) order, numbered in parallel."""
    return sequential_ids(df, F.col("date_key"), F.col("stock_key"),
                          "price_key")


def keyed_prices(silver: DataFrame, dim_stock: DataFrame, dim_date: DataFrame,
                 holdings: DataFrame, params: RunParams) -> DataFrame:
    """Cleaned prices with both surrogate keys and the baseline value."""
    s = silver.select("trade_date", "ticker_symbol", "close_price",
                      "ingested_at", "processed_at")
    s = surrogate_stock(s, dim_stock)
    s = surrogate_date(s, dim_date,
                       dim_date_rows(params.calendar_start, params.calendar_end))
    return baseline_join(s, holdings)


def fact_prices(silver: DataFrame, dim_stock: DataFrame, dim_date: DataFrame,
                holdings: DataFrame, params: RunParams,
                stored_form: bool = False) -> DataFrame:
    """The whole price fact (8 columns), unordered; or in its ``stored_form``."""
    keyed = keyed_prices(silver, dim_stock, dim_date, holdings, params)
    rows = with_measures(keyed)
    return stored_fact(rows) if stored_form else _fact_columns(price_key(rows))


def with_month(measured: DataFrame) -> DataFrame:
    return measured.withColumn("month_key", F.floor(F.col("date_key") / 100)
                               .cast("int"))


def stored_fact(measured: DataFrame, last_key: int = 0,
                offsets: DataFrame | None = None) -> DataFrame:
    """The stored form of the fact: numbered after ``last_key``, with a month
    partition column, rows clustered by (date_key, stock_key) within it.  With the
    ``fact_offsets`` of a whole fact, ``measured`` may be some months of it."""
    return _fact_columns(laid_out_ids(
        with_month(measured), "month_key", F.col("date_key"), F.col("stock_key"),
        "price_key", start=last_key, offsets=offsets), "month_key")


def fact_offsets(measured: DataFrame) -> DataFrame:
    return layout_offsets(with_month(measured), "month_key", F.col("date_key"),
                          F.col("stock_key"))


def _fact_columns(fact: DataFrame, *more: str) -> DataFrame:
    return fact.select(
        F.col("price_key").cast("long").alias("price_key"),
        F.col("date_key").cast("int").alias("date_key"),
        F.col("stock_key").cast("int").alias("stock_key"),
        *FACT_COLS[3:], *more)


# -- incremental refresh ---------------------------------------------------------

def carry_basis(dim_stock: DataFrame, holdings: DataFrame) -> DataFrame:
    """What a fact row takes from its instrument: one row per current version
    with a baseline value."""
    cur = current_versions(dim_stock).select("ticker_symbol", "stock_key")
    return cur.join(holdings.select("ticker_symbol", "baseline_value_usd"),
                    "ticker_symbol").select(
        F.col("stock_key").cast("int").alias("stock_key"), "ticker_symbol",
        "baseline_value_usd")


def fact_carry(basis: DataFrame, fact: DataFrame,
               before: DataFrame | None = None) -> DataFrame:
    """The carry table: per row of ``basis`` the last and the opening close,
    from the rows of ``fact`` and, for what came earlier, ``before``."""
    own = fact.groupBy("stock_key").agg(
        F.max_by("close_price", "date_key").alias("__last"),
        F.min_by("close_price", "date_key").alias("__first"))
    out = basis.join(own, "stock_key", "left")
    if before is None:
        return out.select(*basis.columns, F.col("__last").alias("last_close"),
                          F.col("__first").alias("opening_close"))
    old = before.select("stock_key", "last_close", "opening_close")
    return out.join(old, "stock_key", "left").select(
        *basis.columns, F.coalesce("__last", "last_close").alias("last_close"),
        F.coalesce("opening_close", "__first").alias("opening_close"))


def same_basis(basis: DataFrame, carry: DataFrame) -> bool:
    """Whether both hold the same instruments with the same keys and baseline
    values (a join of dimension size)."""
    a = basis.select(*[F.col(c).alias(f"a_{c}") for c in basis.columns])
    differs = ~(F.col("a_ticker_symbol").eqNullSafe(F.col("ticker_symbol"))
                & F.col("a_baseline_value_usd").eqNullSafe(
                    F.col("baseline_value_usd")))
    return a.join(carry.select(*basis.columns),
                  F.col("a_stock_key") == F.col("stock_key"), "full_outer") \
        .where(F.col("a_stock_key").isNull() | F.col("stock_key").isNull()
               | differs).isEmpty()


def fact_increment(new: DataFrame, carry: DataFrame, dim_stock: DataFrame,
                   dim_date: DataFrame, holdings: DataFrame, params: RunParams,
                   last_key: int, stored_form: bool = False) -> DataFrame:
    """Fact rows of cleaned prices that are all newer than the fact: the same
    rows that a full refresh would give them.  Only the new days are windowed;
    the price before them and the opening price come from the carry table, and
    keys go on from ``last_key``, as newer days come last in key order."""
    keyed = keyed_prices(new, dim_stock, dim_date, holdings, params).join(
        carry.select("stock_key", "last_close", "opening_close"), "stock_key",
        "left")
    rows = with_measures(keyed, carried=True)
    return stored_fact(rows, last_key) if stored_form else _fact_columns(
        sequential_ids(rows, F.col("date_key"), F.col("stock_key"), "price_key",
                       start=last_key))


def sorted_fact(fact: DataFrame) -> DataFrame:
    """The fact in the reference's output order (a range-partitioned sort)."""
    return fact.orderBy("date_key", "stock_key")
