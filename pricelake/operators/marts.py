"""Analyst marts over the star schema.

Every mart is its own lazy DataFrame over the analyst dataset
(``star_join``), so filters from ``analyst_filter`` reach the fact scan and
each chart's numbers are computed by executors.  Money sums and return
means are computed exactly (decimal sums of values that carry 2 and 4
decimals), so results do not depend on row arrival order.

Scalar facts that a mart needs (latest date, totals) are attached as
scalar subqueries, not by joining or collecting.

Marts per ticker, fund or date over the whole fact need no star: they aggregate
the fact by its own keys first (``stock_parts``, ``date_parts``) and join one row
per key to the dimensions, where the sums, counts and extremes are merged
(``fact_tickers``).  The fact's keys are taken as keys of the dimensions, which
the gold job ensures; rows of closed versions are left out as in the star.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.functions.numeric import (exact_avg, exact_sum, exact_sum_over,
                                         pct_change,
                                         pct_change_or_zero, round_half_away,
                                         round_half_even)
from pricelake.functions.text import first_chars, title_label
from pricelake.params import MUTUAL_FUND, STOCK
from pricelake.schemas import STAR_COLS

# Metric labels of the per-ticker summary table.
SUMMARY_METRICS = [
    "First Close", "Latest Close", "Total Return", "Avg Daily Return",
    "Best Day", "Worst Day", "Trading Days",
]
HISTOGRAM_BINS = 30


# -- joins ------------------------------------------------------------------

def star_join(fact: DataFrame, dim_date: DataFrame,
              dim_stock: DataFrame) -> DataFrame:
    """fact x date x current stock version, the 13 analyst columns."""
    d = dim_date.select(F.col("date_key"), F.col("full_date").alias("trade_date"),
                        "year", "quarter", "month_name", "is_weekend")
    s = dim_stock.where(F.col("is_current")).select(
        "stock_key", "ticker_symbol", "fund_name", "sector", "instrument_type")
    return fact.join(d, "date_key").join(s, "stock_key").select(*STAR_COLS)


def fact_between(fact: DataFrame, start: dt.date | None = None,
                 end: dt.date | None = None) -> DataFrame:
    """Fact rows of a date range, as ``month_key`` and ``date_key`` bounds on
    the fact itself: they prune its partitions and row groups, which a
    condition on the calendar's date cannot do at planning time."""
    for bound, after in ((start, True), (end, False)):
        if bound is not None:
            for name, key in (("month_key", bound.year * 100 + bound.month),
                              ("date_key", bound.year * 10000
                               + bound.month * 100 + bound.day)):
                if name in fact.columns:
                    fact = fact.where(F.col(name) >= key if after
                                      else F.col(name) <= key)
    return fact


def latest_fact(fact: DataFrame) -> DataFrame:
    """Fact rows of the newest date (one column decides it)."""
    return newest_fact(fact, 1)


def newest_fact(fact: DataFrame, n: int) -> DataFrame:
    """Fact rows of the newest ``n`` dates.  One column names them: counted per
    date in the map tasks, their least becomes a bound on ``date_key`` and on
    the partition column ``month_key``, so other months are not read."""
    days = fact.groupBy("date_key").agg(F.lit(1).alias("one")) \
        .orderBy(F.desc("date_key")).limit(n) if n > 1 else fact
    bound = days.agg((F.min if n > 1 else F.max)("date_key")).scalar()
    if "month_key" in fact.columns:
        fact = fact.where(F.col("month_key") >= F.floor(bound / F.lit(100)))
    return fact.where(F.col("date_key") >= bound)


def fact_date_join(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    return fact.join(dim_date, "date_key")


def fact_stock_join(fact: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """fact x every dimension version on ``stock_key``."""
    return fact.join(dim_stock, "stock_key")


# -- filters ----------------------------------------------------------------

def analyst_filter(star: DataFrame, start: dt.date | None = None,
                   end: dt.date | None = None,
                   types: Sequence[str] | None = None,
                   sectors: Sequence[str] | None = None,
                   tickers: Sequence[str] | None = None) -> DataFrame:
    """Inclusive date range and membership filters.

    ``None`` selects every non-null value (the default selection is the
    list of distinct non-null values, so null types or sectors drop out);
    an empty list selects no rows.  Date bounds default to the data bounds.
    """
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col("trade_date") >= F.lit(start))
    if end is not None:
        cond = cond & (F.col("trade_date") <= F.lit(end))
    for col, sel in (("instrument_type", types), ("sector", sectors),
                     ("ticker_symbol", tickers)):
        if sel is None:
            cond = cond & F.col(col).isNotNull()
        elif len(sel) == 0:
            cond = cond & F.lit(False)
        else:
            cond = cond & F.col(col).isin(list(sel))
    return star.where(cond)


def is_empty_result(df: DataFrame) -> bool:
    """The "no rows match" guard (reads at most one row)."""
    return df.isEmpty()


def latest_date(star: DataFrame) -> F.Column:
    return star.agg(F.max("trade_date")).scalar()


def latest_slice(star: DataFrame) -> DataFrame:
    """Rows on the newest date of the selection.  For the whole star, joining
    ``latest_fact`` reads the star once."""
    return star.where(F.col("trade_date") == latest_date(star))


def drop_null_returns(star: DataFrame) -> DataFrame:
    return star.where(F.col("daily_return_pct").isNotNull())


def ticker_history(star: DataFrame, ticker: str | None = None) -> DataFrame:
    """Price history per ticker in date order, with the ticker's metadata
    taken from its first row (fund, sector, readable type label).

    Rows are dealt by ranges of tickers before the window, so one exchange and
    one sort serve both the window and the order of the result."""
    df = star if ticker is None else star.where(F.col("ticker_symbol") == ticker)
    df = df.repartitionByRange("ticker_symbol")
    w = Window.partitionBy("ticker_symbol").orderBy("trade_date")
    meta = {c: F.first(c).over(w) for c in ("fund_name", "sector",
                                            "instrument_type")}
    return df.select(
        "ticker_symbol", "trade_date", "close_price", "daily_return_pct",
        meta["fund_name"].alias("fund_name"), meta["sector"].alias("sector"),
        title_label(meta["instrument_type"]).alias("type_label"),
    ).orderBy("ticker_symbol", "trade_date")


# -- aggregates ---------------------------------------------------------------

def stock_parts(fact: DataFrame) -> DataFrame:
    """One mergeable row per ``stock_key``: a hash aggregate of the fact alone."""
    ret = F.col("daily_return_pct")
    return fact.groupBy("stock_key").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(ret).alias("n_ret"),
        F.sum(ret.cast("decimal(28,4)")).alias("sum_ret"),
        F.max(ret).alias("best"), F.min(ret).alias("worst"),
        F.min("close_price").alias("low"), F.max("close_price").alias("high"),
        F.min("date_key").alias("first_key"), F.max("date_key").alias("last_key"),
        F.min_by("close_price", "date_key").alias("first_close"),
        F.max_by("close_price", "date_key").alias("last_close"))


def merged_parts(parts: DataFrame, *keys: str) -> DataFrame:
    """``stock_parts`` rows with attributes, merged per ``keys``."""
    return parts.groupBy(*keys).agg(
        F.sum("n").alias("n"),
        F.try_divide(F.sum("sum_ret").cast("double"),
                     F.sum("n_ret").cast("double")).alias("avg_ret"),
        F.max("best").alias("best"), F.min("worst").alias("worst"),
        F.min("low").alias("low"), F.max("high").alias("high"),
        F.min_by("first_close", "first_key").alias("first_close"),
        F.max_by("last_close", "last_key").alias("last_close"))


def current_parts(fact: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """``stock_parts`` of the current versions, with ticker and type."""
    cur = dim_stock.where(F.col("is_current")).select(
        "stock_key", "ticker_symbol", "instrument_type")
    return stock_parts(fact).join(cur, "stock_key")


def fact_tickers(fact: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """One row per ticker, as ``star_tickers`` gives it, from the fact."""
    return merged_parts(current_parts(fact, dim_stock), "ticker_symbol")


def star_tickers(star: DataFrame) -> DataFrame:
    """One row per ticker of a (filtered) star: rows, mean, best and worst
    return, first and last close."""
    return star.groupBy("ticker_symbol").agg(
        F.count(F.lit(1)).alias("n"),
        exact_avg("daily_return_pct", 4).alias("avg_ret"),
        F.max("daily_return_pct").alias("best"),
        F.min("daily_return_pct").alias("worst"),
        F.min_by("close_price", "trade_date").alias("first_close"),
        F.max_by("close_price", "trade_date").alias("last_close"))


def date_parts(fact: DataFrame, dim_date: DataFrame,
               dim_stock: DataFrame) -> DataFrame:
    """``portfolio_by_date`` from the fact: rows of current versions (a semi
    join on one column) are added up per ``date_key``, and one row per date
    meets the calendar."""
    cur = dim_stock.where(F.col("is_current")).select("stock_key")
    sums = fact.join(cur, "stock_key", "left_semi").groupBy("date_key").agg(
        exact_sum("portfolio_value", 2).alias("portfolio_value"))
    return sums.join(dim_date.select("date_key", "full_date"), "date_key").select(
        F.col("full_date").alias("trade_date"), "portfolio_value")


def portfolio_by_date(star: DataFrame) -> DataFrame:
    """Total portfolio value per date (no forward fill, as the reference)."""
    return star.groupBy("trade_date").agg(
        exact_sum("portfolio_value", 2).alias("portfolio_value"))


def value_by_ticker_date(star: DataFrame) -> DataFrame:
    return star.groupBy("trade_date", "ticker_symbol").agg(
        exact_sum("portfolio_value", 2).alias("portfolio_value"))


def sector_allocation(latest: DataFrame) -> DataFrame:
    """Value per sector of the latest date's rows; null sectors dropped."""
    return (latest.where(F.col("sector").isNotNull()).groupBy("sector")
            .agg(exact_sum("portfolio_value", 2).alias("value")))


def sector_share(latest: DataFrame) -> DataFrame:
    """Sector value and its percent of the latest-date total (a window over
    the few sector rows)."""
    total = exact_sum_over("value", 2, Window.partitionBy())
    return sector_allocation(latest).select(
        "sector", "value",
        (F.try_divide(F.col("value"), total) * F.lit(100.0)).alias("share_pct"))


def return_sign(x) -> F.Column:
    """'up' for x >= 0, else 'down' (a null return counts as down)."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(F.coalesce(x >= 0, F.lit(False)), F.lit("up")) \
        .otherwise(F.lit("down"))


def ticker_total_return(star: DataFrame) -> DataFrame:
    """First and last close per ticker, percent change (2 dp, half-even),
    ascending."""
    return total_return(star_tickers(star.where(F.col("close_price").isNotNull())))


def total_return(tickers: DataFrame) -> DataFrame:
    """``ticker_total_return`` from one row per ticker."""
    out = tickers.select("ticker_symbol", "first_close", "last_close")
    ret = round_half_even(pct_change("last_close", "first_close"), 2)
    return (out.withColumn("total_return_pct", ret)
            .withColumn("direction", return_sign("total_return_pct"))
            .orderBy(F.asc_nulls_last("total_return_pct"), "ticker_symbol"))


def ticker_avg_return(star: DataFrame) -> DataFrame:
    """Mean daily return per ticker, best first."""
    return avg_return(star_tickers(star))


def avg_return(tickers: DataFrame) -> DataFrame:
    """``ticker_avg_return`` from one row per ticker."""
    out = tickers.select("ticker_symbol", F.col("avg_ret").alias("avg_daily_return"))
    return (out.withColumn("direction", return_sign("avg_daily_return"))
            .orderBy(F.desc_nulls_last("avg_daily_return"), "ticker_symbol"))


def kpi_period_return(star: DataFrame) -> DataFrame:
    pbd = portfolio_by_date(star)
    out = pbd.agg(
        F.min_by("portfolio_value", "trade_date").alias("earliest_total"),
        F.max_by("portfolio_value", "trade_date").alias("latest_total"))
    return out.withColumn("period_return_pct",
                          pct_change_or_zero("latest_total", "earliest_total"))


def kpi_day_change(star: DataFrame) -> DataFrame:
    """Latest total minus the previous date's total; 0 without a previous date.
    Over the whole star, a star of ``newest_fact(fact, 2)`` is enough."""
    return day_change(portfolio_by_date(star))


def day_change(by_date: DataFrame) -> DataFrame:
    """``kpi_day_change`` from the totals per date."""
    top2 = by_date.orderBy(F.desc("trade_date")).limit(2)
    out = top2.agg(
        F.max("trade_date").alias("latest_date"),
        F.max_by("portfolio_value", "trade_date").alias("latest_total"),
        F.when(F.count(F.lit(1)) == 2,
               F.min_by("portfolio_value", "trade_date")).alias("prev_total"))
    change = F.when(F.col("prev_total").isNull(), F.lit(0.0)).otherwise(
        F.col("latest_total") - F.col("prev_total"))
    pct = F.when(F.col("prev_total").isNull(), F.lit(0.0)).otherwise(
        pct_change_or_zero("latest_total", "prev_total"))
    return out.select("latest_date", "latest_total", "prev_total",
                      change.alias("day_change"), pct.alias("day_change_pct"))


def kpi_avg_return(star: DataFrame) -> DataFrame:
    return star.agg(exact_avg("daily_return_pct", 4).alias("avg_daily_return"))


def kpi_instruments(star: DataFrame) -> DataFrame:
    """Distinct tickers, by type, and the row count, all exact: rows are
    counted per (ticker, type) first, so no row is expanded per distinct."""
    return instruments(star.groupBy("ticker_symbol", "instrument_type").agg(
        F.count(F.lit(1)).alias("n")))


def instruments(parts: DataFrame) -> DataFrame:
    """``kpi_instruments`` from row counts ``n`` per ticker and type."""
    t, typ = F.col("ticker_symbol"), F.col("instrument_type")
    per = parts.groupBy(t).agg(
        F.sum("n").alias("n"),
        F.max(F.when(typ == MUTUAL_FUND, 1)).alias("fund"),
        F.max(F.when(typ == STOCK, 1)).alias("stock"))
    has = t.isNotNull()
    return per.agg(
        F.count_if(has).alias("n_tickers"),
        F.count_if(has & (F.col("fund") == 1)).alias("n_funds"),
        F.count_if(has & (F.col("stock") == 1)).alias("n_stocks"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"))


def freshness(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Latest trade date and last processed time of the fact: two maxima of the
    fact alone, one row of which meets the calendar."""
    newest = fact.agg(F.max("date_key").alias("date_key"),
                      F.max("processed_at").alias("last_processed"))
    return newest.join(dim_date.select("date_key", "full_date"), "date_key",
                       "left").select(
        F.col("full_date").alias("latest_trade"), "last_processed",
        first_chars("last_processed", 19).alias("last_processed_display"))


def staleness_class(fresh: DataFrame, as_of: dt.date) -> DataFrame:
    """Days since the latest trade: <= 1 fresh, <= 3 aging, else stale."""
    days = F.datediff(F.lit(as_of), F.col("latest_trade"))
    return fresh.select(
        "latest_trade", days.alias("days_stale"),
        F.when(days <= 1, F.lit("fresh")).when(days <= 3, F.lit("aging"))
         .otherwise(F.lit("stale")).alias("staleness"))


def filter_domains(star: DataFrame) -> DataFrame:
    """Choice lists of the filters: (domain, value), sorted, plus date bounds.

    One pass over the star: its distinct (type, sector, ticker) with their
    date range, from which every list follows."""
    names = ("instrument_type", "sector", "ticker_symbol")
    per = star.groupBy(*names).agg(F.min("trade_date").cast("string").alias("lo"),
                                   F.max("trade_date").cast("string").alias("hi"))
    # (domain, value, what sets its rows apart); a date bound is one row
    entry = lambda d, v, k: F.struct(F.lit(d).alias("domain"),
                                     v.alias("value"), k.alias("k"))
    rows = per.select(F.explode(F.array(
        *[entry(c, F.col(c), F.col(c)) for c in names],
        entry("min_date", F.col("lo"), F.lit("")),
        entry("max_date", F.col("hi"), F.lit("")))).alias("r")).select("r.*")
    value = F.when(F.col("domain") == "min_date", F.min("value")) \
        .otherwise(F.max("value"))
    return (rows.where("k is not null").groupBy("domain", "k")
            .agg(value.alias("value")).select("domain", "value")
            .orderBy("domain", "value"))


def return_histogram(star: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram of daily returns per ticker (nulls dropped).

    ``bins`` bins on [min, max] of each ticker's returns; the maximum lands
    in the last bin; a ticker whose returns are all equal gets one bin.  One
    exchange by ticker serves bounds and counts; a ticker has at most one row
    per calendar day.
    """
    w = Window.partitionBy("ticker_symbol")
    x = F.col("daily_return_pct")
    r = drop_null_returns(star).select(
        "ticker_symbol", x, F.min(x).over(w).alias("lo"),
        F.max(x).over(w).alias("hi"))
    width = F.col("hi") - F.col("lo")
    b = F.when(width == 0, F.lit(0)).otherwise(F.least(
        F.floor((x - F.col("lo")) / width * F.lit(float(bins))).cast("int"),
        F.lit(bins - 1)))
    counted = r.groupBy("ticker_symbol", b.alias("bin"), "lo", "hi") \
        .agg(F.count(F.lit(1)).alias("days"))
    step = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    return counted.select(
        "ticker_symbol", "bin",
        (F.col("lo") + F.col("bin") * step).alias("bin_lo"),
        F.when(F.col("hi") == F.col("lo"), F.col("hi"))
         .otherwise(F.col("lo") + (F.col("bin") + 1) * step).alias("bin_hi"),
        "days")


def ticker_summary(star: DataFrame) -> DataFrame:
    """Seven summary numbers per ticker as (ticker, metric, value) rows."""
    return summary(star_tickers(star))


def summary(tickers: DataFrame) -> DataFrame:
    """``ticker_summary`` from one row per ticker."""
    g = tickers.withColumn("total_ret", pct_change("last_close", "first_close")) \
        .withColumn("days", F.col("n").cast("double"))
    cols = ["first_close", "last_close", "total_ret", "avg_ret", "best",
            "worst", "days"]
    g = g.select("ticker_symbol",
                 *[F.col(c).alias(m) for c, m in zip(cols, SUMMARY_METRICS)])
    return g.unpivot("ticker_symbol", SUMMARY_METRICS, "metric", "value")


# -- validation-script reports (rounded as SQL ROUND) ------------------------

def daily_summary(fact: DataFrame, dim_date: DataFrame,
                  n: int = 10) -> DataFrame:
    """Per date and quarter: total value (2 dp) and mean return (4 dp),
    the newest ``n`` dates.  Only those dates are read, and one row per date
    meets the calendar."""
    g = newest_fact(fact, n).groupBy("date_key").agg(
        round_half_away(exact_sum("portfolio_value", 2), 2)
        .alias("total_portfolio_value"),
        round_half_away(exact_avg("daily_return_pct", 4), 4)
        .alias("avg_daily_return_pct"))
    return (fact_date_join(g, dim_date)
            .select("full_date", "quarter", "total_portfolio_value",
                    "avg_daily_return_pct")
            .orderBy(F.desc("full_date")).limit(n))


def fund_ranking(fact: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """Per fund: mean return (4 dp), max and min price (2 dp), best first."""
    names = ("ticker_symbol", "fund_name", "sector")
    parts = stock_parts(fact).join(dim_stock.select("stock_key", *names),
                                   "stock_key")
    g = merged_parts(parts, *names).select(
        *names, round_half_away("avg_ret", 4).alias("avg_daily_return"),
        round_half_away("high", 2).alias("max_price"),
        round_half_away("low", 2).alias("min_price"))
    return g.orderBy(F.desc_nulls_last("avg_daily_return"), "ticker_symbol")


def star_sample(fact: DataFrame, dim_date: DataFrame, dim_stock: DataFrame,
                since: dt.date, n: int = 20) -> DataFrame:
    """First ``n`` fact rows from ``since`` on, by date and ticker."""
    j = fact_stock_join(fact_date_join(fact_between(fact, since), dim_date),
                        dim_stock)
    return (j.where(F.col("full_date") >= F.lit(since))
            .select("price_key", "full_date", "ticker_symbol", "close_price",
                    "daily_return_pct", "portfolio_value")
            .orderBy("full_date", "ticker_symbol", "price_key").limit(n))


def sort_mart_rows(df: DataFrame, col: str, ascending: bool) -> DataFrame:
    """Order a mart by its value, nulls last in both directions."""
    key = F.asc_nulls_last(col) if ascending else F.desc_nulls_last(col)
    return df.orderBy(key)
