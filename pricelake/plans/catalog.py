"""Registry of named queries over the test binding, with their SQL oracles.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]``
is DuckDB SQL over the base test tables computing the same rows with the
same column names (see ``oracle.py`` for the CTE chain).  Every query reads
the whole bound tables; a ``LIMIT`` appears only where a top-n or sample is
the operator itself.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import fact as fct
from pricelake.operators import incremental as inc
from pricelake.operators import marts, quality
from pricelake.operators import silver as sv
from pricelake.operators.calendar import dim_date_span
from pricelake.operators.scd2 import (current_versions, scd2_asof, scd2_counts,
                                      scd2_parts)
from pricelake.plans import binding as b
from pricelake.plans import pipeline as jobs
from pricelake.plans.oracle import pct, rnd, rnd_even, sql, xavg, xsum
from pricelake.schemas import SILVER_KEPT
from pricelake.sources import sinks
from pricelake.sources import testdata as td
from pricelake.sources.landing import bronze_union, landing_read
from pricelake.sources.tables import parquet_scan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

AS_OF = td.TEST_AS_OF
MARK = td.TEST_MARK
STAR_SINCE = dt.date(2001, 3, 9)
FILTER_START = dt.date(1997, 1, 1)
FILTER_END = dt.date(1999, 12, 31)
FILTER_TYPES = ["stock"]
FILTER_SECTORS = ["LARGE", "PROMO", "SMALL"]
WINDOW_START = dt.date(1998, 1, 1)
WINDOW_END = dt.date(1998, 12, 31)
SLICE_START = dt.date(1995, 3, 10)
SLICE_END = dt.date(1995, 3, 14)
SILVER_CONTRACT = ", ".join(SILVER_KEPT)
BRONZE_COLS = ["ticker_symbol", "Date", "Open", "High", "Low", "Close",
               "Volume", "l_orderkey", "l_linenumber", "l_suppkey",
               "ingested_at", "source_system", "batch_id", "ingested_date"]
NUMERIC_BRONZE = ["Open", "High", "Low", "Close", "Volume", "l_orderkey",
                  "l_linenumber", "l_suppkey"]


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = sql(oracle)
        return fn
    return deco


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _in(xs) -> str:
    return ", ".join(f"'{x}'" for x in xs)


def _prepared(spark, sf):
    return sv.prepare(b.bronze_table(spark, sf), td.holdings(spark, sf))


# == 2.1 sources, sinks, load state ==========================================

@register("landing_read", f"""
SELECT ticker_symbol, "Date", "Open", "High", "Low", "Close", "Volume"
FROM landing WHERE "Date" >= TIMESTAMP '{td.TEST_CALENDAR_START}'""")
def q_landing_read(spark, sf):
    return landing_read(spark, b.drops(spark, sf), td.TEST_CALENDAR_START)


@register("bronze_union", """
SELECT ticker_symbol, "Date", "Open", "High", "Low", "Close", "Volume",
       l_orderkey, l_linenumber, l_suppkey FROM landing""")
def q_bronze_union(spark, sf):
    return bronze_union(b.landing_runs(spark, sf))


@register("bronze_metadata", "SELECT * FROM bronze")
def q_bronze_metadata(spark, sf):
    return b.bronze(spark, sf)


@register("parquet_scan", "SELECT * FROM lineitem")
def q_parquet_scan(spark, sf):
    return parquet_scan(spark, f"{sf}/lineitem.parquet", td.LINEITEM)


@register("holdings_table", "SELECT * FROM holdings")
def q_holdings_table(spark, sf):
    return td.holdings_config(spark, sf)


@register("high_water_mark",
          "SELECT max(trade_date) AS high_water_mark FROM silver")
def q_high_water_mark(spark, sf):
    return inc.high_water_mark(b.silver_table(spark, sf))


@register("incremental_load", f"""
SELECT * FROM bronze
WHERE CAST("Date" AS DATE) > (SELECT max(trade_date) FROM silver
                              WHERE trade_date <= {_d(MARK)})""")
def q_incremental_load(spark, sf):
    # the mark of a cleaned layer that holds the days up to MARK
    loaded = b.silver_table(spark, sf).where(F.col("trade_date") <= MARK)
    return inc.incremental_load(b.bronze_table(spark, sf),
                                inc.mark_value(loaded))


@register("incremental_ledger", """
SELECT ticker_symbol, trade_date, close_price, high_price, low_price, open_price,
       volume, instrument_type, ingested_at, batch_id AS silver_batch_id
FROM (SELECT *, row_number() OVER (
          PARTITION BY ticker_symbol, trade_date
          ORDER BY ingested_date, open_price NULLS FIRST, high_price NULLS FIRST,
                   low_price NULLS FIRST, close_price, volume NULLS FIRST) AS copy
      FROM valid_rows)
WHERE copy = 1""")
def q_incremental_ledger(spark, sf):
    return jobs.read_silver(spark, b.ledger_lake(spark, sf)).select(
        "ticker_symbol", "trade_date", "close_price", "high_price", "low_price",
        "open_price", "volume", "instrument_type", "ingested_at",
        "silver_batch_id")


# the jobs, run over the stored drops (one raw load, dated like the gold run)

@register("bronze_append", f"""
SELECT "Date", "Open", "High", "Low", "Close", "Volume", ticker_symbol,
       '{td.GOLD_PARAMS.run_iso}' AS ingested_at,
       '{td.TEST_SOURCE}' AS source_system,
       '{td.GOLD_PARAMS.batch_id}' AS batch_id,
       '{td.GOLD_PARAMS.run_date_iso}' AS ingested_date
FROM landing""")
def q_bronze_append(spark, sf):
    return jobs.read_bronze(spark, b.lake(spark, sf)).withColumn(
        "ingested_date", F.col("ingested_date").cast("string"))


# the copy of a bar that is kept where all runs are stamped alike
_FIRST_COPY = """
SELECT *, row_number() OVER (
    PARTITION BY ticker_symbol, trade_date
    ORDER BY open_price NULLS FIRST, high_price NULLS FIRST,
             low_price NULLS FIRST, close_price, volume NULLS FIRST) AS copy
FROM valid_rows"""


@register("silver_write", f"""
SELECT ticker_symbol, trade_date, close_price, high_price, low_price, open_price,
       volume, instrument_type, '{td.GOLD_PARAMS.batch_id}' AS silver_batch_id
FROM ({_FIRST_COPY}) WHERE copy = 1""")
def q_silver_write(spark, sf):
    return jobs.read_silver(spark, b.lake(spark, sf)).select(
        "ticker_symbol", "trade_date", "close_price", "high_price", "low_price",
        "open_price", "volume", "instrument_type", "silver_batch_id")


@register("dim_snapshot_read", f"""
SELECT CAST(ordinal + 1 AS INTEGER) AS stock_key, ticker_symbol, fund_name,
       coalesce(sector, 'Unknown') AS sector, instrument_type,
       {_d(td.TEST_CALENDAR_START)} AS valid_from,
       DATE '9999-12-31' AS valid_to, true AS is_current
FROM holdings""")
def q_dim_snapshot_read(spark, sf):
    return sinks.dim_snapshot_read(spark, b.lake(spark, sf).gold)


_LAKE_ROWS = """
SELECT DISTINCT trade_date, ordinal + 1 AS stock_key
FROM valid_rows JOIN holdings USING (ticker_symbol)"""


@register("gold_write", f"""
SELECT rank() OVER (ORDER BY trade_date, stock_key) AS price_key,
       CAST(strftime(trade_date, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(stock_key AS INTEGER) AS stock_key,
       CAST(strftime(trade_date, '%Y%m') AS INTEGER) AS month_key, close_price
FROM (SELECT *, ordinal + 1 AS stock_key
      FROM ({_FIRST_COPY}) JOIN holdings USING (ticker_symbol) WHERE copy = 1)""")
def q_gold_write(spark, sf):
    return sinks.gold_table(spark, b.lake(spark, sf).gold,
                            "fact_stock_prices").select(
        "price_key", "date_key", "stock_key", "month_key", "close_price")


@register("fact_incremental", f"""
SELECT rank() OVER (ORDER BY trade_date, stock_key) AS price_key,
       CAST(strftime(trade_date, '%Y%m%d') AS INTEGER) AS date_key, stock_key,
       close_price, {rnd('(close_price - ago) / NULLIF(ago, 0) * 100.0', 4)}
         AS daily_return_pct,
       {rnd('baseline_value_usd * (close_price / NULLIF(opening, 0))', 2)}
         AS portfolio_value
FROM (SELECT trade_date, CAST(ordinal + 1 AS INTEGER) AS stock_key, close_price,
             baseline_value_usd,
             lag(close_price) OVER days AS ago,
             first_value(close_price) OVER days AS opening
      FROM ({_FIRST_COPY})
      JOIN holdings USING (ticker_symbol)
      WHERE copy = 1
      WINDOW days AS (PARTITION BY ordinal ORDER BY trade_date))""")
def q_fact_incremental(spark, sf):
    return b.daily_fact(spark, sf).select(
        "price_key", "date_key", "stock_key", "close_price",
        "daily_return_pct", "portfolio_value")


@register("run_all", f"""
SELECT trade_date, count(*) AS instruments,
       count(*) FILTER (WHERE instrument_type = 'stock') AS stocks
FROM ({_LAKE_ROWS}) r JOIN holdings h ON h.ordinal + 1 = r.stock_key
WHERE trade_date BETWEEN {_d(WINDOW_START)} AND {_d(WINDOW_END)}
GROUP BY trade_date""")
def q_run_all(spark, sf):
    star = jobs.load_star(spark, b.lake(spark, sf), WINDOW_START, WINDOW_END)
    return star.where(F.col("trade_date").between(WINDOW_START, WINDOW_END)) \
        .groupBy("trade_date").agg(
            F.count(F.lit(1)).alias("instruments"),
            F.count_if(F.col("instrument_type") == "stock").alias("stocks"))


@register("watermark_commit", """
SELECT 'bronze' AS layer, NULL::DATE AS high_water_mark,
       count(*) AS rows_in, count(*) AS rows_out, NULL::BIGINT AS duplicates
FROM landing
UNION ALL
SELECT 'silver', (SELECT max(trade_date) FROM valid_rows),
       (SELECT count(*) FROM landing),
       (SELECT count(*) FROM (SELECT DISTINCT ticker_symbol, trade_date
                              FROM valid_rows)),
       (SELECT count(*) FROM valid_rows)
       - (SELECT count(*) FROM (SELECT DISTINCT ticker_symbol, trade_date
                                FROM valid_rows))
UNION ALL
SELECT 'gold', NULL, NULL, (SELECT count(*) FROM (""" + _LAKE_ROWS + """)),
       NULL""")
def q_watermark_commit(spark, sf):
    return spark.read.schema(sinks.AUDIT).parquet(b.lake(spark, sf).audit).select(
        "layer", "high_water_mark", "rows_in", "rows_out", "duplicates")


# == 2.2 projection, casting, predicates =====================================

@register("rename_columns", """
SELECT ticker_symbol, "Date" AS trade_date, "Open" AS open_price,
       "High" AS high_price, "Low" AS low_price, "Close" AS close_price,
       "Volume" AS volume, l_orderkey, l_linenumber, l_suppkey, ingested_at,
       source_system, batch_id, ingested_date FROM bronze""")
def q_rename_columns(spark, sf):
    return sv.rename_columns(b.bronze_table(spark, sf))


@register("cast_types", "SELECT * FROM cast_rows")
def q_cast_types(spark, sf):
    return sv.cast_types(sv.rename_columns(b.bronze_table(spark, sf)))


@register("type_lookup", "SELECT * FROM typed_rows")
def q_type_lookup(spark, sf):
    return sv.type_lookup(sv.cast_types(sv.rename_columns(b.bronze_table(spark, sf))),
                          td.holdings(spark, sf))


@register("null_out_by_type", "SELECT * FROM nulled_rows")
def q_null_out_by_type(spark, sf):
    return _prepared(spark, sf)


@register("project_contract", f"SELECT {SILVER_CONTRACT} FROM nulled_rows")
def q_project_contract(spark, sf):
    return sv.project_contract(_prepared(spark, sf))


@register("valid_price", f"""
SELECT {SILVER_CONTRACT} FROM nulled_rows
WHERE close_price > 0 AND NOT isnan(close_price)""")
def q_valid_price(spark, sf):
    return sv.project_contract(_prepared(spark, sf).where(sv.valid_price()))


@register("not_future", f"""
SELECT {SILVER_CONTRACT} FROM nulled_rows WHERE trade_date <= {_d(AS_OF)}""")
def q_not_future(spark, sf):
    return sv.project_contract(_prepared(spark, sf).where(sv.not_future(AS_OF)))


@register("valid_ticker", f"""
SELECT {SILVER_CONTRACT} FROM nulled_rows
WHERE ticker_symbol IS NOT NULL AND ticker_symbol <> ''""")
def q_valid_ticker(spark, sf):
    return sv.project_contract(_prepared(spark, sf).where(sv.valid_ticker()))


_OK_PRICE = "coalesce(close_price > 0 AND NOT isnan(close_price), false)"
_OK_DATE = f"coalesce(trade_date <= {_d(AS_OF)}, false)"
_OK_TICKER = "(ticker_symbol IS NOT NULL AND ticker_symbol <> '')"


@register("validate_counts", f"""
SELECT *, rows_valid - rows_out AS duplicates FROM (
  SELECT count(*) AS rows_in,
         count(*) FILTER (WHERE NOT {_OK_PRICE}) AS invalid_price,
         count(*) FILTER (WHERE NOT {_OK_DATE}) AS future_date,
         count(*) FILTER (WHERE NOT {_OK_TICKER}) AS invalid_ticker,
         count(*) FILTER (WHERE {_OK_PRICE} AND {_OK_DATE} AND {_OK_TICKER})
           AS rows_valid,
         (SELECT count(*) FROM (SELECT DISTINCT ticker_symbol, trade_date
                                FROM valid_rows)) AS rows_out
  FROM nulled_rows)""")
def q_validate_counts(spark, sf):
    return sv.validate_counts(_prepared(spark, sf), AS_OF)


@register("dedup_first", "SELECT * FROM dedup_rows")
def q_dedup_first(spark, sf):
    return sv.dedup_first(sv.validate(_prepared(spark, sf), AS_OF), sv.KEY,
                          b.SILVER_ORDER)


@register("incremental_stream", "SELECT * FROM silver")
def q_incremental_stream(spark, sf):
    return b.silver_stream(spark, sf)


@register("silver_metadata", "SELECT * FROM silver")
def q_silver_metadata(spark, sf):
    return b.silver(spark, sf)


@register("current_versions", "SELECT * FROM dim_stock WHERE is_current")
def q_current_versions(spark, sf):
    return current_versions(b.dim_stock_table(spark, sf))


@register("analyst_filter", f"""
SELECT * FROM star
WHERE trade_date BETWEEN {_d(FILTER_START)} AND {_d(FILTER_END)}
  AND instrument_type IN ({_in(FILTER_TYPES)})
  AND sector IN ({_in(FILTER_SECTORS)}) AND ticker_symbol IS NOT NULL""")
def q_analyst_filter(spark, sf):
    star = b.star(spark, sf, FILTER_START, FILTER_END)
    return marts.analyst_filter(star, FILTER_START, FILTER_END,
                                FILTER_TYPES, FILTER_SECTORS, None)


@register("date_window", f"""
SELECT f.price_key, d.full_date, f.stock_key, f.close_price
FROM fact f JOIN dim_date d ON f.date_key = d.date_key
WHERE d.full_date BETWEEN {_d(WINDOW_START)} AND {_d(WINDOW_END)}""")
def q_date_window(spark, sf):
    j = marts.fact_date_join(
        b.fact_table(spark, sf, WINDOW_START, WINDOW_END), b.calendar(spark))
    return j.where(F.col("full_date").between(WINDOW_START, WINDOW_END)).select(
        "price_key", "full_date", "stock_key", "close_price")


@register("latest_slice", """
SELECT * FROM star WHERE trade_date = (SELECT max(trade_date) FROM star)""")
def q_latest_slice(spark, sf):
    return b.latest_star(spark, sf)


_TITLE = ("array_to_string(list_transform(string_split(replace({x}, '_', ' '), "
          "' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')")


@register("ticker_history", f"""
SELECT ticker_symbol, trade_date, close_price, daily_return_pct,
       first_value(fund_name) OVER w AS fund_name,
       first_value(sector) OVER w AS sector,
       {_TITLE.format(x='first_value(instrument_type) OVER w')} AS type_label
FROM star WINDOW w AS (PARTITION BY ticker_symbol ORDER BY trade_date)""")
def q_ticker_history(spark, sf):
    return marts.ticker_history(b.star(spark, sf))


@register("drop_null_returns",
          "SELECT * FROM star WHERE daily_return_pct IS NOT NULL")
def q_drop_null_returns(spark, sf):
    return marts.drop_null_returns(b.star(spark, sf))


# == 2.3 joins =================================================================

@register("surrogate_stock", """
SELECT sv.ticker_symbol, sv.trade_date, sv.close_price, s.stock_key
FROM silver sv JOIN dim_stock s
  ON sv.ticker_symbol = s.ticker_symbol AND s.is_current""")
def q_surrogate_stock(spark, sf):
    s = b.silver_table(spark, sf).select("ticker_symbol", "trade_date",
                                          "close_price")
    return fct.surrogate_stock(s, b.dim_stock_table(spark, sf))


@register("surrogate_date", """
SELECT sv.ticker_symbol, sv.trade_date, sv.close_price, d.date_key
FROM silver sv JOIN dim_date d ON CAST(sv.trade_date AS DATE) = d.full_date""")
def q_surrogate_date(spark, sf):
    s = b.silver_table(spark, sf).select("ticker_symbol", "trade_date",
                                          "close_price")
    return fct.surrogate_date(s, b.calendar(spark))


@register("baseline_join", """
SELECT sv.ticker_symbol, sv.trade_date, sv.close_price, h.baseline_value_usd
FROM silver sv JOIN holdings h ON sv.ticker_symbol = h.ticker_symbol""")
def q_baseline_join(spark, sf):
    s = b.silver_table(spark, sf).select("ticker_symbol", "trade_date",
                                          "close_price")
    return fct.baseline_join(s, td.holdings(spark, sf))


@register("star_join", "SELECT * FROM star")
def q_star_join(spark, sf):
    return b.star(spark, sf)


@register("fact_date_join",
          "SELECT * FROM fact JOIN dim_date USING (date_key)")
def q_fact_date_join(spark, sf):
    return marts.fact_date_join(b.fact_table(spark, sf), b.calendar(spark))


@register("fact_stock_join",
          "SELECT * FROM fact JOIN dim_stock USING (stock_key)")
def q_fact_stock_join(spark, sf):
    return marts.fact_stock_join(b.fact_table(spark, sf),
                                 b.dim_stock_table(spark, sf))


@register("scd2_merge", "SELECT * FROM dim_stock")
def q_scd2_merge(spark, sf):
    return b.dim_stock(spark, sf)


@register("union_rows", "SELECT * FROM scd2_parts")
def q_union_rows(spark, sf):
    return scd2_parts(td.dim_stock_prev(spark, sf), td.holdings_next(spark, sf),
                      td.GOLD_PARAMS)


@register("scd2_asof", """
SELECT sv.ticker_symbol, sv.trade_date, sv.close_price, d.stock_key,
       d.fund_name, d.sector, d.instrument_type, d.valid_from, d.valid_to,
       d.is_current
FROM silver sv JOIN dim_stock d
  ON sv.ticker_symbol = d.ticker_symbol AND sv.trade_date >= d.valid_from
 AND sv.trade_date < d.valid_to""")
def q_scd2_asof(spark, sf):
    s = b.silver_table(spark, sf).select("ticker_symbol", "trade_date",
                                          "close_price")
    return scd2_asof(s, b.dim_stock_table(spark, sf))


# == 2.4 aggregation ===========================================================

@register("bronze_counts", """
SELECT ticker_symbol, count(*) AS row_count, min("Date") AS earliest_date,
       max("Date") AS latest_date
FROM bronze GROUP BY ticker_symbol""")
def q_bronze_counts(spark, sf):
    return quality.bronze_counts(b.bronze_table(spark, sf))


@register("bronze_null_audit", """
SELECT n AS total_rows, n - c AS null_close, n - t AS null_ticker,
       n - d AS null_date
FROM (SELECT count(*) AS n, count("Close") AS c, count(ticker_symbol) AS t,
             count("Date") AS d FROM bronze)""")
def q_bronze_null_audit(spark, sf):
    return quality.bronze_null_audit(b.bronze_table(spark, sf))


@register("silver_counts", f"""
SELECT ticker_symbol, instrument_type, count(*) AS row_count,
       min(trade_date) AS earliest_date, max(trade_date) AS latest_date,
       {rnd(xavg('close_price', 8), 2)} AS avg_price
FROM silver GROUP BY ticker_symbol, instrument_type""")
def q_silver_counts(spark, sf):
    return quality.silver_counts(b.silver_table(spark, sf))


@register("silver_null_audit", """
SELECT n AS total_rows, n - c AS null_close, n - d AS null_date,
       n - t AS null_ticker, bad AS invalid_price
FROM (SELECT count(*) AS n, count(close_price) AS c, count(trade_date) AS d,
             count(ticker_symbol) AS t,
             coalesce(sum(CAST(close_price <= 0 AS BIGINT)), 0)::BIGINT AS bad
      FROM silver)""")
def q_silver_null_audit(spark, sf):
    return quality.silver_null_audit(b.silver_table(spark, sf))


@register("duplicate_audit", """
SELECT ticker_symbol, trade_date, occurrences
FROM (SELECT *, row_number() OVER (ORDER BY occurrences DESC, ticker_symbol,
                                   trade_date) AS place
      FROM (SELECT DISTINCT ticker_symbol, trade_date, count(*) OVER (
                     PARTITION BY ticker_symbol, trade_date) AS occurrences
            FROM valid_rows)
      WHERE occurrences > 1)
WHERE place <= 10""")
def q_duplicate_audit(spark, sf):
    return quality.duplicate_audit(sv.validate(_prepared(spark, sf), AS_OF))


@register("portfolio_by_date", "SELECT * FROM portfolio_by_date")
def q_portfolio_by_date(spark, sf):
    return marts.date_parts(b.fact_table(spark, sf), b.calendar(spark),
                            b.dim_stock_table(spark, sf))


@register("daily_summary", f"""
SELECT trade_date AS full_date, 'Q' || quarter(trade_date) AS quarter,
       {rnd('v', 2)} AS total_portfolio_value, {rnd('m', 4)} AS avg_daily_return_pct
FROM (SELECT trade_date, {xsum('portfolio_value', 2)} AS v,
             {xavg('daily_return_pct', 4)} AS m,
             rank() OVER (ORDER BY trade_date DESC) AS place
      FROM priced GROUP BY trade_date)
WHERE place <= 10""")
def q_daily_summary(spark, sf):
    return marts.daily_summary(b.fact_table(spark, sf, months=True),
                               b.calendar(spark))


@register("fund_ranking", f"""
SELECT i.ticker_symbol, i.fund_name, i.sector, {rnd('m', 4)} AS avg_daily_return,
       {rnd('hi', 2)} AS max_price, {rnd('lo', 2)} AS min_price
FROM dim_stock i JOIN (
  SELECT stock_key, {xavg('daily_return_pct', 4)} AS m, max(close_price) AS hi,
         min(close_price) AS lo FROM priced GROUP BY stock_key) USING (stock_key)""")
def q_fund_ranking(spark, sf):
    return marts.fund_ranking(b.fact_table(spark, sf),
                              b.dim_stock_table(spark, sf))


@register("value_by_ticker_date", f"""
SELECT trade_date, ticker_symbol, {xsum('portfolio_value', 2)} AS portfolio_value
FROM star GROUP BY trade_date, ticker_symbol""")
def q_value_by_ticker_date(spark, sf):
    return marts.value_by_ticker_date(b.star(spark, sf))


_ALLOC = f"""
SELECT sector, {xsum('portfolio_value', 2)} AS value FROM star
WHERE trade_date = (SELECT max(trade_date) FROM star) AND sector IS NOT NULL
GROUP BY sector"""


@register("sector_allocation", _ALLOC)
def q_sector_allocation(spark, sf):
    return marts.sector_allocation(b.latest_star(spark, sf))


@register("sector_share", f"""
SELECT sector, value,
       value / (SELECT {xsum('value', 2)} FROM ({_ALLOC})) * 100.0 AS share_pct
FROM ({_ALLOC})""")
def q_sector_share(spark, sf):
    return marts.sector_share(b.latest_star(spark, sf))


_SIGN = "CASE WHEN coalesce({x} >= 0, false) THEN 'up' ELSE 'down' END"


@register("ticker_total_return", f"""
SELECT *, {_SIGN.format(x='total_return_pct')} AS direction FROM (
  SELECT *, {rnd_even(pct('last_close', 'first_close'), 2)} AS total_return_pct
  FROM (SELECT ticker_symbol, arg_min(close_price, trade_date) AS first_close,
               arg_max(close_price, trade_date) AS last_close
        FROM star WHERE close_price IS NOT NULL GROUP BY ticker_symbol))""")
def q_ticker_total_return(spark, sf):
    return marts.total_return(b.tickers(spark, sf))


@register("return_sign", f"""
SELECT ticker_symbol, trade_date, daily_return_pct,
       {_SIGN.format(x='daily_return_pct')} AS direction FROM star""")
def q_return_sign(spark, sf):
    return b.star(spark, sf).select(
        "ticker_symbol", "trade_date", "daily_return_pct",
        marts.return_sign("daily_return_pct").alias("direction"))


_AVG_RET = f"""
SELECT *, {_SIGN.format(x='avg_daily_return')} AS direction FROM (
  SELECT ticker_symbol, {xavg('daily_return_pct', 4)} AS avg_daily_return
  FROM star GROUP BY ticker_symbol)"""


@register("ticker_avg_return", _AVG_RET)
def q_ticker_avg_return(spark, sf):
    return marts.avg_return(b.tickers(spark, sf))


@register("sort_mart_rows",
          _AVG_RET + " ORDER BY avg_daily_return DESC NULLS LAST, ticker_symbol")
def q_sort_mart_rows(spark, sf):
    return marts.sort_mart_rows(marts.ticker_avg_return(b.star(spark, sf)),
                                "avg_daily_return", ascending=False)


@register("kpi_period_return", """
SELECT *, CASE WHEN earliest_total <> 0
               THEN (latest_total - earliest_total) / earliest_total * 100.0
               ELSE 0.0 END AS period_return_pct
FROM (SELECT arg_min(portfolio_value, trade_date) AS earliest_total,
             arg_max(portfolio_value, trade_date) AS latest_total
      FROM portfolio_by_date)""")
def q_kpi_period_return(spark, sf):
    return marts.kpi_period_return(b.star(spark, sf))


@register("kpi_day_change", """
SELECT latest_date, latest_total, prev_total,
       CASE WHEN prev_total IS NULL THEN 0.0
            ELSE latest_total - prev_total END AS day_change,
       CASE WHEN prev_total IS NULL THEN 0.0
            WHEN prev_total <> 0
            THEN (latest_total - prev_total) / prev_total * 100.0
            ELSE 0.0 END AS day_change_pct
FROM (SELECT max(trade_date) AS latest_date,
             arg_max(portfolio_value, trade_date) AS latest_total,
             CASE WHEN count(*) = 2 THEN arg_min(portfolio_value, trade_date)
             END AS prev_total
      FROM (SELECT * FROM portfolio_by_date ORDER BY trade_date DESC LIMIT 2))""")
def q_kpi_day_change(spark, sf):
    return marts.kpi_day_change(b.newest_star(spark, sf, 2))


@register("kpi_avg_return",
          f"SELECT {xavg('daily_return_pct', 4)} AS avg_daily_return FROM star")
def q_kpi_avg_return(spark, sf):
    return marts.kpi_avg_return(b.star(spark, sf))


@register("kpi_instruments", """
SELECT count(DISTINCT ticker_symbol) AS n_tickers,
       count(DISTINCT CASE WHEN instrument_type = 'mutual_fund'
                           THEN ticker_symbol END) AS n_funds,
       count(DISTINCT CASE WHEN instrument_type = 'stock'
                           THEN ticker_symbol END) AS n_stocks,
       count(*) AS n_rows
FROM star""")
def q_kpi_instruments(spark, sf):
    return marts.instruments(marts.current_parts(
        b.fact_table(spark, sf), b.dim_stock_table(spark, sf)).select(
            "ticker_symbol", "instrument_type", "n"))


_FRESH = """
SELECT latest_trade, last_processed,
       array_to_string(string_split(last_processed, '')[1:19], '')
         AS last_processed_display
FROM (SELECT max(trade_date) AS latest_trade,
             max(processed_at) AS last_processed FROM priced)"""


@register("freshness", _FRESH)
def q_freshness(spark, sf):
    return marts.freshness(b.fact_table(spark, sf), b.calendar(spark))


@register("staleness_class", f"""
SELECT latest_trade, CAST({_d(AS_OF)} - latest_trade AS INTEGER) AS days_stale,
       CASE WHEN {_d(AS_OF)} - latest_trade <= 1 THEN 'fresh'
            WHEN {_d(AS_OF)} - latest_trade <= 3 THEN 'aging'
            ELSE 'stale' END AS staleness
FROM ({_FRESH})""")
def q_staleness_class(spark, sf):
    return marts.staleness_class(
        marts.freshness(b.fact_table(spark, sf), b.calendar(spark)), AS_OF)


@register("filter_domains", """
SELECT 'instrument_type' AS domain, instrument_type AS value FROM star
WHERE instrument_type IS NOT NULL GROUP BY instrument_type
UNION ALL
SELECT 'sector', sector FROM star WHERE sector IS NOT NULL GROUP BY sector
UNION ALL
SELECT 'ticker_symbol', ticker_symbol FROM star
WHERE ticker_symbol IS NOT NULL GROUP BY ticker_symbol
UNION ALL SELECT 'min_date', CAST(min(trade_date) AS VARCHAR) FROM star
UNION ALL SELECT 'max_date', CAST(max(trade_date) AS VARCHAR) FROM star""")
def q_filter_domains(spark, sf):
    return marts.filter_domains(b.star(spark, sf))


@register("return_histogram", """
SELECT ticker_symbol, bin, lo + bin * ((hi - lo) / 30.0) AS bin_lo,
       CASE WHEN hi = lo THEN hi ELSE lo + (bin + 1) * ((hi - lo) / 30.0) END
         AS bin_hi,
       count(*) AS days
FROM (SELECT s.ticker_symbol, b.lo, b.hi,
             CASE WHEN b.hi - b.lo = 0 THEN 0
                  ELSE least(CAST(floor((s.daily_return_pct - b.lo)
                                        / (b.hi - b.lo) * 30.0) AS INTEGER), 29)
             END AS bin
      FROM star s JOIN (SELECT ticker_symbol, min(daily_return_pct) AS lo,
                               max(daily_return_pct) AS hi
                        FROM star WHERE daily_return_pct IS NOT NULL
                        GROUP BY ticker_symbol) b
        ON s.ticker_symbol = b.ticker_symbol
      WHERE s.daily_return_pct IS NOT NULL)
GROUP BY ticker_symbol, bin, lo, hi""")
def q_return_histogram(spark, sf):
    return marts.return_histogram(b.star(spark, sf))


def _summary_sql() -> str:
    wide = f"""
SELECT ticker_symbol,
       arg_min(close_price, trade_date) AS c1,
       arg_max(close_price, trade_date) AS c2,
       {pct('arg_max(close_price, trade_date)', 'arg_min(close_price, trade_date)')} AS c3,
       {xavg('daily_return_pct', 4)} AS c4,
       max(daily_return_pct) AS c5, min(daily_return_pct) AS c6,
       CAST(count(*) AS DOUBLE) AS c7
FROM star GROUP BY ticker_symbol"""
    parts = [f"SELECT ticker_symbol, '{m}' AS metric, c{i} AS value FROM ({wide})"
             for i, m in enumerate(marts.SUMMARY_METRICS, start=1)]
    return "\nUNION ALL\n".join(parts)


@register("ticker_summary", _summary_sql())
def q_ticker_summary(spark, sf):
    return marts.summary(b.tickers(spark, sf))


@register("scd2_counts", """
SELECT count(*) FILTER (WHERE is_current) AS current_rows, count(*) AS total_rows
FROM dim_stock""")
def q_scd2_counts(spark, sf):
    return scd2_counts(b.dim_stock_table(spark, sf))


@register("profile_nulls", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE \"{c}\" IS NULL) "
    f"AS null_count FROM bronze" for c in BRONZE_COLS))
def q_profile_nulls(spark, sf):
    return quality.profile_nulls(b.bronze_table(spark, sf))


def _describe_sql() -> str:
    parts = []
    for c in NUMERIC_BRONZE:
        x = f'CAST("{c}" AS DOUBLE)'
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(count({x}) AS DOUBLE) AS count, "
            f"{rnd(f'avg({x})', 6)} AS mean, "
            f"{rnd(f'stddev_samp({x})', 6)} AS std, "
            f"min({x}) AS min, "
            f"{rnd(f'quantile_cont({x}, 0.25)', 6)} AS p25, "
            f"{rnd(f'quantile_cont({x}, 0.5)', 6)} AS p50, "
            f"{rnd(f'quantile_cont({x}, 0.75)', 6)} AS p75, "
            f"max({x}) AS max FROM bronze")
    return "\nUNION ALL\n".join(parts)


@register("profile_describe", _describe_sql())
def q_profile_describe(spark, sf):
    return quality.profile_describe(b.bronze_table(spark, sf), digits=6)


_SCHEMA = [("ticker_symbol", "string"), ("Date", "timestamp_ntz"),
           *[(c, "double") for c in ("Open", "High", "Low", "Close")],
           ("Volume", "bigint"), ("l_orderkey", "bigint"),
           ("l_linenumber", "int"), ("l_suppkey", "bigint"),
           *[(c, "string") for c in ("ingested_at", "source_system", "batch_id",
                                     "ingested_date")]]


@register("profile_schema", """
SELECT CAST(p AS INTEGER) AS position, c AS column_name, t AS data_type,
       (SELECT count(*) FROM bronze) AS row_count
FROM (VALUES """ + ", ".join(
    f"({i}, '{c}', '{t}')" for i, (c, t) in enumerate(_SCHEMA)) + """)
  AS v(p, c, t)""")
def q_profile_schema(spark, sf):
    return quality.profile_schema(spark, b.bronze_table(spark, sf))


# == 2.5 windows =================================================================

def _keyed(spark, sf):
    return fct.keyed_prices(b.silver_table(spark, sf),
                            b.dim_stock_table(spark, sf), b.calendar(spark),
                            td.holdings(spark, sf), td.GOLD_PARAMS)


@register("daily_return", """
SELECT stock_key, trade_date, close_price, daily_return_pct FROM priced""")
def q_daily_return(spark, sf):
    return _keyed(spark, sf).select(
        "stock_key", "trade_date", "close_price",
        fct.daily_return().alias("daily_return_pct"))


@register("portfolio_value", """
SELECT stock_key, date_key, close_price, portfolio_value FROM fact""")
def q_portfolio_value(spark, sf):
    return _keyed(spark, sf).select(
        "stock_key", "date_key", "close_price",
        fct.portfolio_value().alias("portfolio_value"))


@register("price_key", "SELECT price_key, date_key, stock_key FROM fact")
def q_price_key(spark, sf):
    return fct.price_key(_keyed(spark, sf).select("date_key", "stock_key"))


@register("fact_prices", "SELECT * FROM fact")
def q_fact_prices(spark, sf):
    return b.fact(spark, sf)


# == 2.6 sort, limit, set operations ============================================

@register("sorted_fact", "SELECT * FROM fact ORDER BY date_key, stock_key")
def q_sorted_fact(spark, sf):
    return fct.sorted_fact(b.fact_table(spark, sf))


@register("star_sample", f"""
SELECT price_key, full_date, ticker_symbol, close_price, daily_return_pct,
       portfolio_value
FROM (SELECT fact.*, strptime(CAST(date_key AS VARCHAR), '%Y%m%d')::DATE
               AS full_date, i.ticker_symbol,
             row_number() OVER (ORDER BY date_key, i.ticker_symbol, price_key)
               AS place
      FROM fact, dim_stock i
      WHERE i.stock_key = fact.stock_key
        AND date_key >= {STAR_SINCE:%Y%m%d})
WHERE place <= 20""")
def q_star_sample(spark, sf):
    return marts.star_sample(b.fact_table(spark, sf, STAR_SINCE), b.calendar(spark),
                             b.dim_stock_table(spark, sf), STAR_SINCE)


@register("dim_listing", """
SELECT * EXCLUDE (part, valid_from, valid_to) FROM scd2_parts""")
def q_dim_listing(spark, sf):
    return b.dim_stock_table(spark, sf).select(
        "stock_key", "ticker_symbol", "fund_name", "sector", "instrument_type",
        "is_current").orderBy("stock_key")


_SPAN = """
SELECT * FROM dim_date
WHERE full_date BETWEEN (SELECT min(trade_date) FROM silver)
                    AND (SELECT max(trade_date) FROM silver)"""


@register("dim_date_slice", f"""
SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day AS full_date,
       CAST(year(day) AS INTEGER) AS year, 'Q' || quarter(day) AS quarter,
       monthname(day) AS month_name, dayname(day) AS day_of_week,
       dayofweek(day) IN (0, 6) AS is_weekend
FROM (SELECT unnest(range({_d(SLICE_START)}, {_d(SLICE_END)} + 1,
                          INTERVAL 1 DAY))::DATE AS day)
WHERE day BETWEEN (SELECT min(trade_date) FROM silver)
              AND (SELECT max(trade_date) FROM silver)""")
def q_dim_date_slice(spark, sf):
    cal = dim_date_span(b.silver_table(spark, sf))
    return (cal.where(F.col("full_date").between(SLICE_START, SLICE_END))
            .select("date_key", "full_date", "year", "quarter", "month_name",
                    "day_of_week", "is_weekend").orderBy("full_date"))


@register("sample_rows", """
SELECT ticker_symbol, "Date", "Close", ingested_at, source_system, batch_id
FROM (SELECT *, row_number() OVER (ORDER BY ticker_symbol, "Date", batch_id,
                l_orderkey, l_linenumber, l_suppkey) AS place FROM bronze)
WHERE place <= 5""")
def q_sample_rows(spark, sf):
    return (b.bronze_table(spark, sf)
            .orderBy("ticker_symbol", "Date", "batch_id", "l_orderkey",
                     "l_linenumber", "l_suppkey").limit(5)
            .select("ticker_symbol", "Date", "Close", "ingested_at",
                    "source_system", "batch_id"))


# == 2.9 calendar =================================================================

@register("dim_date", _SPAN)
def q_dim_date(spark, sf):
    return dim_date_span(b.silver_table(spark, sf))


@register("market_holidays", f"""
SELECT full_date, day_of_week, count(sv.trade_date) AS price_rows
FROM ({_SPAN}) d LEFT JOIN silver sv ON sv.trade_date = d.full_date
WHERE d.is_market_holiday GROUP BY full_date, day_of_week""")
def q_market_holidays(spark, sf):
    s = b.silver_table(spark, sf)
    hol = dim_date_span(s).where("is_market_holiday").select(
        "full_date", "day_of_week")
    rows = s.groupBy(F.col("trade_date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("price_rows"))
    return hol.join(rows, "full_date", "left").select(
        "full_date", "day_of_week",
        F.coalesce(F.col("price_rows"), F.lit(0)).cast("long")
        .alias("price_rows"))
