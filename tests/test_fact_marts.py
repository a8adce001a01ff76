"""Fact and marts on hand-made rows (FIXTURES 3.2)."""

import datetime as dt

import pytest

from pricelake.operators import marts
from pricelake.operators.calendar import dim_date
from pricelake.operators.fact import fact_prices
from pricelake.params import RunParams
from pricelake.schemas import DIM_STOCK, SILVER

D = dt.date
PARAMS = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0),
                   as_of_date=D(2025, 3, 14), calendar_start=D(2025, 3, 9))
SENT = D(9999, 12, 31)


@pytest.fixture()
def gold(spark):
    silver = spark.createDataFrame([
        (D(2025, 3, 10), 50.0, None, None, None, None, "mutual_fund", "VFIAX",
         "i1", "yfinance", "b1", "2025-03-14", "p1", "s1"),
        (D(2025, 3, 10), 100.0, 1.0, 1.0, 1.0, 10, "stock", "NVDA",
         "i1", "yfinance", "b1", "2025-03-14", "p1", "s1"),
        (D(2025, 3, 11), 110.0, 1.0, 1.0, 1.0, 10, "stock", "NVDA",
         "i1", "yfinance", "b1", "2025-03-14", "p1", "s1"),
        (D(2025, 3, 12), 55.0, None, None, None, None, "mutual_fund", "VFIAX",
         "i1", "yfinance", "b2", "2025-03-14", "p1", "s1"),
        (D(2025, 3, 13), 99.0, 1.0, 1.0, 1.0, 10, "stock", "NVDA",
         "i1", "yfinance", "b1", "2025-03-14", "p2", "s1"),
        (D(2025, 3, 10), 5.0, 1.0, 1.0, 1.0, 10, None, "ZZZZ",
         "i1", "yfinance", "b1", "2025-03-14", "p1", "s1"),
    ], SILVER)
    dim = spark.createDataFrame([
        (1, "VFIAX", "Vanguard 500 Index Adm", "Large Cap Blend", "mutual_fund",
         D(2025, 3, 9), SENT, True),
        (11, "NVDA", "NVIDIA Corp", "Technology", "stock", D(2025, 3, 9), SENT,
         True),
    ], DIM_STOCK)
    hold = spark.createDataFrame(
        [("VFIAX", 12913.56), ("NVDA", 500.0)],
        "ticker_symbol string, baseline_value_usd double")
    cal = dim_date(spark, PARAMS.calendar_start, PARAMS.calendar_end)
    fact = fact_prices(silver, dim, cal, hold, PARAMS)
    star = marts.star_join(fact, cal, dim)
    return fact, star, cal, dim


def test_fact_rows(gold):
    fact, *_ = gold
    rows = sorted((r.price_key, r.date_key, r.stock_key, r.close_price,
                   r.daily_return_pct, r.portfolio_value)
                  for r in fact.collect())
    assert rows == [
        (1, 20250310, 1, 50.0, None, 12913.56),
        (2, 20250310, 11, 100.0, None, 500.0),
        (3, 20250311, 11, 110.0, 10.0, 550.0),
        (4, 20250312, 1, 55.0, 10.0, 14204.92),
        (5, 20250313, 11, 99.0, -10.0, 495.0),
    ]


def test_marts(gold):
    _, star, cal, dim = gold
    pbd = {r.trade_date: r.portfolio_value
           for r in marts.portfolio_by_date(star).collect()}
    assert pbd == {D(2025, 3, 10): 13413.56, D(2025, 3, 11): 550.0,
                   D(2025, 3, 12): 14204.92, D(2025, 3, 13): 495.0}
    dc = marts.kpi_day_change(star).first()
    assert dc.day_change == pytest.approx(-13709.92)
    avg = marts.kpi_avg_return(star).first().avg_daily_return
    assert round(avg, 4) == 3.3333
    tr = {r.ticker_symbol: r.total_return_pct
          for r in marts.ticker_total_return(star).collect()}
    assert tr == {"VFIAX": 10.0, "NVDA": -1.0}
    alloc = marts.sector_share(marts.latest_slice(star)).collect()
    assert [(r.sector, r.value, r.share_pct) for r in alloc] == \
        [("Technology", 495.0, 100.0)]
    k = marts.kpi_instruments(star).first()
    assert (k.n_tickers, k.n_funds, k.n_stocks, k.n_rows) == (2, 1, 1, 5)
    pr = marts.kpi_period_return(star).first()
    assert pr.period_return_pct == pytest.approx(
        (495.0 - 13413.56) / 13413.56 * 100)


def test_analyst_filter_and_empty_guard(gold):
    _, star, *_ = gold
    only = marts.analyst_filter(star, D(2025, 3, 11), D(2025, 3, 12),
                                tickers=["NVDA"])
    assert [r.trade_date for r in only.collect()] == [D(2025, 3, 11)]
    none = marts.analyst_filter(star, types=[])
    assert marts.is_empty_result(none)


def test_histogram_and_summary(gold):
    _, star, *_ = gold
    h = {(r.ticker_symbol, r.bin): r.days
         for r in marts.return_histogram(star).collect()}
    # NVDA returns 10 and -10: min in bin 0, max in the last bin
    assert h == {("NVDA", 0): 1, ("NVDA", 29): 1, ("VFIAX", 0): 1}
    s = {(r.ticker_symbol, r.metric): r.value
         for r in marts.ticker_summary(star).collect()}
    assert s[("NVDA", "First Close")] == 100.0
    assert s[("NVDA", "Latest Close")] == 99.0
    assert s[("NVDA", "Trading Days")] == 3.0
    assert s[("NVDA", "Best Day")] == 10.0
    hist = marts.ticker_history(star, "NVDA").collect()
    assert [r.type_label for r in hist] == ["Stock"] * 3


def test_star_join_plan_broadcasts(gold):
    _, star, *_ = gold
    plan = star._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
