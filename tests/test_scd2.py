"""SCD2 merge and as-of lookup (FIXTURES 3.3)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators.scd2 import scd2_asof, scd2_merge, first_dimension
from pricelake.params import RunParams
from pricelake.schemas import DIM_STOCK
from pricelake.sources.tables import holdings_table

D = dt.date
SENT = D(9999, 12, 31)
PARAMS = RunParams(run_ts=dt.datetime(2025, 6, 1, 18, 0, 0))


@pytest.fixture()
def prev(spark):
    start = D(2025, 3, 9)
    return spark.createDataFrame([
        (1, "VFIAX", "Vanguard 500 Index Adm", "Large Cap Blend", "mutual_fund",
         start, SENT, True),
        (2, "NVDA", "NVIDIA Corp", "Technology", "stock", start, SENT, True),
        (3, "VGHCX", "Vanguard Health Care", "Health", "mutual_fund", start,
         SENT, True),
    ], DIM_STOCK)


@pytest.fixture()
def incoming(spark):
    return holdings_table(spark, {
        "VFIAX": {"name": "Vanguard 500 Index Adm", "value_usd": 1.0,
                  "type": "mutual_fund", "sector": "Large Cap Blend"},
        "VIMAX": {"name": "Vanguard Mid Cap", "value_usd": 1.0,
                  "type": "mutual_fund", "sector": "Mid Cap"},
        "NVDA": {"name": "NVIDIA Corp", "value_usd": 1.0, "type": "stock",
                 "sector": "Semiconductors"},
    })


def rows(df):
    return sorted((r.stock_key, r.ticker_symbol, r.valid_from, r.valid_to,
                   r.is_current) for r in df.collect())


def test_merge_keep(prev, incoming):
    out = scd2_merge(prev, incoming, PARAMS, on_removed="keep")
    assert rows(out) == [
        (1, "VFIAX", D(2025, 3, 9), SENT, True),
        (2, "NVDA", D(2025, 3, 9), D(2025, 6, 1), False),
        (3, "VGHCX", D(2025, 3, 9), SENT, True),
        (4, "VIMAX", D(2025, 6, 1), SENT, True),
        (5, "NVDA", D(2025, 6, 1), SENT, True),
    ]
    cur = out.where("is_current").groupBy("ticker_symbol").count()
    assert cur.where("count <> 1").isEmpty()


def test_merge_drop_and_close(prev, incoming):
    dropped = scd2_merge(prev, incoming, PARAMS, on_removed="drop")
    assert "VGHCX" not in {r.ticker_symbol for r in dropped.collect()}
    closed = scd2_merge(prev, incoming, PARAMS, on_removed="close")
    v = [r for r in closed.collect() if r.ticker_symbol == "VGHCX"]
    assert [(x.valid_to, x.is_current) for x in v] == [(D(2025, 6, 1), False)]


def test_rerun_same_day_changes_nothing(spark, prev, incoming):
    once = scd2_merge(prev, incoming, PARAMS)
    once = spark.createDataFrame(once.collect(), DIM_STOCK)
    twice = scd2_merge(once, incoming, PARAMS)
    assert rows(once) == rows(twice)


def test_first_run_keys_in_config_order(spark, incoming):
    out = first_dimension(spark, incoming, PARAMS)
    assert [(r.stock_key, r.ticker_symbol) for r in
            out.orderBy("stock_key").collect()] == \
        [(1, "VFIAX"), (2, "VIMAX"), (3, "NVDA")]


def test_asof(spark, prev, incoming):
    dim = scd2_merge(prev, incoming, PARAMS)
    facts = spark.createDataFrame(
        [("NVDA", D(2025, 5, 30)), ("NVDA", D(2025, 6, 1)),
         ("NVDA", D(2025, 3, 1))], "ticker_symbol string, trade_date date")
    got = {r.trade_date: r.stock_key for r in scd2_asof(facts, dim).collect()}
    assert got == {D(2025, 5, 30): 2, D(2025, 6, 1): 5}


def test_no_overlapping_versions(prev, incoming):
    out = scd2_merge(prev, incoming, PARAMS).collect()
    by = {}
    for r in out:
        by.setdefault(r.ticker_symbol, []).append((r.valid_from, r.valid_to))
    for spans in by.values():
        spans.sort()
        for (a, b), (c, d) in zip(spans, spans[1:]):
            assert b <= c


def versions_of(spark, rows):
    """Dimension rows from (key, ticker, from, to) with days of 2025 from 0."""
    day = lambda n: n if isinstance(n, D) else D(2025, 1, 1) + dt.timedelta(n)
    return spark.createDataFrame(
        [(k, t, f"f{k}", "s", "stock", day(a), day(z), day(z) == SENT)
         for k, t, a, z in rows], DIM_STOCK)


@pytest.mark.parametrize("block", [1, 7, 1024])
def test_asof_merge_equals_range_join(spark, block):
    """Gaps, backdated and zero-length versions, many versions, null tickers."""
    rng = random.Random(2)
    rows, key = [], 0
    for t in ("A", "B", "C", "D"):
        at = rng.randint(0, 40)
        for _ in range(50):
            end = at + rng.choice([0, 1, 3, 9])
            key += 1
            rows.append((key, t, at, end))
            at = end + rng.choice([0, 0, 0, 4])          # a gap now and then
        rows.append((key + 1000, t, at, SENT))
    rows.append((5000, None, 0, SENT))
    dim = versions_of(spark, rows)
    prices = spark.createDataFrame(
        [(rng.choice(["A", "B", "C", "D", "E", None]),
          D(2025, 1, 1) + dt.timedelta(rng.randint(0, 400)), float(i))
         for i in range(2000)] + [("A", None, -1.0)],
        "ticker_symbol string, trade_date date, close_price double")
    got = scd2_asof(prices, dim, block_days=block)
    want = prices.alias("p").join(dim.alias("d"), F.expr(
        "p.ticker_symbol = d.ticker_symbol and trade_date >= valid_from "
        "and trade_date < valid_to")).select("p.*", *[
            f"d.{c}" for c in dim.columns if c != "ticker_symbol"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == \
        sorted(map(tuple, want.collect()), key=str)


def test_asof_is_a_merge_not_a_join(spark, prev):
    prices = spark.createDataFrame([("NVDA", D(2025, 5, 1))],
                                   "ticker_symbol string, trade_date date")
    plan = scd2_asof(prices, prev)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" in plan
    assert scd2_asof(prices.limit(0), prev).count() == 0
    assert scd2_asof(prices, prev.limit(0)).count() == 0


def test_history_takes_no_part_in_the_join(spark, prev, incoming):
    old = prev.withColumn("is_current", F.lit(False)) \
        .withColumn("stock_key", F.col("stock_key") + 100)
    with_history = scd2_merge(prev.unionByName(old), incoming, PARAMS)
    got = {r.stock_key for r in with_history.where("not is_current").collect()}
    assert {101, 102, 103} <= got
    plan = with_history._jdf.queryExecution().analyzed().toString()
    assert "FullOuter" in plan and "Union" in plan
