"""Cleaned layer on the hand-made rows (FIXTURES 3.1)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelake.operators import silver as sv
from pricelake.params import RunParams
from pricelake.schemas import BRONZE, SILVER_COLS
from pricelake.sources.tables import holdings_table

D = dt.date
NAN = float("nan")
PARAMS = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0),
                   as_of_date=D(2025, 3, 14))

HOLD = {
    "VFIAX": {"name": "Vanguard 500 Index Adm", "value_usd": 12913.56,
              "type": "mutual_fund", "sector": "Large Cap Blend"},
    "NVDA": {"name": "NVIDIA Corp", "value_usd": 500.0, "type": "stock",
             "sector": "Technology"},
}

ROWS = [  # ticker, date, close, batch
    ("NVDA", D(2025, 3, 10), 100.0, "b1"),
    ("NVDA", D(2025, 3, 10), 100.5, "b2"),
    (" nvda\t", D(2025, 3, 11), 110.0, "b1"),
    ("VFIAX", D(2025, 3, 10), 50.0, "b1"),
    ("VFIAX", D(2025, 3, 11), NAN, "b1"),
    ("VFIAX", D(2025, 3, 12), -1.0, "b1"),
    ("VFIAX", D(2025, 3, 12), 55.0, "b2"),
    (None, D(2025, 3, 10), 10.0, "b1"),
    ("", D(2025, 3, 10), 10.0, "b1"),
    ("NVDA", D(2025, 3, 15), 120.0, "b1"),
    ("ZZZZ", D(2025, 3, 10), 5.0, "b1"),
    ("NVDA", D(2025, 3, 13), 99.0, "b1"),
]


def bronze_rows(rows):
    out = []
    for t, d, c, b in rows:
        ts = dt.datetime.combine(d, dt.time())
        ing = "2025-03-14T18:00:00" if b == "b1" else "2025-03-14T19:00:00"
        out.append((ts, c, c, c, c, 1000, t, ing, "yfinance", b, "2025-03-14"))
    return out


@pytest.fixture()
def bronze(spark):
    return spark.createDataFrame(bronze_rows(ROWS), BRONZE)


@pytest.fixture()
def holdings(spark):
    return holdings_table(spark, HOLD)


def test_clean_keeps_expected_rows(bronze, holdings):
    out = sv.clean(bronze, holdings, PARAMS)
    assert out.columns == SILVER_COLS
    got = {(r.ticker_symbol, r.trade_date): r for r in out.collect()}
    assert set(got) == {("NVDA", D(2025, 3, 10)), ("NVDA", D(2025, 3, 11)),
                        ("VFIAX", D(2025, 3, 10)), ("VFIAX", D(2025, 3, 12)),
                        ("ZZZZ", D(2025, 3, 10)), ("NVDA", D(2025, 3, 13))}
    # first by ingest order wins
    assert got[("NVDA", D(2025, 3, 10))].close_price == 100.0
    # cleaned ticker is looked up: stock
    assert got[("NVDA", D(2025, 3, 11))].instrument_type == "stock"
    fund = got[("VFIAX", D(2025, 3, 10))]
    assert fund.instrument_type == "mutual_fund"
    assert (fund.open_price, fund.high_price, fund.low_price, fund.volume) == \
        (None, None, None, None)
    unknown = got[("ZZZZ", D(2025, 3, 10))]
    assert unknown.instrument_type is None and unknown.volume == 1000
    assert got[("VFIAX", D(2025, 3, 12))].close_price == 55.0
    assert fund.processed_at == "2025-03-14T18:00:00"
    assert fund.silver_batch_id == "2025-03-14_180000"


def test_reference_order_loses_valid_duplicate(bronze, holdings):
    out = sv.clean(bronze, holdings, PARAMS, reference_order=True)
    keys = {(r.ticker_symbol, r.trade_date) for r in out.collect()}
    assert ("VFIAX", D(2025, 3, 12)) not in keys
    assert len(keys) == 5


def test_validate_counts(bronze, holdings):
    c = sv.validate_counts(sv.prepare(bronze, holdings), PARAMS.today).first()
    assert c.rows_in == 12
    assert c.invalid_price == 2
    assert c.future_date == 1
    assert c.invalid_ticker == 2
    assert c.rows_valid == 7
    assert c.rows_out == 6
    assert c.duplicates == 1


def test_strip_matches_python(spark):
    from pricelake.functions.text import py_strip
    vals = [" a ", "\tb\n", " c ", "d", "", None, "\x1ce\x1f"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(py_strip("v")).collect()]
    assert got == [None if v is None else v.strip() for v in vals]


def test_dedup_skewed_key_is_deterministic(spark):
    # one key holds most rows; the survivor is the minimum of the order
    rows = [("HOT", D(2025, 1, 1), float(i), f"b{i % 7}", i) for i in range(5000)]
    rows += [("COLD", D(2025, 1, 1), 1.0, "b0", 0)]
    df = spark.createDataFrame(
        rows, "ticker_symbol string, trade_date date, close_price double, "
              "batch_id string, seq int").repartition(8)
    out = sv.dedup_first(df, ["ticker_symbol", "trade_date"],
                         ["batch_id", "seq"])
    got = {r.ticker_symbol: (r.batch_id, r.seq) for r in out.collect()}
    assert got == {"HOT": ("b0", 0), "COLD": ("b0", 0)}


def test_dedup_heavy_and_light_keys_agree(spark):
    """Light keys are not sorted before their shuffle; heavy ones combine in the
    map tasks; both give the same rows, and equal columns travel once."""
    rows = [(f"T{i % 11 if i % 3 else 0}", D(2025, 1, 1 + i % 2), float(i % 13),
             f"b{i % 5}", i) for i in range(4000)]
    df = spark.createDataFrame(
        rows, "ticker_symbol string, trade_date date, close_price double, "
              "batch_id string, seq int").repartition(6)
    want = {}
    for t, d, c, bt, q in rows:
        want[t, d] = min(want.get((t, d), (bt, c, q)), (bt, c, q))
    for heavy in (1 << 20, 500, 0):
        out = sv.dedup_first(df, sv.KEY, ["batch_id"], heavy_rows=heavy)
        got = {(r.ticker_symbol, r.trade_date): (r.batch_id, r.close_price, r.seq)
               for r in out.collect()}
        assert got == want and out.count() == len(want)
    p = sv.dedup_first(df, sv.KEY, ["batch_id"])._jdf.queryExecution() \
        .executedPlan().toString()
    light = p[p.index("SortAggregate"):]
    assert light.index("partial_min") < light.index("REPARTITION_BY_COL")
    assert "__o0" not in p
