"""Sinks, landing reader and the layer jobs end to end (FIXTURES 3.5)."""

import datetime as dt
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricelake.operators.marts import fact_between
from pricelake.params import RunParams
from pricelake.plans import pipeline as pl
from pricelake.sources import sinks
from pricelake.sources.landing import landing_read
from pricelake.sources.tables import holdings_table
from pricelake.streaming.incremental import run_stream

D = dt.date
HOLD = {
    "VFIAX": {"name": "Vanguard 500 Index Adm", "value_usd": 12913.56,
              "type": "mutual_fund", "sector": "Large Cap Blend"},
    "NVDA": {"name": "NVIDIA Corp", "value_usd": 500.0, "type": "stock",
             "sector": "Technology"},
}


def write_drop(path, ticker, days, closes, volume_float=False, drop_row=False):
    """A provider drop as pandas writes it: ns timestamps, maybe an index."""
    df = pd.DataFrame({"Date": pd.to_datetime(days), "Close": closes,
                       "High": closes, "Low": closes, "Open": closes,
                       "Volume": [1000 + i for i in range(len(days))]})
    if volume_float:
        df["Volume"] = df["Volume"].astype(float)
    if drop_row:
        df = df[df["Close"] > 0]
    pq.write_table(pa.Table.from_pandas(df), path)


@pytest.fixture()
def drops(tmp_path):
    d = tmp_path / "landing"
    d.mkdir()
    write_drop(d / "NVDA.parquet", "NVDA",
               ["2025-03-10", "2025-03-11", "2025-03-12"], [100.0, 110.0, -1.0],
               drop_row=True)
    write_drop(d / "VFIAX.parquet", "VFIAX", ["2025-03-10", "2025-03-12"],
               [50.0, 55.0], volume_float=True)
    return {"NVDA": str(d / "NVDA.parquet"), "VFIAX": str(d / "VFIAX.parquet"),
            "MISSING": str(d / "MISSING.parquet")}


def test_landing_reader_absorbs_pandas_quirks(spark, drops):
    df = landing_read(spark, drops, D(2025, 3, 1))
    pdf = sorted((r.ticker_symbol, r.Date.date(), r.Close, r.Volume)
                 for r in df.collect())
    assert pdf == [("NVDA", D(2025, 3, 10), 100.0, 1000),
                   ("NVDA", D(2025, 3, 11), 110.0, 1001),
                   ("VFIAX", D(2025, 3, 10), 50.0, 1000),
                   ("VFIAX", D(2025, 3, 12), 55.0, 1001)]
    assert "__index_level_0__" not in df.columns


def test_landing_reader_fails_when_nothing(spark, tmp_path):
    with pytest.raises(ValueError):
        landing_read(spark, {"X": str(tmp_path / "none.parquet")})


def test_layers_end_to_end(spark, drops, lake):
    paths = pl.LakePaths(lake)
    hold = holdings_table(spark, HOLD)
    p1 = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0),
                   calendar_start=D(2025, 3, 9))
    with pytest.raises(FileNotFoundError):
        sinks.mart_guard(spark, paths.gold)
    assert pl.run_bronze(spark, drops, p1, paths) is True
    # append-once: a second run on the same day is skipped
    assert pl.run_bronze(spark, drops, p1, paths) is False
    assert pl.read_bronze(spark, paths).count() == 4
    assert pl.run_silver(spark, hold, p1, paths) == 4
    assert pl.run_silver(spark, hold, p1, paths) == 0   # nothing new: no write
    counts = pl.run_gold(spark, hold, p1, paths)
    assert counts["fact_stock_prices"] == 4
    assert counts["dim_stock"] == 2
    audit = spark.read.parquet(paths.audit).where("layer = 'silver'").collect()
    assert [(a.layer, a.high_water_mark, a.rows_out) for a in audit] == \
        [("silver", D(2025, 3, 12), 4)]
    fact = sinks.gold_table(spark, paths.gold, "fact_stock_prices")
    assert sorted(r.price_key for r in fact.collect()) == [1, 2, 3, 4]

    # second gold run with changed holdings must be visible (new version)
    hold2 = dict(HOLD)
    hold2["NVDA"] = dict(HOLD["NVDA"], sector="Semiconductors")
    p2 = RunParams(run_ts=dt.datetime(2025, 3, 15, 18, 0, 0),
                   calendar_start=D(2025, 3, 9))
    pl.run_gold(spark, holdings_table(spark, hold2), p2, paths)
    dim = sinks.gold_table(spark, paths.gold, "dim_stock")
    nv = sorted((r.stock_key, r.sector, r.is_current) for r in dim.collect()
                if r.ticker_symbol == "NVDA")
    assert nv == [(2, "Technology", False), (3, "Semiconductors", True)]
    fact2 = sinks.gold_table(spark, paths.gold, "fact_stock_prices")
    assert {r.stock_key for r in fact2.collect()} == {1, 3}


def test_silver_rerun_replaces_own_run_only(spark, lake):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    path = os.path.join(lake, "s")
    sinks.silver_write(df, path, "2025-03-14", "r1")
    sinks.silver_write(df, path, "2025-03-14", "r2")
    sinks.silver_write(df.union(df), path, "2025-03-14", "r1")
    got = spark.read.parquet(path).groupBy("run_id").count().collect()
    assert sorted((r.run_id, r["count"]) for r in got) == [("r1", 2), ("r2", 1)]


def test_missing_snapshot_is_first_run(spark, lake):
    dim = sinks.dim_snapshot_read(spark, os.path.join(lake, "gold"))
    assert dim.isEmpty() and "stock_key" in dim.columns


def test_stream_equals_batch_and_dedups_across_runs(spark, tmp_path):
    from pricelake.schemas import BRONZE
    bronze = str(tmp_path / "bronze")
    silver = str(tmp_path / "silver")
    ckpt = str(tmp_path / "ckpt")
    hold = holdings_table(spark, HOLD)
    params = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0))

    def land(rows, day):
        df = spark.createDataFrame([
            (dt.datetime.combine(d, dt.time()), c, c, c, c, 10, t,
             f"{day}T18:00:00", "yfinance", f"{day}_180000", day)
            for t, d, c in rows], BRONZE)
        df.drop("ingested_date").withColumn("ingested_date", F.lit(day)) \
          .write.mode("append").partitionBy("ingested_date").parquet(bronze)

    land([("NVDA", D(2025, 3, 10), 100.0), ("VFIAX", D(2025, 3, 10), 50.0)],
         "2025-03-10")
    run_stream(spark, bronze, silver, ckpt, hold, params)
    # overlapping second input: one old key again plus one new key
    land([("NVDA", D(2025, 3, 10), 101.0), ("NVDA", D(2025, 3, 11), 110.0)],
         "2025-03-11")
    run_stream(spark, bronze, silver, ckpt, hold, params)
    out = spark.read.parquet(silver)
    keys = out.groupBy("ticker_symbol", "trade_date").count()
    assert keys.where("count > 1").isEmpty()
    got = sorted((r.ticker_symbol, r.trade_date, r.close_price)
                 for r in out.collect())
    assert got == [("NVDA", D(2025, 3, 10), 100.0),
                   ("NVDA", D(2025, 3, 11), 110.0),
                   ("VFIAX", D(2025, 3, 10), 50.0)]


def test_incremental_noop(spark):
    """A load with nothing newer than the mark writes nothing."""
    from pricelake.operators import incremental as inc
    from pricelake.schemas import BRONZE
    bronze = spark.createDataFrame([
        (dt.datetime(2025, 3, 10), 1.0, 1.0, 1.0, 1.0, 1, "NVDA", "i", "s",
         "b", "2025-03-10")], BRONZE)
    silver = spark.createDataFrame([(D(2025, 3, 10),)], "trade_date date")
    mark = inc.mark_value(silver)
    assert mark == D(2025, 3, 10)
    assert not inc.has_rows(inc.incremental_load(bronze, mark))
    assert inc.has_rows(inc.incremental_load(bronze, None))
    assert inc.mark_value(None) is None


def test_per_ticker_mark_takes_late_ticker(spark):
    from pricelake.operators import incremental as inc
    from pricelake.schemas import BRONZE
    rows = [(dt.datetime(2025, 3, 13), "VFIAX"), (dt.datetime(2025, 3, 14), "NVDA")]
    bronze = spark.createDataFrame(
        [(d, 1.0, 1.0, 1.0, 1.0, 1, t, "i", "s", "b", "x") for d, t in rows],
        BRONZE)
    silver = spark.createDataFrame(
        [("VFIAX", D(2025, 3, 12)), ("NVDA", D(2025, 3, 13))],
        "ticker_symbol string, trade_date date")
    glob = inc.incremental_load(bronze, inc.mark_value(silver))
    per = inc.incremental_load_per_ticker(bronze, silver)
    assert [r.ticker_symbol for r in glob.collect()] == ["NVDA"]
    assert sorted(r.ticker_symbol for r in per.collect()) == ["NVDA", "VFIAX"]


def test_empty_result_guard(spark):
    from pricelake.operators import marts
    df = spark.createDataFrame([], "trade_date date, instrument_type string, "
                                   "sector string, ticker_symbol string")
    assert marts.is_empty_result(marts.analyst_filter(df))


def test_profile_schema(spark):
    from pricelake.operators.quality import profile_schema
    df = spark.createDataFrame([(1, "a"), (2, "b")], "x int, y string")
    rows = [(r.column_name, r.data_type, r.row_count)
            for r in profile_schema(spark, df).orderBy("position").collect()]
    assert rows == [("x", "int", 2), ("y", "string", 2)]


def test_gold_fact_is_pruned_by_date(spark, drops, lake):
    paths = pl.LakePaths(lake)
    hold = holdings_table(spark, HOLD)
    p1 = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0),
                   calendar_start=D(2025, 3, 9))
    pl.run_bronze(spark, drops, p1, paths)
    pl.run_silver(spark, hold, p1, paths)
    pl.run_gold(spark, hold, p1, paths)
    fact = sinks.gold_table(spark, paths.gold, "fact_stock_prices")
    one_day = fact_between(fact, D(2025, 3, 11), D(2025, 3, 11))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("],")[0]
    assert "segment" in filters and "isnotnull(month_key" in filters
    assert "GreaterThanOrEqual(date_key,20250311)" in plan
    assert [r.close_price for r in one_day.collect()] == [110.0]


def test_restate_newest_price_wins(spark, lake):
    """D9: a restated (split-adjusted) price replaces the old one."""
    from pricelake.schemas import BRONZE
    paths = pl.LakePaths(lake)
    hold = holdings_table(spark, HOLD)

    def land(close, day):
        df = spark.createDataFrame([
            (dt.datetime(2025, 3, 10), close, close, close, close, 10, "NVDA",
             f"{day}T18:00:00", "yfinance", f"{day}_180000", day)], BRONZE)
        sinks.bronze_append(df.drop("ingested_date"), paths.bronze, day)

    land(100.0, "2025-03-10")
    land(10.0, "2025-03-11")      # restated after a 10:1 split
    p = RunParams(run_ts=dt.datetime(2025, 3, 11, 19, 0, 0))
    assert pl.run_silver(spark, hold, p, paths, restate=True) == 1
    got = [r.close_price for r in pl.read_silver(spark, paths).collect()]
    assert got == [10.0]
    # the default keeps the first copy
    first = spark.createDataFrame(pl.read_bronze(spark, paths).collect(), BRONZE)
    from pricelake.operators import silver as sv
    assert [r.close_price for r in sv.clean(first, hold, p).collect()] == [100.0]


def test_run_all_in_order(spark, drops, lake):
    paths = pl.LakePaths(lake)
    hold = holdings_table(spark, HOLD)
    p = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0),
                  calendar_start=D(2025, 3, 9))
    out = pl.run_all(spark, drops, hold, p, paths, D(2025, 3, 1))
    assert out["bronze_written"] is True
    assert out["silver_rows"] == 4
    assert out["gold"]["fact_stock_prices"] == 4
    assert out["gold"]["dim_date"] == (D(2035, 12, 31) - D(2025, 3, 9)).days + 1


def test_run_all_stops_at_first_failure(spark, tmp_path, lake):
    paths = pl.LakePaths(lake)
    hold = holdings_table(spark, HOLD)
    p = RunParams(run_ts=dt.datetime(2025, 3, 14, 18, 0, 0))
    with pytest.raises(ValueError):
        pl.run_all(spark, {"X": str(tmp_path / "none.parquet")}, hold, p, paths)
    assert pl.read_silver(spark, paths) is None
