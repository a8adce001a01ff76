"""Incremental refresh of the fact equals a full one, and reads new days only."""

import pytest
from pyspark.sql import functions as F

from pricelake.operators.fact import fact_increment
from pricelake.plans import pipeline as pl
from pricelake.schemas import DIM_STOCK, STORED_SILVER
from pricelake.sources import sinks
from pricelake.sources.tables import holdings_table
from tests.test_state import HOLD, loaded, params, put  # noqa: F401


def fact(spark, paths):
    return sorted(tuple(r) for r in sinks.gold_table(
        spark, paths.gold, "fact_stock_prices").select(
            "price_key", "date_key", "stock_key", "close_price",
            "daily_return_pct", "portfolio_value", "ingested_at").collect())


def segments(spark, paths):
    return len(sinks.fact_state(spark, paths.gold, sinks.current_version(
        spark, paths.gold))["segments"])


def refresh(spark, paths, hold, day, **options):
    counts = pl.run_gold(spark, hold, params(day), paths, **options)
    rows = fact(spark, paths)
    assert counts["fact_stock_prices"] == len(rows)
    return rows


def day_after(spark, paths, hold, rows, day, **options):
    put(spark, paths, rows, day)
    pl.run_silver(spark, hold, params(day), paths, **options)


def test_new_days_continue_the_fact(spark, loaded):  # noqa: F811
    paths, hold = loaded
    refresh(spark, paths, hold, 12)
    day_after(spark, paths, hold, [("NVDA", 12, 99.0), ("NVDA", 13, 108.9),
                                   ("VFIAX", 13, 55.0)], 13)
    got = refresh(spark, paths, hold, 13)
    assert segments(spark, paths) == 2
    assert [r[:6] for r in got] == [
        (1, 20250310, 1, 100.0, None, 500.0), (2, 20250310, 2, 50.0, None, 100.0),
        (3, 20250311, 1, 110.0, 10.0, 550.0), (4, 20250312, 1, 99.0, -10.0, 495.0),
        (5, 20250313, 1, 108.9, 10.0, 544.5), (6, 20250313, 2, 55.0, 10.0, 110.0)]
    day_after(spark, paths, hold, [("VFIAX", 14, 66.0)], 14)
    third = refresh(spark, paths, hold, 14)
    assert segments(spark, paths) == 3 and third[:6] == got
    # nothing new: the same fact in a new version
    assert refresh(spark, paths, hold, 15) == third
    assert segments(spark, paths) == 3
    assert refresh(spark, paths, hold, 16, full=True) == third
    assert segments(spark, paths) == 1


@pytest.mark.parametrize("case", ["baseline", "sector", "new", "late", "restate"])
def test_other_changes_build_the_fact_anew(spark, loaded, case):  # noqa: F811
    paths, hold = loaded
    refresh(spark, paths, hold, 12)
    cfg = {t: dict(h) for t, h in HOLD.items()}
    rows, options = [("NVDA", 12, 121.0)], {}
    if case == "baseline":
        cfg["NVDA"]["value_usd"] = 1000.0
    if case == "sector":
        cfg["VFIAX"]["sector"] = "Value"
    if case == "new":
        cfg["ZZZ"] = {"name": "z", "value_usd": 1.0, "type": "stock", "sector": "x"}
    if case == "late":
        rows, options = [("VFIAX", 11, 51.0)], {"per_ticker_mark": True}
    if case == "restate":
        options = {"restate": True}
    hold = holdings_table(spark, cfg)
    day_after(spark, paths, hold, rows, 13, **options)
    got = refresh(spark, paths, hold, 13)
    assert segments(spark, paths) == 1 and len(got) == 4
    assert refresh(spark, paths, hold, 14, full=True) == got


def test_only_new_loads_are_read(spark, loaded):  # noqa: F811
    paths, hold = loaded
    refresh(spark, paths, hold, 12)
    before = set(sinks.loads(spark, paths.silver))
    day_after(spark, paths, hold, [("NVDA", 12, 99.0)], 13)
    new = sorted(set(sinks.loads(spark, paths.silver)) - before)
    assert len(before) == len(new) == 1
    layer = spark.read.schema(STORED_SILVER).parquet(paths.silver)
    rows = sinks.of_loads(layer, new)
    assert len(rows.select(F.input_file_name()).distinct().collect()) == 1
    version = sinks.current_version(spark, paths.gold)
    dim = spark.read.schema(DIM_STOCK).parquet(
        sinks.gold_path(paths.gold, version, "dim_stock"))
    cal = sinks.gold_table(spark, paths.gold, "dim_date")
    carry = spark.read.parquet(sinks.gold_path(paths.gold, version, "fact_carry"))
    df = fact_increment(rows, carry, dim, cal, hold, params(13), 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines()
             if "FileScan parquet" in line and "close_price" in line]
    assert scans
    for line in scans:
        if "run_id" in line:
            assert "run_id" in line.split("PartitionFilters: [")[1].split("]")[0]


def test_a_failed_refresh_leaves_the_published_fact(spark, loaded, monkeypatch):  # noqa: F811
    paths, hold = loaded
    rows = refresh(spark, paths, hold, 12)
    day_after(spark, paths, hold, [("NVDA", 12, 99.0)], 13)

    def fail(*args, **kw):
        raise RuntimeError("disk full")
    monkeypatch.setattr(pl, "fact_carry", fail)
    with pytest.raises(RuntimeError):
        pl.run_gold(spark, hold, params(13), paths)
    assert fact(spark, paths) == rows
    monkeypatch.undo()
    assert len(refresh(spark, paths, hold, 13)) == 4
    assert segments(spark, paths) == 2
