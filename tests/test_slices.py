"""Large loads leave little on disk: slices of tickers give the same rows as one
pass, shuffle files and landed drops go, and raw rows are stored once."""

import os
import random

import pytest
from pyspark.sql import functions as F

from pricelake.operators import silver as sv
from pricelake.plans import binding as b
from pricelake.plans import pipeline as pl
from pricelake.session import layer_settings
from pricelake.sources import sinks
from pricelake.sources.tables import holdings_table
from pricelake.streaming.incremental import run_stream
from tests.test_incremental_gold import fact
from tests.test_state import params, put, raw, silver

NAMES = [f"T{i}" for i in range(23)]
HOLD = {t: {"name": t, "value_usd": 100.0, "type": "mutual_fund" if i % 3 else "stock",
            "sector": "s"} for i, t in enumerate(NAMES)}


def rows(n=400):
    """Padded and lower-case copies of a ticker, repeats, bad prices, no ticker."""
    rng = random.Random(3)
    return [(rng.choice([t, f" {t}", t.lower(), t]) if rng.random() < .97 else None,
             rng.randint(1, 11), rng.choice([-1.0, *range(1, 90)]) * 1.0)
            for t in (rng.choice(NAMES) for _ in range(n))]


@pytest.fixture()
def small_slices(monkeypatch):
    def use():
        monkeypatch.setattr(sv, "SLICE_ROWS", 50)
    return use


def audit(spark, paths):
    return sorted(tuple(r) for r in spark.read.parquet(paths.audit).select(
        "layer", "high_water_mark", "rows_in", "rows_out", "invalid_price",
        "invalid_ticker", "duplicates").collect())


@pytest.mark.parametrize("by_ledger", [False, True])
def test_sliced_jobs_give_the_same_rows(spark, tmp_path, monkeypatch, small_slices,
                                        by_ledger):
    hold, got = holdings_table(spark, HOLD), []
    for name in ("whole", "sliced"):
        paths = pl.LakePaths(str(tmp_path / name))
        if name == "sliced":
            small_slices()
        for day in (12, 13) if by_ledger else (12,):
            put(spark, paths, rows()[:400 if day == 13 else 300], day)
            pl.run_silver(spark, hold, params(day), paths, by_ledger=by_ledger)
        pl.run_gold(spark, hold, params(14), paths)
        got.append((silver(spark, paths), fact(spark, paths), audit(spark, paths)))
        loads = sinks.loads(spark, paths.silver)
        assert len(loads) == (2 if by_ledger else 1)
    assert got[0] == got[1]
    # nothing is left beside the tables
    assert not [x for _, dirs, _ in os.walk(paths.root) for x in dirs
                if x.startswith("_") and x not in (
                    "_published", "_audit", "_ledger", "_temporary")]
    assert [r[0] for r in got[1][1]] == list(range(1, len(got[1][1]) + 1))


def test_large_loads_are_cut_and_appear_whole(spark, lake, monkeypatch, small_slices):
    small_slices()
    paths, hold, seen = pl.LakePaths(lake), holdings_table(spark, HOLD), []
    put(spark, paths, rows(), 12)
    whole, write = sv.clean, sinks._move

    def clean(bronze, *a, **k):
        seen.append(bronze.count())
        return whole(bronze, *a, **k)

    def move(*a):
        assert sinks.loads(spark, paths.silver) == []
        assert pl.read_silver(spark, paths).count() == 0
        write(*a)
    monkeypatch.setattr(sv, "clean", clean)
    monkeypatch.setattr(sinks, "_move", move)
    pl.run_silver(spark, hold, params(12), paths)
    assert len(seen) == sv.MAX_SLICES and sum(seen) == 400 and max(seen) < 200
    assert len(sinks.loads(spark, paths.silver)) == 1


def test_sliced_stream(spark, tmp_path, small_slices):
    hold, got = holdings_table(spark, HOLD), []
    for name in ("whole", "sliced"):
        if name == "sliced":
            small_slices()
        paths = pl.LakePaths(str(tmp_path / name))
        source = f"{paths.root}/raw"
        for part, day in ((rows()[:250], 12), (rows()[150:], 13)):
            raw(spark, part, day).write.mode("append").parquet(source)
            run_stream(spark, source, paths.silver, f"{paths.root}/c", hold, params(20))
        run_stream(spark, source, paths.silver, f"{paths.root}/d", hold, params(20))
        got.append(silver(spark, paths))
    assert got[0] == got[1] and len(got[0]) > 100


def test_layers_leave_no_shuffle_files(spark):
    names = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled",
             "spark.sql.parquet.compression.codec")
    before = [spark.conf.get(n, None) for n in names]
    with layer_settings(spark):
        assert [spark.conf.get(n) for n in names] == ["true", "zstd"]
    assert [spark.conf.get(n, None) for n in names] == before
    spark.conf.set(names[1], "gzip")            # the session's own choice stays
    try:
        with layer_settings(spark):
            assert spark.conf.get(names[1]) == "gzip"
    finally:
        spark.conf.unset(names[1])


def test_raw_rows_lie_on_disk_once(spark, tmp_path):
    """The lake's drops go when the raw layer holds them, and the stream's raw rows
    are not stored a second time."""
    spark.createDataFrame(
        [(i, i % 5, 1, 1, 2.0, 10.0 + i, 0.1, 0.1, "ANR"[i % 3], "O")
         for i in range(60)],
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string").withColumn(
        "l_shipdate", F.expr("timestamp_ntz'2000-01-01' + make_dt_interval("
                             "cast(l_orderkey as int))")) \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame(
        [(i, f"n{i}", "t", 45 if i % 2 else 10, 5.0) for i in range(5)],
        "p_partkey long, p_name string, p_type string, p_size int, "
        "p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    sf = str(tmp_path)
    paths = b.lake(spark, sf)
    assert sorted(os.listdir(paths.root)) == ["_audit", "bronze", "gold", "silver"]
    assert pl.read_bronze(spark, paths).count() == 60
    assert b.silver_stream(spark, sf).count() == 60
    assert not [k for k in b._TABLES if k[1] == sf and k[2] in ("bronze", "landing")]


def test_slices_without_valid_rows_are_counted(spark, lake, small_slices):
    """An observation that goes with an empty plan does not fail the load."""
    small_slices()
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    put(spark, paths, [("T1", 1, 5.0)], 12)
    assert pl.run_silver(spark, hold, params(12), paths, by_ledger=True) == 1
    put(spark, paths, [("T2", d % 9 + 1, -1.0) for d in range(120)], 13)
    assert pl.run_silver(spark, hold, params(13), paths, by_ledger=True) == 0
    (last,) = spark.read.parquet(paths.audit).where("rows_in = 120").collect()
    assert (last.rows_out, last.invalid_price, last.invalid_ticker,
            last.duplicates) == (0, 120, 0, 0)
