"""The layers' state survives reruns, failures and odd inputs."""

import datetime as dt
import itertools

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from pricelake.operators import incremental as inc
from pricelake.operators import marts
from pricelake.params import RunParams
from pricelake.plans import pipeline as pl
from pricelake.schemas import BRONZE, STORED_SILVER
from pricelake.sources import sinks
from pricelake.sources.landing import landing_read
from pricelake.sources.tables import holdings_table
from pricelake.streaming.incremental import run_stream

D = dt.date
HOLD = {"NVDA": {"name": "n", "value_usd": 500.0, "type": "stock", "sector": "Tech"},
        "VFIAX": {"name": "v", "value_usd": 100.0, "type": "mutual_fund",
                  "sector": "Blend"}}


def params(day, hour=18):
    return RunParams(run_ts=dt.datetime(2025, 3, day, hour),
                     calendar_start=D(2025, 3, 1), calendar_end=D(2025, 12, 31))


def raw(spark, rows, day):
    """Raw rows (ticker, day of March, close) ingested on ``day``."""
    p = params(day)
    return spark.createDataFrame(
        [(dt.datetime(2025, 3, d), c, c, c, c, 10, t, p.run_iso, "x", p.batch_id,
          p.run_date_iso) for t, d, c in rows], BRONZE)


def put(spark, paths, rows, day):
    raw(spark, rows, day).write.mode("append").partitionBy("ingested_date") \
        .parquet(paths.bronze)


@pytest.fixture()
def loaded(spark, lake):
    paths = pl.LakePaths(lake)
    put(spark, paths, [("NVDA", 10, 100.0), ("VFIAX", 10, 50.0),
                       ("NVDA", 11, 110.0)], 12)
    hold = holdings_table(spark, HOLD)
    assert pl.run_silver(spark, hold, params(12), paths) == 3
    return paths, hold


def silver(spark, paths):
    return sorted((r.ticker_symbol, r.trade_date.day, r.close_price)
                  for r in pl.read_silver(spark, paths).collect())


def test_gold_rerun_with_one_run_time(spark, loaded):
    paths, hold = loaded
    first = pl.run_gold(spark, hold, params(13), paths)
    old = sinks.current_version(spark, paths.gold)
    assert pl.run_gold(spark, hold, params(13), paths) == first
    assert sinks.current_version(spark, paths.gold) != old
    dim = sinks.gold_table(spark, paths.gold, "dim_stock")
    assert dim.count() == 2 and dim.where("is_current").count() == 2
    # the earlier version is still whole
    state = sinks.fact_state(spark, paths.gold, old)
    assert sinks.fact_segments(spark, paths.gold, state["segments"]).count() == 3


def test_publish_order_decides_not_the_run_time(spark, lake):
    sinks.publish(spark, lake, "b", "2025-03-14T00:00:00")
    sinks.publish(spark, lake, "a", "2025-03-13T00:00:00")
    assert sinks.current_version(spark, lake) == "a"


def test_backdated_gold_run_is_refused(spark, loaded):
    paths, hold = loaded
    pl.run_gold(spark, hold, params(14), paths)
    old = sinks.current_version(spark, paths.gold)
    with pytest.raises(ValueError, match="older"):
        pl.run_gold(spark, hold, params(13), paths)
    assert sinks.current_version(spark, paths.gold) == old


def test_failing_gold_run_publishes_nothing(spark, loaded, monkeypatch):
    paths, hold = loaded
    pl.run_gold(spark, hold, params(13), paths)
    old = sinks.current_version(spark, paths.gold)

    def fail(*args, **kw):
        raise RuntimeError("disk full")
    monkeypatch.setattr(pl, "fact_prices", fail)
    with pytest.raises(RuntimeError):
        pl.run_gold(spark, hold, params(14), paths, full=True)
    assert sinks.current_version(spark, paths.gold) == old
    assert sinks.gold_table(spark, paths.gold, "dim_stock").count() == 2


def test_failing_restate_keeps_the_layer(spark, loaded):
    paths, hold = loaded
    before = silver(spark, paths)
    bad = hold.withColumn("instrument_type", F.expr(
        "if(ticker_symbol = 'NVDA', raise_error('boom'), instrument_type)"))
    with pytest.raises(Exception, match="boom"):
        pl.run_silver(spark, bad, params(13), paths, restate=True)
    assert silver(spark, paths) == before


def test_restate_then_incremental(spark, loaded):
    paths, hold = loaded
    put(spark, paths, [("NVDA", 10, 90.0)], 13)         # a restated price
    assert pl.run_silver(spark, hold, params(13), paths) == 0
    assert pl.run_silver(spark, hold, params(13), paths, restate=True) == 3
    assert silver(spark, paths)[0] == ("NVDA", 10, 90.0)
    put(spark, paths, [("NVDA", 14, 120.0)], 14)
    assert pl.run_silver(spark, hold, params(14), paths) == 1
    assert len(silver(spark, paths)) == 4


def test_reprocess_from(spark, loaded):
    paths, hold = loaded
    put(spark, paths, [("NVDA", 10, 1.0), ("NVDA", 11, 111.0),
                       ("VFIAX", 11, 51.0)], 13)
    assert pl.run_silver(spark, hold, params(13), paths,
                         reprocess_from=D(2025, 3, 11)) == 2
    assert silver(spark, paths) == [("NVDA", 10, 100.0), ("NVDA", 11, 111.0),
                                    ("VFIAX", 10, 50.0), ("VFIAX", 11, 51.0)]
    audit = spark.read.parquet(paths.audit).where("layer = 'silver-reprocess'").first()
    assert (audit.rows_in, audit.rows_out, audit.duplicates) == (3, 2, 1)


def test_rerun_of_a_run_replaces_itself(spark, loaded):
    paths, hold = loaded
    assert pl.run_silver(spark, hold, params(12), paths) == 0
    assert len(silver(spark, paths)) == 3


@pytest.mark.parametrize("per_ticker", [False, True])
def test_a_run_time_used_again_keeps_its_rows(spark, loaded, per_ticker):
    paths, hold = loaded
    put(spark, paths, [("NVDA", 12, 120.0), ("VFIAX", 12, 51.0)], 13)
    assert pl.run_silver(spark, hold, params(12), paths,
                         per_ticker_mark=per_ticker) == 2
    assert silver(spark, paths) == [
        ("NVDA", 10, 100.0), ("NVDA", 11, 110.0), ("NVDA", 12, 120.0),
        ("VFIAX", 10, 50.0), ("VFIAX", 12, 51.0)]
    audit = spark.read.parquet(paths.audit).where("layer = 'silver'")
    assert sorted(r.rows_out for r in audit.collect()) == [2, 3]


def test_audit_reads_one_partition(spark, loaded):
    paths, _ = loaded
    layer = spark.read.schema(STORED_SILVER).parquet(paths.silver)
    one = layer.select("processed_date", "run_id").first()
    plan = layer.where((F.col("processed_date") == one[0])
                       & (F.col("run_id") == one[1]))._jdf.queryExecution() \
        .executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "processed_date" in filters and "run_id" in filters
    assert pl._loaded(spark, paths, *one)["n"] == 3


def test_padded_ticker_with_per_ticker_marks(spark, lake):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    put(spark, paths, [(" nvda\t", 10, 100.0), (" nvda\t", 11, 110.0)], 12)
    assert pl.run_silver(spark, hold, params(12), paths, per_ticker_mark=True) == 2
    put(spark, paths, [(" nvda\t", 12, 120.0), ("VFIAX", 9, 50.0)], 13)
    assert pl.run_silver(spark, hold, params(13), paths, per_ticker_mark=True) == 2
    assert silver(spark, paths) == [("NVDA", 10, 100.0), ("NVDA", 11, 110.0),
                                    ("NVDA", 12, 120.0), ("VFIAX", 9, 50.0)]


def test_stream_with_a_new_checkpoint_keeps_earlier_rows(spark, lake):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    p = params(12)

    def load(checkpoint, source):
        run_stream(spark, source, paths.silver, f"{lake}/{checkpoint}", hold, p)
    raw(spark, [("NVDA", 10, 1.0), ("NVDA", 11, 2.0)], 12).write.parquet(f"{lake}/a")
    load("c1", f"{lake}/a")
    raw(spark, [("NVDA", 12, 3.0), ("NVDA", 10, 9.0)], 12).write.parquet(f"{lake}/b")
    load("c2", f"{lake}/b")
    assert silver(spark, paths) == [("NVDA", 10, 1.0), ("NVDA", 11, 2.0),
                                    ("NVDA", 12, 3.0)]


def drop_file(path, stamps):
    df = pd.DataFrame({"Date": pd.to_datetime(stamps), "Close": 1.0, "High": 1.0,
                       "Low": 1.0, "Open": 1.0, "Volume": 1})
    pq.write_table(pa.Table.from_pandas(df), path)


def test_file_uri_drops_are_read_and_skips_recorded(spark, tmp_path, lake):
    drop_file(tmp_path / "NVDA.parquet", ["2025-03-10"])
    drops = {"NVDA": f"file:{tmp_path}/NVDA.parquet",
             "GONE": f"file:{tmp_path}/GONE.parquet"}
    paths = pl.LakePaths(lake)
    assert pl.run_bronze(spark, drops, params(12), paths) is True
    assert pl.read_bronze(spark, paths).count() == 1
    audit = spark.read.parquet(paths.audit).first()
    assert (audit.layer, audit.rows_out) == ("bronze", 1)
    assert audit.note.startswith("GONE: ")


def test_intraday_nanoseconds_are_exact(spark, tmp_path):
    stamps = pd.date_range("2025-03-10 09:30:00.000001", periods=2000,
                           freq="977123us")
    stamps = stamps.append(pd.DatetimeIndex(["1969-12-31 23:59:59.999999"]))
    drop_file(tmp_path / "x.parquet", stamps)
    got = landing_read(spark, {"X": str(tmp_path / "x.parquet")})
    assert sorted(r.Date for r in got.collect()) == \
        sorted(t.to_pydatetime() for t in stamps)


def test_nanosecond_drop_needs_the_setting(spark, tmp_path):
    name = "spark.sql.legacy.parquet.nanosAsLong"
    drop_file(tmp_path / "x.parquet", ["2025-03-10"])
    spark.conf.set(name, "false")
    try:
        with pytest.raises(ValueError, match="nanosAsLong"):
            landing_read(spark, {"X": str(tmp_path / "x.parquet")})
    finally:
        spark.conf.set(name, "true")


def test_dropped_rows_are_audited(spark, lake):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    put(spark, paths, [("NVDA", 10, 1.0), ("NVDA", 10, 2.0), ("NVDA", 11, -1.0),
                       ("  ", 10, 1.0), ("NVDA", 30, 1.0)], 12)
    assert pl.run_silver(spark, hold, params(12), paths) == 1
    a = spark.read.parquet(paths.audit).first()
    assert (a.rows_in, a.rows_out, a.invalid_price, a.future_date,
            a.invalid_ticker, a.duplicates) == (5, 1, 1, 1, 1, 1)


def test_count_check_before_publishing(spark, lake):
    df = spark.range(5).toDF("x")
    path = f"{lake}/t"
    assert sinks.write_checked(df, path) == 5
    with pytest.raises(RuntimeError, match="expected 6"):
        sinks.write_verify(spark, path, 6)


def test_changed_value_stops_the_publish(spark, lake):
    """Equal counts are not enough: the content is held against what was written."""
    df = spark.createDataFrame(
        [(1, 1.5, None, [1, 2], "a"), (2, float("nan"), D(2025, 1, 1), None, "b")],
        "i int, x double, d date, a array<int>, p string")
    assert sinks.write_checked(df, f"{lake}/t", ["p"]) == 2
    n, digest = df.agg(*sinks.content_digest(df.columns)).first()
    assert sinks.write_verify(spark, f"{lake}/t", n, df.schema, digest) == 2
    for i, change in enumerate(("x + 1e-9 as x", "cast(null as double) as x")):
        rest = [c for c in df.columns if c != "x"]
        df.selectExpr(*rest, change).select(*df.columns) \
            .write.parquet(f"{lake}/t{i}")
        with pytest.raises(RuntimeError, match="content"):
            sinks.write_verify(spark, f"{lake}/t{i}", n, df.schema, digest)
    none = df.limit(0)
    assert sinks.write_checked(none, f"{lake}/none") == 0


def test_a_failed_check_publishes_nothing(spark, loaded, monkeypatch):
    paths, hold = loaded
    calls = itertools.count(1)          # as if other values were read back
    monkeypatch.setattr(sinks, "content_digest", lambda columns: [
        F.count(F.lit(1)).alias("n"), F.sum(F.lit(next(calls))).cast(
            "decimal(20,0)").alias("digest")])
    with pytest.raises(RuntimeError, match="content"):
        pl.run_gold(spark, hold, params(13), paths)
    assert sinks.current_version(spark, paths.gold) is None


def test_ledger_brings_in_late_rows(spark, lake):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)

    def load(day):
        return pl.run_silver(spark, hold, params(day), paths, by_ledger=True)
    put(spark, paths, [("NVDA", 11, 1.0), ("VFIAX", 12, 2.0)], 12)
    assert load(12) == 2 and load(12) == 0
    # late rows: one of a new key, one of a known key with another price
    put(spark, paths, [("NVDA", 10, 3.0), ("NVDA", 11, 9.0)], 13)
    assert pl.run_silver(spark, hold, params(13), paths) == 0      # by mark
    assert load(13) == 1
    assert silver(spark, paths) == [("NVDA", 10, 3.0), ("NVDA", 11, 1.0),
                                    ("VFIAX", 12, 2.0)]
    # a partition that grows after its load is read again, others are not
    put(spark, paths, [("VFIAX", 9, 4.0)], 13)
    assert inc.unloaded(sinks.ingests(spark, paths.bronze), sinks.ledger_read(
        spark, paths.ledger)) == ["2025-03-13"]
    assert load(14) == 1 and load(14) == 0
    # rows that are all dropped still count as loaded
    put(spark, paths, [("NVDA", 8, -1.0)], 15)
    assert load(15) == 0
    assert inc.unloaded(sinks.ingests(spark, paths.bronze), sinks.ledger_read(
        spark, paths.ledger)) == []


def test_load_that_failed_before_the_ledger_is_repeated(spark, lake, monkeypatch):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    put(spark, paths, [("NVDA", 11, 1.0)], 12)

    def fail(*a):
        raise OSError("lost")
    with monkeypatch.context() as m:
        m.setattr(sinks, "ledger_commit", fail)
        with pytest.raises(OSError):
            pl.run_silver(spark, hold, params(12), paths, by_ledger=True)
    assert pl.run_silver(spark, hold, params(12), paths, by_ledger=True) == 0
    assert silver(spark, paths) == [("NVDA", 11, 1.0)]


def test_restating_fills_the_ledger(spark, lake):
    paths, hold = pl.LakePaths(lake), holdings_table(spark, HOLD)
    put(spark, paths, [("NVDA", 11, 1.0)], 12)
    put(spark, paths, [("NVDA", 10, 2.0)], 13)
    assert pl.run_silver(spark, hold, params(13), paths, restate=True) == 2
    assert pl.run_silver(spark, hold, params(13), paths, by_ledger=True) == 0


def test_ledger_load_prunes_partitions(spark, lake):
    paths = pl.LakePaths(lake)
    for day in (12, 13, 14):
        put(spark, paths, [("NVDA", day, 1.0)], day)
    new = inc.ledger_load(pl.read_bronze(spark, paths), ["2025-03-13"])
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "ingested_date" in \
        plan.split("PartitionFilters: [")[1].split("]")[0]
    assert [f.split("ingested_date=")[1][:10] for f in new.inputFiles()] == \
        ["2025-03-13"] or new.count() == 1


def test_marts_read_the_published_gold(spark, loaded):
    paths, hold = loaded
    pl.run_gold(spark, hold, params(13), paths)
    star = pl.load_star(spark, paths)
    assert [(r.trade_date.day, r.portfolio_value) for r in
            marts.portfolio_by_date(star).orderBy("trade_date").collect()] == \
        [(10, 600.0), (11, 550.0)]
    assert pl.load_star(spark, paths, D(2025, 3, 11), D(2025, 3, 20)).count() == 1
    shown = pl.sorted_star(star).collect()
    assert [(r.trade_date.day, r.ticker_symbol) for r in shown] == \
        [(10, "NVDA"), (10, "VFIAX"), (11, "NVDA")]
    fresh = pl.load_freshness(spark, paths, D(2025, 3, 13)).first()
    assert (fresh.days_stale, fresh.staleness) == (2, "aging")


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from pricelake import session

    class Conf:
        def get(self, *a):
            return None

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext, conf = Context(), Conf()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
