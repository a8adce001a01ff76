"""The three layers built over the driver's test tables.

The builders compose the library operators exactly as the jobs in
``pipeline.py`` do, but read the bound test tables instead of a landing
zone.  As in the reference, layers hand data to each other through stored
tables: ``silver_table``, ``dim_stock_table`` and ``fact_table`` write their
layer once per Spark application into the shared checkpoint folder
(``spark.checkpoint.dir``) and return a Parquet read of it, so downstream
queries get column pruning and filter pushdown and do not recompute the
upstream layers.  The transformation queries themselves (``silver``,
``fact``...) stay lazy and compute from their input layer.
"""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import silver as sv
from pricelake.operators.calendar import dim_date
from pricelake.operators.fact import fact_prices
from pricelake.operators.marts import (fact_between, fact_tickers, newest_fact,
                                       star_join)
from pricelake.operators.scd2 import scd2_merge
from pricelake.plans.pipeline import (LakePaths, fact_frames, run_all,
                                      run_silver)
from pricelake.schemas import BRONZE, LANDING, SILVER_COLS
from pricelake.session import layer_settings, scratch_path
from pricelake.sources import sinks
from pricelake.sources import testdata as td
from pricelake.streaming.incremental import run_stream

SILVER_ORDER = list(sv.DEFAULT_ORDER) + td.TIE_BREAK + ["close_price"]

_LOCK = threading.RLock()
_TABLES: dict[tuple, str] = {}
_SEGMENTS: dict[str, list[str]] = {}     # of a gold layer that is complete


def _path(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """``write(path)`` once per application and sf_dir; where it wrote."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    with _LOCK:
        path = _TABLES.get(key)
        if path is None:
            path = scratch_path(spark, name)
            with layer_settings(spark):
                write(path)
            _TABLES[key] = path
    return path


def _stored(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    return spark.read.parquet(_path(
        spark, sf_dir, name, lambda path: build().write.parquet(path)))


def landing_runs(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    return [td.landing_batch(spark, sf_dir, flag)
            for flag in td.LANDING_FLAGS]


def drops(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """The landing zone: one drop per landing run, as files."""
    def write(path):
        for flag, df in zip(td.LANDING_FLAGS, landing_runs(spark, sf_dir)):
            df.write.parquet(f"{path}/{flag}")
    root = _path(spark, sf_dir, "landing", write)
    return {flag: f"{root}/{flag}" for flag in td.LANDING_FLAGS}


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw layer: the rows of all landing runs, stamped with the metadata of
    their run (one scan)."""
    return td.stamped(spark, sf_dir)


def bronze_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored raw layer."""
    return _stored(spark, sf_dir, "bronze", lambda: bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str,
           reference_order: bool = False) -> DataFrame:
    """The cleaning transformation, computed from the stored raw layer."""
    return sv.clean(bronze_table(spark, sf_dir), td.holdings(spark, sf_dir),
                    td.SILVER_PARAMS, order=SILVER_ORDER,
                    reference_order=reference_order)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored cleaned layer."""
    def write(path):
        raw = bronze_table(spark, sf_dir)
        for rows in sv.clean_slices(raw, td.holdings(spark, sf_dir), td.SILVER_PARAMS,
                                    sv.slice_count(raw), order=SILVER_ORDER):
            rows.write.mode("append").parquet(path)
    return spark.read.parquet(_path(spark, sf_dir, "silver", write))


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned layer produced by the streaming load: each landing run
    arrives, is loaded by the next batch of one query, and at the end a query
    with a new checkpoint reads everything again and must add nothing.  The runs
    are stored once, in the folder that the stream reads."""
    raw = bronze(spark, sf_dir)
    out = scratch_path(spark, "silver-stream")

    def load(checkpoint):
        with layer_settings(spark):
            run_stream(spark, f"{out}/raw", f"{out}/table", f"{out}/{checkpoint}",
                       td.holdings(spark, sf_dir), td.SILVER_PARAMS,
                       schema=raw.schema, order=SILVER_ORDER)
    for i in range(len(td.LANDING_FLAGS)):
        with layer_settings(spark):
            raw.where(F.col("batch_id") == td.landing_params(i).batch_id) \
                .write.mode("append").parquet(f"{out}/raw")
        load("_checkpoint1")
    load("_checkpoint2")
    return spark.read.parquet(f"{out}/table").select(*SILVER_COLS)


def calendar(spark: SparkSession) -> DataFrame:
    p = td.GOLD_PARAMS
    return dim_date(spark, p.calendar_start, p.calendar_end)


def dim_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SCD2 merge transformation of the bound previous state."""
    return scd2_merge(td.dim_stock_prev(spark, sf_dir),
                      td.holdings_next(spark, sf_dir), td.GOLD_PARAMS)


def dim_stock_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "dim_stock", lambda: dim_stock(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str, stored_form: bool = False) -> DataFrame:
    """The fact transformation over the stored cleaned layer and dimensions."""
    return fact_prices(silver_table(spark, sf_dir),
                       dim_stock_table(spark, sf_dir), calendar(spark),
                       td.holdings(spark, sf_dir), td.GOLD_PARAMS, stored_form)


def fact_table(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
               end: dt.date | None = None, months: bool = False) -> DataFrame:
    """The stored fact, in the layout of the gold job, from ``start`` to
    ``end``; with its partition column if ``months``."""
    def write(path):
        for rows in fact_frames(
                silver_table(spark, sf_dir), dim_stock_table(spark, sf_dir),
                calendar(spark), td.holdings(spark, sf_dir), td.GOLD_PARAMS,
                f"{path}-rows"):
            rows.write.mode("append").partitionBy("month_key").parquet(path)
    stored = spark.read.parquet(_path(spark, sf_dir, "fact", write))
    rows = fact_between(stored, start, end)
    return rows if months else rows.drop("month_key")


def star(spark: SparkSession, sf_dir: str, start: dt.date | None = None,
         end: dt.date | None = None) -> DataFrame:
    """The analyst dataset over the stored gold tables."""
    return star_join(fact_table(spark, sf_dir, start, end), calendar(spark),
                     dim_stock_table(spark, sf_dir))


def latest_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analyst dataset of the newest date."""
    return newest_star(spark, sf_dir, 1)


def newest_star(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """The analyst dataset of the newest ``n`` dates."""
    rows = newest_fact(fact_table(spark, sf_dir, months=True), n)
    return star_join(rows, calendar(spark), dim_stock_table(spark, sf_dir))


def tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per ticker, aggregated below the joins."""
    return fact_tickers(fact_table(spark, sf_dir), dim_stock_table(spark, sf_dir))


# -- the jobs, over the drops of the test tables ---------------------------------

def ledger_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A lake whose landing runs, each with days of the whole period, come in
    one after the other and are loaded by ledger; most rows are late."""
    def write(path):
        paths, raw = LakePaths(path), bronze_table(spark, sf_dir)
        for i in range(len(td.LANDING_FLAGS)):
            p = replace(td.landing_params(i), as_of_date=td.GOLD_PARAMS.today)
            raw.where(F.col("batch_id") == p.batch_id).select(*BRONZE.names) \
                .write.mode("append").partitionBy("ingested_date") \
                .parquet(paths.bronze)
            run_silver(spark, td.holdings(spark, sf_dir), p, paths, by_ledger=True)
    return LakePaths(_path(spark, sf_dir, "ledger-lake", write))


def daily_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """A lake loaded twice: the bars up to ``TEST_MARK``, then all newer ones,
    with which the second gold run continues the fact."""
    def write(path):
        paths, cfg = LakePaths(path), td.holdings_config(spark, sf_dir)
        raw = spark.read.parquet(*drops(spark, sf_dir).values())
        late = F.to_date("Date") > F.lit(td.TEST_MARK)
        for i, rows in enumerate((raw.where(~late), raw.where(late))):
            p = replace(td.GOLD_PARAMS, as_of_date=td.GOLD_PARAMS.today,
                        run_ts=td.GOLD_PARAMS.run_ts + dt.timedelta(i))
            rows.write.parquet(f"{path}/drop{i}")
            run_all(spark, {"all": f"{path}/drop{i}"}, cfg, p, paths)
    return LakePaths(_path(spark, sf_dir, "daily-lake", write))


def daily_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact of ``daily_lake``; its state is read once per
    application."""
    gold = daily_lake(spark, sf_dir).gold
    with _LOCK:
        segments = _SEGMENTS.get(gold)
        if segments is None:
            segments = _SEGMENTS[gold] = sinks.fact_state(
                spark, gold, sinks.mart_guard(spark, gold))["segments"]
    if len(segments) != 2:
        raise RuntimeError("the second run did not continue the fact")
    return sinks.fact_segments(spark, gold, segments)


def lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    """All three jobs run once over the stored drops into a fresh lake, whose
    holdings come through ``holdings_table``.  The lake has a landing zone of its
    own, with the provider's columns, which is emptied once its rows are in the raw
    layer."""
    def write(path):
        zone = f"{path}/landing"
        for flag, df in zip(td.LANDING_FLAGS, landing_runs(spark, sf_dir)):
            df.select(*LANDING.names).write.parquet(f"{zone}/{flag}")
        run_all(spark, {flag: f"{zone}/{flag}" for flag in td.LANDING_FLAGS},
                td.holdings_config(spark, sf_dir), td.GOLD_PARAMS, LakePaths(path),
                landed=lambda: sinks.remove(spark, zone))
    return LakePaths(_path(spark, sf_dir, "lake", write))
