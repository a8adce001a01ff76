"""The runnable jobs: raw, cleaned and gold layers, and all three in order.

One Spark application runs the layers in order and stops at the first
failure (an exception propagates).  Usable under ``spark-submit``:

    spark-submit pricelake/plans/pipeline.py <lake_root> <holdings.json> \
        <drops_dir> [run_ts]

Each job takes the run parameters explicitly; nothing reads the clock
inside a transformation.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricelake.operators import incremental as inc
from pricelake.operators import marts
from pricelake.operators import silver as sv
from pricelake.operators.calendar import dim_date
from pricelake.operators.fact import (carry_basis, fact_carry,
                                      fact_increment, fact_offsets, fact_prices,
                                      keyed_prices, same_basis, stored_fact,
                                      with_measures)
from pricelake.operators.scd2 import scd2_merge
from pricelake.params import RunParams
from pricelake.schemas import (BRONZE, DIM_STOCK, SILVER, SILVER_COLS,
                               STORED_SILVER)
from pricelake.sources import sinks
from pricelake.sources.landing import (NANOS_SETTING, bronze_metadata,
                                       landing_read)
from pricelake.sources.tables import holdings_table


@dataclass(frozen=True)
class LakePaths:
    root: str

    @property
    def bronze(self) -> str:
        return f"{self.root.rstrip('/')}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root.rstrip('/')}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root.rstrip('/')}/gold"

    @property
    def audit(self) -> str:
        return f"{self.root.rstrip('/')}/_audit"

    @property
    def ledger(self) -> str:
        return f"{self.root.rstrip('/')}/_ledger"


def read_bronze(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    return sinks.read_if_exists(spark, paths.bronze, BRONZE)


def read_silver(spark: SparkSession, paths: LakePaths) -> DataFrame | None:
    df = sinks.read_if_exists(spark, sinks.layer_path(spark, paths.silver),
                              SILVER)
    return None if df is None else df.select(*SILVER_COLS)


def run_bronze(spark: SparkSession, drops: dict[str, str], params: RunParams,
               paths: LakePaths, start_date: dt.date | None = None) -> bool:
    """landing -> metadata -> append-once -> audit.  Returns whether rows were
    written; the audit row names the instruments that were skipped."""
    skipped: list[tuple[str, str]] = []
    df = bronze_metadata(landing_read(spark, drops, start_date, skipped), params)
    seen = Observation()
    rows = df.drop("ingested_date").observe(seen, F.count(F.lit(1)).alias("n"))
    wrote = sinks.bronze_append(rows, paths.bronze, params.run_date_iso)
    n = seen.get["n"] if wrote else 0
    sinks.watermark_commit(
        spark, paths.audit, params.batch_id, "bronze", None, n, n,
        params.run_iso, note="; ".join(f"{t}: {why}" for t, why in skipped) or None)
    return wrote


def _dropped(seen: list[Observation], raw: list[DataFrame], holdings: DataFrame,
             params: RunParams, rows_out: int) -> tuple[int, dict[str, int]]:
    """What the writes saw of the ``raw`` rows: rows in, rows dropped.  Where no row
    was left, AQE may have dropped the observation with the plan below; then the
    rows are counted here."""
    parts = []
    for s, rows in zip(seen, raw):
        try:
            parts.append(s.get)
        except Py4JJavaError:
            parts.append(sv.rule_counts(rows, holdings, params).first().asDict())
    got = {k: sum(p[k] for p in parts) for k in parts[0]}
    return got["rows_in"], {
        **{k: got[k] for k in ("invalid_price", "future_date",
                               "invalid_ticker")},
        "duplicates": got["rows_valid"] - rows_out}


def run_silver(spark: SparkSession, holdings: DataFrame, params: RunParams,
               paths: LakePaths, per_ticker_mark: bool = False,
               reference_order: bool = False, restate: bool = False,
               reprocess_from: dt.date | None = None,
               by_ledger: bool = False) -> int:
    """mark -> incremental load -> clean -> write -> audit.

    Returns the rows written (0 when there was nothing new: no write).  Every
    load writes a partition of its own, so a run time may be used again: its
    second load takes what came in since and leaves the first one's rows.
    ``restate`` rebuilds the layer from every raw row with the newest copy
    of each (ticker, date) winning, so restated adjusted prices replace old
    ones.  ``reprocess_from`` does so for the days from that date on and keeps
    the earlier rows as they are.  Both publish a new version of the layer.
    ``by_ledger`` loads the raw partitions that no load by ledger (or
    ``restate``) has read, whatever their trade dates, and adds the rows whose
    key is new: late rows come in, and the mark is not used.
    """
    bronze = read_bronze(spark, paths)
    if bronze is None:
        raise FileNotFoundError(f"no raw layer at {paths.bronze}")
    present = sinks.ingests(spark, paths.bronze) if restate or by_ledger else {}
    if restate or reprocess_from is not None:
        n = _rebuild_silver(spark, bronze, holdings, params, paths,
                            None if restate else reprocess_from)
        if restate:
            _record(spark, paths, present, params)
        return n
    silver = read_silver(spark, paths)
    if by_ledger:
        dates = inc.unloaded(present, sinks.ledger_read(spark, paths.ledger))
        present = {d: present[d] for d in dates}
        new = inc.ledger_load(bronze, dates)
    elif per_ticker_mark and silver is not None:
        new = inc.incremental_load_per_ticker(bronze, silver)
    else:
        new = inc.incremental_load(bronze, inc.mark_value(silver))
    if not inc.has_rows(new):
        _record(spark, paths, present, params)
        return 0
    n = sv.slice_count(new)
    seen = [Observation() for _ in range(n)]
    frames = sv.clean_slices(new, holdings, params, n, seen,
                             reference_order=reference_order)
    if (per_ticker_mark or by_ledger) and silver is not None:
        frames = [inc.new_keys(cleaned, new, known, sv.KEY)
                  for cleaned, known in zip(frames, sv.slices(silver, n))]
    attempt = sinks.new_version(params.run_ts)
    sinks.silver_write(frames, paths.silver, params.run_date_iso, attempt)
    stats = _loaded(spark, paths, params.run_date_iso, attempt)
    rows_in, dropped = _dropped(seen, sv.slices(new, n, raw=True), holdings, params,
                                stats["n"])
    sinks.watermark_commit(spark, paths.audit, params.batch_id, "silver",
                           stats["m"], rows_in, stats["n"], params.run_iso,
                           dropped)
    _record(spark, paths, present, params)
    return stats["n"]


def _record(spark: SparkSession, paths: LakePaths, loaded: dict,
            params: RunParams) -> None:
    if loaded:
        sinks.ledger_commit(spark, paths.ledger, loaded, params.batch_id,
                            params.run_iso)


def _loaded(spark: SparkSession, paths: LakePaths, processed_date: str,
            run_id: str):
    """Rows and newest date of one load: only its own partition is read."""
    layer = sinks.read_if_exists(spark, sinks.layer_path(spark, paths.silver),
                                 STORED_SILVER)
    return layer.where((F.col("processed_date") == processed_date)
                       & (F.col("run_id") == run_id)).agg(
        F.count(F.lit(1)).alias("n"), F.max("trade_date").alias("m")).first()


def _rebuild_silver(spark, bronze: DataFrame, holdings: DataFrame,
                    params: RunParams, paths: LakePaths,
                    since: dt.date | None) -> int:
    """A new version of the layer with the days from ``since`` on (all, if
    None) cleaned again.  Returns the rows cleaned."""
    kept, layer = None, "silver-restate"
    if since is not None:
        layer = "silver-reprocess"
        bronze = bronze.where(F.to_date("Date") >= F.lit(since))
        old = sinks.read_if_exists(
            spark, sinks.layer_path(spark, paths.silver))
        if old is not None:
            kept = old.where(F.col("trade_date") < F.lit(since)) \
                .withColumn("processed_date", F.col("processed_date").cast("string"))
    seen = Observation()
    cleaned = sv.clean(bronze, holdings, params, keep="last", seen=seen)
    attempt = sinks.new_version(params.run_ts)
    sinks.silver_replace(cleaned, paths.silver, params.run_ts,
                         params.run_date_iso, attempt, kept)
    stats = _loaded(spark, paths, params.run_date_iso, attempt)
    rows_in, dropped = _dropped([seen], [bronze], holdings, params, stats["n"])
    sinks.watermark_commit(spark, paths.audit, params.batch_id, layer,
                           stats["m"], rows_in, stats["n"], params.run_iso,
                           dropped)
    return stats["n"]


def _new_prices(spark: SparkSession, paths: LakePaths, layer: str,
                names: list[str], state, carry: DataFrame, basis: DataFrame,
                params: RunParams) -> DataFrame | None:
    """Cleaned rows that the fact lacks, if it can be continued with them: the
    layer has only grown, by days newer than the fact's, and no instrument has
    another key or baseline value or is new.  Else ``None``."""
    if (state["layer"], state["calendar_start"], state["calendar_end"]) != (
            layer, params.calendar_start, params.calendar_end):
        return None
    fresh = sorted(set(names) - set(state["loads"]))
    if set(state["loads"]) - set(names) or not same_basis(basis, carry):
        return None
    new = sinks.of_loads(spark.read.schema(STORED_SILVER).parquet(layer), fresh)
    first = new.agg(F.min("trade_date")).first()[0]
    if first is not None and state["last_date_key"] is not None \
            and int(f"{first:%Y%m%d}") <= state["last_date_key"]:
        return None
    return new.select(*SILVER_COLS)


def fact_frames(silver: DataFrame, dim: DataFrame, cal: DataFrame,
                holdings: DataFrame, params: RunParams, scratch: str,
                ) -> Iterator[DataFrame]:
    """The whole fact in its stored form, in frames to be written one after the
    other.  A large one has its measures taken slice by slice of the tickers, into
    ``scratch``, and is numbered and laid out from there, some months at a time: at
    no time do shuffle files of all rows lie on disk.  The rows are the same."""
    spark, n = silver.sparkSession, sv.slice_count(silver)
    if n == 1:
        yield fact_prices(silver, dim, cal, holdings, params, stored_form=True)
        return
    for part in sv.slices(silver, n):
        with_measures(keyed_prices(part, dim, cal, holdings, params)) \
            .drop("trade_date").write.mode("append").parquet(f"{scratch}/rows")
    rows = spark.read.parquet(f"{scratch}/rows")
    fact_offsets(rows).write.parquet(f"{scratch}/offsets")
    offsets = spark.read.parquet(f"{scratch}/offsets")
    month = F.floor(F.col("date_key") / 100)
    sizes = rows.groupBy(month.alias("m")).count().orderBy("m").collect()
    groups, room = [], 0                    # a row per month: bounded
    for m, size in sizes:
        if room < size:
            groups.append([])
            room = max(size, -(-sum(s for _, s in sizes) // n))
        groups[-1].append(m)
        room -= size
    for months in groups or [[]]:
        some = rows.where(month.between(months[0], months[-1])) if months else rows
        yield stored_fact(some, offsets=offsets)
    sinks.remove(spark, scratch)


def refresh_fact(spark: SparkSession, holdings: DataFrame, params: RunParams,
                 paths: LakePaths, version: str, dim: DataFrame, cal: DataFrame,
                 since: str | None = None) -> int:
    """Write the fact of ``version``: a new segment of new days that continues
    the fact of version ``since``, or of everything.  With it go the carry
    table and the state that the next refresh starts from.  Returns the rows."""
    layer = sinks.layer_path(spark, paths.silver)
    names = sinks.loads(spark, layer)
    basis = carry_basis(dim, holdings)
    state = carry = new = None
    if since is not None:
        state = sinks.fact_state(spark, paths.gold, since)
        carry = spark.read.parquet(sinks.gold_path(paths.gold, since, "fact_carry"))
        new = _new_prices(spark, paths, layer, names, state, carry, basis, params)
    if new is None:
        state = carry = None
        fact = fact_frames(read_silver(spark, paths), dim, cal, holdings, params,
                           f"{paths.gold}/_rows-{version}")
    else:
        fact = fact_increment(new, carry, dim, cal, holdings, params,
                              state["last_key"], stored_form=True)
    at = sinks.segment_path(paths.gold, version)
    n = sinks.write_checked(fact, at, ["month_key"])
    rows = sinks.fact_segments(spark, paths.gold, [version])
    last = rows.agg(F.max("date_key")).first()[0] if n else None
    before = state["rows"] if state else 0
    sinks.gold_write({
        "fact_carry": fact_carry(basis, rows, carry),
        "fact_state": spark.createDataFrame([(
            [*(state["segments"] if state else ()), *([version] if n else ())],
            before + n, before + n,
            last if n or not state else state["last_date_key"], layer, names,
            params.calendar_start, params.calendar_end)],
            sinks.FACT_STATE).coalesce(1)}, paths.gold, version)
    return before + n


def run_gold(spark: SparkSession, holdings: DataFrame, params: RunParams,
             paths: LakePaths, full: bool = False) -> dict[str, int]:
    """Dimensions before facts; every table is checked against the rows that
    were written, and the new version is published last.

    The dimension is written first and the fact is built from the stored
    dimension, so the fact's keys are exactly the published keys.  Where only
    newer days came in, the fact is continued with them alone; otherwise, or
    if ``full``, it is built anew (``refresh_fact``); the rows are the same.  A run
    dated before the published one is refused: it would write history that
    ends before it begins.
    """
    silver = read_silver(spark, paths)
    if silver is None:
        raise FileNotFoundError(f"no cleaned layer at {paths.silver}")
    last = sinks.published(spark, paths.gold)
    if last is not None and params.run_iso < last["run_ts"]:
        raise ValueError(f"run of {params.run_iso} is older than the published "
                         f"one of {last['run_ts']}")
    version = sinks.new_version(params.run_ts)
    prev = sinks.dim_snapshot_read(spark, paths.gold)
    cal = dim_date(spark, params.calendar_start, params.calendar_end)
    counts = sinks.gold_write({"dim_stock": scd2_merge(prev, holdings, params),
                               "dim_date": cal}, paths.gold, version)
    dim = spark.read.schema(DIM_STOCK).parquet(
        sinks.gold_path(paths.gold, version, "dim_stock"))
    counts["fact_stock_prices"] = refresh_fact(
        spark, holdings, params, paths, version, dim, cal,
        None if full or last is None else last["version"])
    sinks.publish(spark, paths.gold, version, params.run_iso)
    sinks.watermark_commit(spark, paths.audit, params.batch_id, "gold", None,
                           None, counts["fact_stock_prices"], params.run_iso,
                           note=version)
    return counts


def load_star(spark: SparkSession, paths: LakePaths,
              start: dt.date | None = None,
              end: dt.date | None = None) -> DataFrame:
    """The analyst dataset over the published gold tables, from ``start`` to
    ``end``: the input of every mart.  Unsorted; ``sorted_star`` is the form
    to show."""
    table = lambda name: sinks.gold_table(spark, paths.gold, name)
    return marts.star_join(
        marts.fact_between(table("fact_stock_prices"), start, end),
        table("dim_date"), table("dim_stock"))


def sorted_star(star: DataFrame) -> DataFrame:
    return star.orderBy("trade_date", "ticker_symbol")


def load_freshness(spark: SparkSession, paths: LakePaths,
                   as_of: dt.date) -> DataFrame:
    """How old the published gold layer is."""
    fresh = marts.freshness(
        sinks.gold_table(spark, paths.gold, "fact_stock_prices"),
        sinks.gold_table(spark, paths.gold, "dim_date"))
    return marts.staleness_class(fresh, as_of)


def run_all(spark: SparkSession, drops: dict[str, str], holdings: DataFrame,
            params: RunParams, paths: LakePaths,
            start_date: dt.date | None = None,
            landed: Callable[[], None] | None = None) -> dict:
    """bronze >> silver >> gold; the first failure stops the run.  ``landed`` is
    called when the raw layer holds the drops (to empty the landing zone)."""
    wrote = run_bronze(spark, drops, params, paths, start_date)
    if landed is not None and wrote:
        landed()
    rows = run_silver(spark, holdings, params, paths)
    counts = run_gold(spark, holdings, params, paths)
    return {"bronze_written": wrote, "silver_rows": rows, "gold": counts}


def main(argv: list[str]) -> int:
    root, holdings_json, drops_dir = argv[1], argv[2], argv[3]
    run_ts = (dt.datetime.fromisoformat(argv[4]) if len(argv) > 4
              else dt.datetime.now())
    spark = SparkSession.builder.appName("pricelake") \
        .config(NANOS_SETTING, "true").getOrCreate()
    with open(holdings_json) as fh:
        cfg = json.load(fh)
    holdings = holdings_table(spark, cfg["holdings"])
    drops = {t: os.path.join(drops_dir, f"{t}.parquet")
             for t in cfg.get("tickers", cfg["holdings"].keys())}
    start = cfg.get("start_date")
    params = RunParams(run_ts=run_ts,
                       calendar_start=dt.date.fromisoformat(start)
                       if start else RunParams(run_ts=run_ts).calendar_start)
    print(json.dumps(run_all(spark, drops, holdings, params, LakePaths(root),
                             dt.date.fromisoformat(start) if start else None),
                     default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
