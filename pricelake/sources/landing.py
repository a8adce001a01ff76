"""Landing-zone reader for raw per-instrument price drops.

A drop is a Parquet file written by a pandas-based downloader, one per
instrument.  Such files have quirks Spark must absorb (see the survey):

* ``datetime64[ns]`` columns land as Parquet ``timestamp[ns]``, which Spark
  refuses unless read as a long (``nanosAsLong``) and converted;
* an ``__index_level_0__`` column appears once rows were dropped upstream;
* ``Volume`` may arrive as double when it held nulls.

Each drop is normalised to the ``LANDING`` schema by an explicit projection.
"""

from __future__ import annotations

import datetime as dt
import functools
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from pricelake.schemas import LANDING

log = logging.getLogger(__name__)

def _date_column(df: DataFrame) -> F.Column:
    dtype = df.schema["Date"].dataType
    if isinstance(dtype, T.LongType):
        # Wall-clock nanoseconds since 1970-01-01 (no zone): epoch + interval
        # keeps the value independent of the session time zone.
        # Integer arithmetic: a double holds nanoseconds only to about 200.
        micros = F.expr("(Date - pmod(Date, 1000)) div 1000") \
            .cast("decimal(20,0)")
        secs = (micros / F.lit(1_000_000)).cast("decimal(18,6)")
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), secs)
    return F.col("Date").cast("timestamp_ntz")


def normalize_drop(df: DataFrame, ticker: str | None = None) -> DataFrame:
    """Project one raw drop onto the landing schema.

    Index-like columns are discarded, the date becomes a timestamp, numeric
    columns get their contract types and the ticker is tagged when the drop
    does not carry one.
    """
    cols = []
    for f in LANDING.fields:
        if f.name == "Date":
            cols.append(_date_column(df).alias("Date"))
        elif f.name == "ticker_symbol":
            if "ticker_symbol" in df.columns:
                cols.append(F.col("ticker_symbol").cast("string"))
            else:
                cols.append(F.lit(ticker).cast("string").alias("ticker_symbol"))
        elif f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


NANOS_SETTING = "spark.sql.legacy.parquet.nanosAsLong"


def landing_read(spark: SparkSession, drops: dict[str, str],
                 start_date: dt.date | str | None = None,
                 skipped: list[tuple[str, str]] | None = None) -> DataFrame:
    """Read per-instrument drops ``{ticker: path}`` into one landing frame.

    Spark resolves the paths.  Missing or unreadable drops are skipped with a
    warning (one failing instrument does not stop the run) and added to
    ``skipped`` as (ticker, reason); if no drop could be read at all, or the
    union is empty, a ``ValueError`` is raised.

    Files written by pandas carry nanosecond timestamps, which Spark reads
    only with ``spark.sql.legacy.parquet.nanosAsLong=true``.  The setting must
    hold while the result is computed, so the session has to bring it; such a
    drop is an error without it, not a skip.
    """
    frames = []

    def skip(ticker, reason):
        log.warning("drop for %s skipped: %s", ticker, reason)
        if skipped is not None:
            skipped.append((ticker, reason))
    for ticker, path in drops.items():
        try:
            raw = spark.read.parquet(path)
        except AnalysisException as exc:
            if "NANOS" in str(exc):
                raise ValueError(
                    f"the drop for {ticker} holds nanosecond timestamps: set "
                    f"{NANOS_SETTING}=true in the session") from exc
            skip(ticker, (exc.getCondition() or str(exc))[:200])
            continue
        if "Date" not in raw.columns:
            skip(ticker, "no Date column")
            continue
        frames.append(normalize_drop(raw, ticker))
    if not frames:
        raise ValueError("No data extracted for any ticker")
    df = landing_frames(frames, start_date)
    if df.isEmpty():
        raise ValueError("No data extracted for any ticker")
    return df


def landing_frames(frames: list[DataFrame],
                   start_date: dt.date | str | None = None) -> DataFrame:
    """Normalise landing frames, stack them, keep rows from ``start_date``."""
    df = bronze_union([normalize_drop(f) for f in frames])
    if start_date is not None:
        df = df.where(F.col("Date") >= F.lit(start_date).cast("timestamp_ntz"))
    return df


def bronze_union(frames: list[DataFrame]) -> DataFrame:
    """Stack landing frames by column name (one plan, no data movement)."""
    return functools.reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def bronze_metadata(df: DataFrame, params) -> DataFrame:
    """Stamp the raw-layer metadata from the run parameters."""
    return df.withColumns({
        "ingested_at": F.lit(params.run_iso),
        "source_system": F.lit(params.source_system),
        "batch_id": F.lit(params.batch_id),
        "ingested_date": F.lit(params.run_date_iso),
    })
