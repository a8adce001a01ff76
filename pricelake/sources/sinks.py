"""Sinks of the three layers and their load state.

* raw layer: append-only, one partition per ingest date, written at most once;
* cleaned layer: partitioned by ``processed_date`` and ``run_id`` with dynamic
  partition overwrite.  A batch load has a ``run_id`` of its own for every
  attempt; a stream's batch keeps its one, so a replay replaces itself.  Replacing
  more than that (restating, reprocessing) writes a new version of the layer
  beside it and publishes that;
* gold layer: every run writes a fresh version directory, checks it, and then
  publishes it.  The fact is kept in segments beside them, of which a version
  lists its own.

A version name is unique to its attempt and its directory is never
overwritten, so what readers see stays whole whatever fails.  Publishing
appends one row to a small log; the row with the highest sequence number is
current, whatever its run time.  One writer per layer is assumed, as with the
single scheduled job of the lake.

An audit table records each load (run id, mark, rows in and out, rows dropped
and why, instruments skipped).  A ledger names the raw partitions that a load
by ledger has read.

All writes go through Spark's file commit protocol: a failed task is retried
and a failed job leaves no committed partial output.
"""

from __future__ import annotations

import datetime as dt
import functools
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.schemas import DIM_STOCK, STORED_FACT

AUDIT = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("high_water_mark", T.DateType()),
    T.StructField("rows_in", T.LongType()),
    T.StructField("rows_out", T.LongType()),
    T.StructField("invalid_price", T.LongType()),
    T.StructField("future_date", T.LongType()),
    T.StructField("invalid_ticker", T.LongType()),
    T.StructField("duplicates", T.LongType()),
    T.StructField("note", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
])

PUBLISHED = T.StructType([
    T.StructField("sequence", T.LongType()),
    T.StructField("version", T.StringType()),
    T.StructField("run_ts", T.StringType()),
    T.StructField("published_at", T.StringType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def _move(spark: SparkSession, path: str, to: str) -> None:
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"{path} could not be renamed to {to}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_if_exists(spark: SparkSession, path: str,
                   schema: T.StructType | None = None) -> DataFrame | None:
    """The Parquet table at ``path``, or ``None`` when the path is absent.

    Only "not found" yields ``None``; any read error propagates.
    """
    if not _exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def has_rows(spark: SparkSession, path: str) -> bool:
    df = read_if_exists(spark, path)
    return df is not None and not df.isEmpty()


# -- versions --------------------------------------------------------------------

def new_version(run_ts: dt.datetime) -> str:
    """A version name of its own for every attempt."""
    return f"{run_ts:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:12]}"


def published(spark: SparkSession, root: str) -> Row | None:
    """The newest row of the publish log of ``root``, or ``None``."""
    log = read_if_exists(spark, f"{root.rstrip('/')}/_published", PUBLISHED)
    if log is None:
        return None
    return log.orderBy(F.desc("sequence"), F.desc("version")).limit(1).first()


def publish(spark: SparkSession, root: str, version: str, run_ts: str,
            published_at: str | None = None) -> None:
    """Make ``version`` the current one of ``root``."""
    last = published(spark, root)
    spark.createDataFrame(
        [((last["sequence"] if last else 0) + 1, version, run_ts,
          published_at or run_ts)], PUBLISHED).coalesce(1) \
        .write.mode("append").parquet(f"{root.rstrip('/')}/_published")


def current_version(spark: SparkSession, root: str) -> str | None:
    row = published(spark, root)
    return None if row is None else row["version"]


def content_digest(columns: list[str]) -> list[Column]:
    """Aggregates that name a table's content whatever the order of its rows:
    their number and the sum of their hashes, as a decimal (exact)."""
    return [F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).alias("digest")]


def write_checked(df: DataFrame | Iterable[DataFrame], path: str,
                  partition_by: list[str] = ()) -> int:
    """Write ``df`` (or several frames of one schema, one after the other) to a new
    ``path`` and hold the stored content against the rows that the writing plans
    produced.  Returns the row count."""
    n, digests, mode = 0, [], "errorifexists"
    for df in [df] if isinstance(df, DataFrame) else df:
        seen = Observation()
        writer = df.observe(seen, *content_digest(df.columns)).write.mode(mode)
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        n, mode = n + seen.get["n"], "append"
        if seen.get["digest"] is not None:
            digests.append(int(seen.get["digest"]))     # exact at any length
    return write_verify(df.sparkSession, path, n, df.schema,
                        sum(digests) if digests else None)


# -- raw layer -----------------------------------------------------------------

def bronze_append(df: DataFrame, bronze_path: str, ingested_date: str) -> bool:
    """Append the run's rows under ``ingested_date=<date>`` unless that date
    already holds rows (append-only; a second run on one day is skipped).
    Returns whether rows were written."""
    spark = df.sparkSession
    part = f"{bronze_path.rstrip('/')}/ingested_date={ingested_date}"
    if has_rows(spark, part):
        return False
    (df.withColumn("ingested_date", F.lit(ingested_date))
       .write.mode("append").partitionBy("ingested_date").parquet(bronze_path))
    return True


# Ingest partitions that the cleaned layer was loaded from, and their form then.
LEDGER = T.StructType([
    T.StructField("ingested_date", T.StringType()),
    T.StructField("files", T.LongType()),
    T.StructField("bytes", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("recorded_at", T.StringType()),
])


def ingests(spark: SparkSession, bronze_path: str) -> dict[str, tuple[int, int]]:
    """Ingest date -> (files, bytes) of the raw layer's partitions, by listing
    its folders; a partition that grows changes its form."""
    at = spark._jvm.org.apache.hadoop.fs.Path(
        f"{bronze_path.rstrip('/')}/ingested_date=*")
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for x in fs.globStatus(at) or ():
        size = fs.getContentSummary(x.getPath())
        found[x.getPath().getName().split("=", 1)[1]] = (
            size.getFileCount(), size.getLength())
    return found


def ledger_read(spark: SparkSession, ledger_path: str) -> dict[str, set]:
    """Ingest date -> every form in which a load has read it: a few rows per
    load, as many as there were raw runs."""
    rows = read_if_exists(spark, ledger_path, LEDGER)
    found: dict[str, set] = {}
    for r in rows.select("ingested_date", "files", "bytes").distinct() \
            .toLocalIterator() if rows is not None else ():
        found.setdefault(r[0], set()).add((r[1], r[2]))
    return found


def ledger_commit(spark: SparkSession, ledger_path: str,
                  loaded: dict[str, tuple[int, int]], run_id: str,
                  recorded_at: str) -> None:
    """Record the partitions of a load, after its rows are written.  A load that
    fails before is repeated and adds only the keys that are missing."""
    spark.createDataFrame([(d, *form, run_id, recorded_at)
                           for d, form in sorted(loaded.items())], LEDGER) \
        .coalesce(1).write.mode("append").parquet(ledger_path)


# -- cleaned layer --------------------------------------------------------------

def layer_path(spark: SparkSession, root: str) -> str:
    """Where the cleaned layer of ``root`` lives now: its newest published
    version, or ``root`` itself while nothing was replaced."""
    versions = f"{root.rstrip('/')}_versions"
    version = current_version(spark, versions)
    return root if version is None else f"{versions}/v={version}"


def _stamped(df: DataFrame, processed_date: str, run_id: str) -> DataFrame:
    return df.withColumn("processed_date", F.lit(processed_date)) \
        .withColumn("run_id", F.lit(run_id))


def silver_write(df: DataFrame | list[DataFrame], silver_path: str,
                 processed_date: str, run_id: str) -> None:
    """Write the run under (processed_date, run_id) of the current layer,
    replacing only that run.  A run that is not there yet is written straight
    into its partition, which spares the sort of a partitioned write.  A run in
    several frames is written one after the other into a folder that no reader
    sees and gets its place when it is whole."""
    frames = [df] if isinstance(df, DataFrame) else df
    spark = frames[0].sparkSession
    path = layer_path(spark, silver_path)
    part = f"{path}/processed_date={processed_date}/run_id={run_id}"
    if re.fullmatch(r"[\w.-]+", processed_date + run_id) \
            and not _exists(spark, part):
        if len(frames) == 1:
            frames[0].write.parquet(part)
            return
        hidden = f"{path}/_{uuid.uuid4().hex}"
        for frame in frames:
            frame.write.mode("append").parquet(hidden)
        _move(spark, hidden, part)
        return
    df = functools.reduce(DataFrame.unionByName, frames)
    (_stamped(df, processed_date, run_id).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("processed_date", "run_id").parquet(path))


def silver_replace(new: DataFrame, silver_path: str, run_ts: dt.datetime,
                   processed_date: str, run_id: str,
                   kept: DataFrame | None = None) -> int:
    """Publish a new version of the layer: ``kept`` (rows of the present one,
    with their partition columns) and the ``new`` rows of this run.  Until it
    is published, and if anything fails, readers see the present version."""
    spark = new.sparkSession
    rows = _stamped(new, processed_date, run_id)
    if kept is not None:
        rows = kept.select(*rows.columns).unionByName(rows)
    versions = f"{silver_path.rstrip('/')}_versions"
    version = new_version(run_ts)
    n = write_checked(rows, f"{versions}/v={version}",
                      ["processed_date", "run_id"])
    publish(spark, versions, version, run_ts.isoformat())
    return n


def watermark_commit(spark: SparkSession, audit_path: str, run_id: str,
                     layer: str, mark: dt.date | None, rows_in: int | None,
                     rows_out: int, recorded_at: str,
                     dropped: dict[str, int] | None = None,
                     note: str | None = None) -> None:
    """Append one audit row after a successful write."""
    names = ("invalid_price", "future_date", "invalid_ticker", "duplicates")
    spark.createDataFrame(
        [(run_id, layer, mark, rows_in, int(rows_out),
          *[(dropped or {}).get(n) for n in names], note, recorded_at)],
        AUDIT).coalesce(1).write.mode("append").parquet(audit_path)


# -- gold layer -----------------------------------------------------------------

def gold_path(gold_root: str, version: str, table: str) -> str:
    return f"{gold_root.rstrip('/')}/v={version}/{table}"


def gold_write(tables: dict[str, DataFrame], gold_root: str, version: str,
               partition_by: dict[str, list[str]] | None = None,
               ) -> dict[str, int]:
    """Write every table to its fresh place in ``version`` and check the
    counts, which are returned.  Nothing is published here."""
    return {name: write_checked(df, gold_path(gold_root, version, name),
                                (partition_by or {}).get(name, ()))
            for name, df in tables.items()}


# The fact lies outside the versions, in segments: a full refresh writes one, an
# incremental one adds one.  A version's state names its segments and what they
# were built from.
FACT = "fact_stock_prices"
FACT_STATE = T.StructType([
    T.StructField("segments", T.ArrayType(T.StringType())),
    T.StructField("rows", T.LongType()),
    T.StructField("last_key", T.LongType()),
    T.StructField("last_date_key", T.IntegerType()),
    T.StructField("layer", T.StringType()),
    T.StructField("loads", T.ArrayType(T.StringType())),
    T.StructField("calendar_start", T.DateType()),
    T.StructField("calendar_end", T.DateType()),
])


def segment_path(gold_root: str, segment: str) -> str:
    return f"{gold_root.rstrip('/')}/{FACT}/segment={segment}"


def fact_segments(spark: SparkSession, gold_root: str,
                  segments: list[str]) -> DataFrame:
    """The rows of some segments: one scan, pruned by partition."""
    fact = spark.read.schema(STORED_FACT).parquet(
        f"{gold_root.rstrip('/')}/{FACT}")
    return fact.where(F.col("segment").isin(segments)).drop("segment")


def fact_state(spark: SparkSession, gold_root: str, version: str) -> Row:
    return spark.read.schema(FACT_STATE).parquet(
        gold_path(gold_root, version, "fact_state")).first()


def loads(spark: SparkSession, layer: str) -> list[str]:
    """The loads (``processed_date/run_id``) of a cleaned layer, by listing its
    partition folders."""
    at = spark._jvm.org.apache.hadoop.fs.Path(
        f"{layer.rstrip('/')}/processed_date=*/run_id=*")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted("/".join(str(x.getPath()).split("/")[-2:])
                  .replace("processed_date=", "").replace("run_id=", "")
                  for x in found or ())


def of_loads(layer: DataFrame, names: list[str]) -> DataFrame:
    """Rows of some loads; only their partitions are read."""
    return layer.where(F.concat_ws("/", "processed_date", "run_id").isin(names))


def write_verify(spark: SparkSession, path: str,
                 expected: int | None = None,
                 schema: T.StructType | None = None,
                 digest: int | None = None) -> int:
    """Row count of a written table, re-read from storage (with ``schema``, as a
    table without rows may have no file to take it from).  With a ``digest``
    (``content_digest`` of the rows written), changed values are an error too."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    stored = reader.parquet(path)
    if digest is None:
        n, found = stored.count(), None
    else:
        n, found = stored.agg(*content_digest(
            (schema or stored.schema).names)).first()
    if expected is not None and n != expected:
        raise RuntimeError(f"{path}: wrote {n} rows, expected {expected}")
    if found != digest:
        raise RuntimeError(f"{path}: the {n} stored rows differ in content from "
                           "the rows written")
    return n


def gold_table(spark: SparkSession, gold_root: str, table: str) -> DataFrame:
    """A table of the newest published gold version (the marts' entry)."""
    version = mart_guard(spark, gold_root)
    if table == FACT:
        return fact_segments(spark, gold_root, fact_state(
            spark, gold_root, version)["segments"])
    return spark.read.parquet(gold_path(gold_root, version, table))


def mart_guard(spark: SparkSession, gold_root: str) -> str:
    """The published version, or a clear error when gold was never built."""
    version = current_version(spark, gold_root)
    if version is None:
        raise FileNotFoundError(
            f"no published gold layer under {gold_root}; run the gold job first")
    return version


def dim_snapshot_read(spark: SparkSession, gold_root: str) -> DataFrame:
    """The previous ``dim_stock``: the newest published one, or an empty
    frame of the schema on a first run.  A read error other than "not
    found" propagates instead of silently resetting history."""
    version = current_version(spark, gold_root)
    if version is None:
        return spark.createDataFrame([], DIM_STOCK)
    return spark.read.schema(DIM_STOCK).parquet(
        gold_path(gold_root, version, "dim_stock"))
