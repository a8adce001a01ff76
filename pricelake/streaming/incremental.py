"""The raw -> cleaned load as a checkpointed Structured Streaming query.

The raw layer directory is a Parquet file source with an explicit schema;
``trigger(availableNow=True)`` processes whatever arrived since the last run
and stops, so a scheduled run is the streaming equivalent of the batch
high-water-mark load, with the source offsets kept in the checkpoint.

Each micro-batch (``foreachBatch``):

1. runs the same cleaning function as the batch job;
2. drops keys already in the cleaned layer by a left-anti join restricted to
   the batch's own date range, so no state grows with the number of keys
   (a streaming ``dropDuplicates`` would keep every key forever);
3. writes under ``run_id = stream-<query id>-<batch id>`` with dynamic
   partition overwrite, so a batch replayed after a crash overwrites its own
   output, and a stream with a new checkpoint (hence a new query id, counting
   its batches from 0 again) never that of an earlier one.

Unlike the high-water mark, this also loads late rows (dated before the
newest cleaned date) when their key is new.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from pricelake.operators import incremental as inc
from pricelake.operators import silver as sv
from pricelake.params import RunParams
from pricelake.schemas import BRONZE, SILVER, SILVER_COLS
from pricelake.sources import sinks


def clean_new_keys(batch: DataFrame, holdings: DataFrame, params: RunParams,
                   silver_path: str,
                   order: Sequence[str] = tuple(sv.DEFAULT_ORDER)) -> list[DataFrame]:
    """Cleaned rows of one micro-batch whose key is not yet in silver, in slices of
    tickers where the batch is large."""
    spark, n = batch.sparkSession, sv.slice_count(batch)
    cleaned = sv.clean_slices(batch, holdings, params, n, order=order)
    existing = sinks.read_if_exists(
        spark, sinks.layer_path(spark, silver_path), SILVER)
    if existing is None:
        return cleaned
    return [inc.new_keys(rows, batch, known, sv.KEY)
            for rows, known in zip(cleaned, sv.slices(existing, n))]


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query of this checkpoint."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def incremental_stream(spark: SparkSession, bronze_path: str, silver_path: str,
                       checkpoint: str, holdings: DataFrame,
                       params: RunParams, schema: StructType = BRONZE,
                       order: Sequence[str] = tuple(sv.DEFAULT_ORDER),
                       max_files_per_trigger: int | None = None
                       ) -> StreamingQuery:
    """Start the availableNow load; returns the (finishing) query."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    source = reader.parquet(bronze_path)

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        out = clean_new_keys(batch, holdings, params, silver_path, order)
        run = f"stream-{query_id(batch.sparkSession, checkpoint)}-{batch_id:06d}"
        sinks.silver_write([rows.select(*SILVER_COLS) for rows in out],
                           silver_path, params.run_date_iso, run)

    return (source.writeStream.foreachBatch(per_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def run_stream(spark: SparkSession, bronze_path: str, silver_path: str,
               checkpoint: str, holdings: DataFrame, params: RunParams,
               **options) -> None:
    q = incremental_stream(spark, bronze_path, silver_path, checkpoint,
                           holdings, params, **options)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
