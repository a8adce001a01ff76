"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Word separators (Java regex): everything but 0-9, a-z and non-ASCII ...
ALNUM_SEP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# ... and plain white space.
SPACE_SEP = r"[\x20\x09-\x0D]+"


# While a scratch table is written: shuffle files go when the query ends, and
# Arrow batches, of which each task holds several, stay small.
WRITE_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` to a fresh folder of the shared scratch area and read it
    back: cuts the lineage, and survives lost executors.  Also returns the
    folder, for ``discard``.

    The shuffle files of the write are dropped with it, as the frame is not
    run again.  zstd frees its native buffers at the end of each file;
    Parquet's snappy keeps direct buffers until a full collection, which adds
    up over many small files.
    """
    path = scratch_path(df.sparkSession, name)
    return _append(df, path), path


def _append(df: DataFrame, path: str) -> DataFrame:
    """Add ``df`` to the scratch table at ``path`` and return the table."""
    spark = df.sparkSession
    old = {name: spark.conf.get(name) for name in WRITE_SETTINGS}
    for name, value in WRITE_SETTINGS.items():
        spark.conf.set(name, value)
    try:
        df.write.mode("append").option("compression", "zstd").parquet(path)
    finally:
        for name, value in old.items():
            spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    return stored_at(df, name)[0]


def stored_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """One scratch table of all ``parts`` (at least one, of one schema), written
    one after the other."""
    path = None
    for df in parts:
        path = path or scratch_path(df.sparkSession, name)
        rows = _append(df, path)
    return rows


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, UPPER.lower())


def n_space_words(text: Column) -> Column:
    """Number of white-space separated words; null and empty text have none.

    ``split`` yields at most one empty piece at either end.
    """
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_SEP)
    head = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1) \
        .otherwise(0)
    return (F.size(parts) - head - tail).cast("bigint")


def hashed_set(names: DataFrame, bits: int) -> np.ndarray:
    """A bit table of fixed size (``bits``, a power of two up to 2**32) of a
    one-column table of longs: bit ``name mod bits`` (as unsigned) is set for
    every name.  At most bits / 32768 rows of 4 kB reach the driver."""
    slot = F.col(names.columns[0]).bitwiseAND(F.lit(bits - 1)) + 1
    blocks = names.groupBy(F.bitmap_bucket_number(slot).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("m"))
    table = np.zeros((max(1, bits >> 15), 4096), np.uint8)
    for b, m in blocks.toLocalIterator():
        table[b - 1] = np.frombuffer(m, np.uint8)
    return table.ravel()


def is_in(table: np.ndarray, names: np.ndarray) -> np.ndarray:
    """Which of the names may be in a ``hashed_set``."""
    slot = names.view(np.int64) & np.int64(8 * len(table) - 1)
    return (table[slot >> 3] >> (slot & 7) & 1).astype(bool)


def without(docs: DataFrame, gone: DataFrame, key: dict[str, Column],
            slots: int = 1 << 17) -> DataFrame:
    """The rows of ``docs`` whose ``key`` (name -> expression) is not in the
    one-column table ``gone``.

    A hashed table of fixed size, with one byte per slot, lets rows pass that
    cannot be meant; only the others are shuffled for the exact anti join.
    Null keys stay.  Built-in functions only.
    """
    (name, expr), = key.items()

    def slot(col):
        return F.pmod(F.xxhash64(col), F.lit(slots)).cast("int")
    marks = bytearray(slots)
    for (at,) in gone.select(slot(F.col(name))).distinct().toLocalIterator():
        marks[at] = 1                       # at most ``slots`` rows
    own = docs.columns
    keyed = docs.withColumn("_gone_key", expr)
    mark = F.substring(F.lit(marks), slot(F.col("_gone_key")) + 1, F.lit(1))
    free = F.col("_gone_key").isNull() | (mark == F.lit(bytearray(1)))
    rest = keyed.where(~free).join(
        gone.select(F.col(name).alias("_gone_name")),
        F.col("_gone_key") == F.col("_gone_name"), "left_anti")
    return keyed.where(free).select(*own).unionByName(rest.select(*own))
