"""Binding of the driver's test tables to the price model.

The test tables hold no prices, so the model is bound to them as views:

* ``part``      -> holdings (instrument = part)
* ``lineitem``  -> raw daily prices (instrument = part, day = ship date,
  close = extended price / quantity); the three return flags are three
  landing runs of the raw layer (the streaming load reads the stored raw
  layer as its file source)

The run parameters below stand in for the clock: the test tables end in
2001, so "today" is 2001-12-31.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.params import RunParams
from pricelake.sources.tables import holdings_table

# Fixed values of the test binding.
TEST_AS_OF = dt.date(2001, 12, 31)
TEST_CALENDAR_START = dt.date(1995, 1, 1)
TEST_MARK = dt.date(2000, 1, 1)
LANDING_FLAGS = ["A", "N", "R"]
TEST_SOURCE = "testdata"


def landing_params(i: int) -> RunParams:
    """Run parameters of landing run ``i`` (0, 1, 2)."""
    return RunParams(run_ts=dt.datetime(2002, 1, 1 + i, 18, 0, 0),
                     as_of_date=TEST_AS_OF, source_system=TEST_SOURCE)


SILVER_PARAMS = RunParams(run_ts=dt.datetime(2002, 1, 4, 19, 0, 0),
                          as_of_date=TEST_AS_OF, source_system=TEST_SOURCE)

GOLD_PARAMS = RunParams(run_ts=dt.datetime(2002, 1, 4, 20, 0, 0),
                        as_of_date=TEST_AS_OF, source_system=TEST_SOURCE,
                        calendar_start=TEST_CALENDAR_START,
                        calendar_end=TEST_AS_OF, on_removed="keep",
                        initial_valid_from=TEST_CALENDAR_START)

# Explicit schema of the lineitem test table (never inferred).
LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

# Extra landing columns that make "first row" a total order on test data.
TIE_BREAK = ["l_orderkey", "l_linenumber", "l_suppkey"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ticker_of(key) -> F.Column:
    return F.concat(F.lit("P"), F.lpad(key.cast("string"), 8, "0"))


def prices_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider-shaped daily bars, one per lineitem, plus tie-break columns."""
    li = table(spark, sf_dir, "lineitem")
    unit = F.try_divide(F.col("l_extendedprice"), F.col("l_quantity"))
    return li.select(
        ticker_of(F.col("l_partkey")).alias("ticker_symbol"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("Date"),
        (unit * (F.lit(1.0) - F.col("l_discount") / 2)).alias("Open"),
        (unit * (F.lit(1.0) + F.col("l_tax"))).alias("High"),
        (unit * (F.lit(1.0) - F.col("l_discount"))).alias("Low"),
        unit.alias("Close"),
        F.col("l_quantity").cast("bigint").alias("Volume"),
        F.col("l_returnflag").alias("landing_flag"),
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
    )


def landing_batch(spark: SparkSession, sf_dir: str, flag: str) -> DataFrame:
    """One landing run: the raw bars of one return flag."""
    return (prices_raw(spark, sf_dir)
            .where(F.col("landing_flag") == flag)
            .drop("landing_flag", "l_partkey"))


def stamped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landing rows with the metadata of their run, by one scan."""
    def stamp(field):
        out = None
        for i, flag in enumerate(LANDING_FLAGS):
            hit, value = F.col("landing_flag") == flag, F.lit(
                getattr(landing_params(i), field))
            out = F.when(hit, value) if out is None else out.when(hit, value)
        return out
    return (prices_raw(spark, sf_dir)
            .where(F.col("landing_flag").isin(LANDING_FLAGS))
            .withColumns({"ingested_at": stamp("run_iso"),
                          "source_system": F.lit(TEST_SOURCE),
                          "batch_id": stamp("batch_id"),
                          "ingested_date": stamp("run_date_iso")})
            .drop("landing_flag", "l_partkey"))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdings configuration as a relation, ``ordinal`` = config order."""
    p = table(spark, sf_dir, "part")
    return p.select(
        ticker_of(F.col("p_partkey")).alias("ticker_symbol"),
        F.col("p_name").alias("fund_name"),
        F.col("p_retailprice").cast("double").alias("baseline_value_usd"),
        F.lit(None).cast("double").alias("allocation_pct"),
        F.when(F.col("p_size") <= 40, F.lit("mutual_fund"))
         .otherwise(F.lit("stock")).alias("instrument_type"),
        F.col("p_type").alias("sector"),
        F.col("p_partkey").cast("bigint").alias("ordinal"),
    )


def holdings_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same holdings through a configuration table: a row per instrument
    with the keys of a configuration entry, as ``holdings_table`` takes it."""
    rows = holdings(spark, sf_dir).select(
        "ticker_symbol", F.struct(
            F.col("fund_name").alias("name"),
            F.col("baseline_value_usd").alias("value_usd"),
            F.col("allocation_pct"),
            F.col("instrument_type").alias("type"), "sector").alias("entry"),
        "ordinal")
    return holdings_table(spark, rows)


def dim_stock_prev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A previous dimension state: every 10th sector differs, every 10th row absent."""
    h = holdings(spark, sf_dir)
    return h.where(F.col("ordinal") % 10 != 9).select(
        (F.col("ordinal") + 1).cast("int").alias("stock_key"),
        "ticker_symbol", "fund_name",
        F.when(F.col("ordinal") % 10 == 1, F.lit("LEGACY"))
         .otherwise(F.col("sector")).alias("sector"),
        "instrument_type",
        F.lit(TEST_CALENDAR_START).alias("valid_from"),
        F.lit(dt.date(9999, 12, 31)).alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def holdings_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The next holdings configuration: every 10th ticker removed."""
    return holdings(spark, sf_dir).where(F.col("ordinal") % 10 != 7)

