"""Layer readers and the holdings relation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.params import DEFAULT_SECTOR


def parquet_scan(spark: SparkSession, path: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """All files of a layer; with a schema, Spark does not infer or merge."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


ENTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value_usd", T.DoubleType()),
    T.StructField("allocation_pct", T.DoubleType()),
    T.StructField("type", T.StringType()),
    T.StructField("sector", T.StringType()),
])


def holdings_table(spark: SparkSession, holdings: dict | DataFrame) -> DataFrame:
    """Holdings configuration as a relation.

    Either a dict ``{ticker: {name, value_usd, type, ...}}`` read from a file,
    or a table (ticker_symbol, entry, ordinal) with such entries as structs.
    ``ordinal`` keeps the configuration order (it drives SCD2 key assignment);
    a missing sector becomes ``Unknown``.
    """
    if isinstance(holdings, dict):
        rows = [(ticker, {f.name: _f(d.get(f.name))
                          if f.dataType == T.DoubleType() else d.get(f.name)
                          for f in ENTRY.fields}, i)
                for i, (ticker, d) in enumerate(holdings.items())]
        holdings = spark.createDataFrame(rows, T.StructType([
            T.StructField("ticker_symbol", T.StringType()),
            T.StructField("entry", ENTRY), T.StructField("ordinal", T.LongType())]))
    e = F.col("entry")
    return holdings.select(
        "ticker_symbol", e["name"].alias("fund_name"),
        e["value_usd"].alias("baseline_value_usd"),
        e["allocation_pct"].alias("allocation_pct"),
        e["type"].alias("instrument_type"),
        F.coalesce(e["sector"], F.lit(DEFAULT_SECTOR)).alias("sector"), "ordinal")


def _f(x):
    return None if x is None else float(x)
