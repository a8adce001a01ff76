"""Explicit schemas and column contracts of every layer (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# The provider's columns.
LANDING = T.StructType([
    T.StructField("Date", T.TimestampNTZType()),
    T.StructField("Open", T.DoubleType()),
    T.StructField("High", T.DoubleType()),
    T.StructField("Low", T.DoubleType()),
    T.StructField("Close", T.DoubleType()),
    T.StructField("Volume", T.LongType()),
    T.StructField("ticker_symbol", T.StringType()),
])

# The raw layer's metadata columns.
BRONZE_META = ["ingested_at", "source_system", "batch_id", "ingested_date"]

BRONZE = T.StructType(LANDING.fields + [
    T.StructField("ingested_at", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("ingested_date", T.StringType()),
])

# Provider column -> cleaned column (fixed values).
RENAMES = {
    "Date": "trade_date",
    "Close": "close_price",
    "High": "high_price",
    "Low": "low_price",
    "Open": "open_price",
    "Volume": "volume",
}

# Columns meaningless for mutual funds, nulled in the cleaned layer.
FUND_NULLED = ["high_price", "low_price", "open_price", "volume"]

# The cleaned-layer contract, in the reference's order (fixed values).
SILVER_KEPT = [
    "trade_date", "close_price", "high_price", "low_price", "open_price",
    "volume", "instrument_type", "ticker_symbol", "ingested_at",
    "source_system", "batch_id", "ingested_date",
]
SILVER_COLS = SILVER_KEPT + ["processed_at", "silver_batch_id"]

# Types of the cleaned layer.
SILVER = T.StructType([
    T.StructField("trade_date", T.DateType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("high_price", T.DoubleType()),
    T.StructField("low_price", T.DoubleType()),
    T.StructField("open_price", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("instrument_type", T.StringType()),
    T.StructField("ticker_symbol", T.StringType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("source_system", T.StringType()),
    T.StructField("batch_id", T.StringType()),
    T.StructField("ingested_date", T.StringType()),
    T.StructField("processed_at", T.StringType()),
    T.StructField("silver_batch_id", T.StringType()),
])

# The cleaned layer as stored: one partition per load.
STORED_SILVER = T.StructType(SILVER.fields + [
    T.StructField("processed_date", T.StringType()),
    T.StructField("run_id", T.StringType()),
])

# Columns of the calendar dimension.
DIM_DATE_COLS = [
    "full_date", "date_key", "year", "quarter", "month", "month_name",
    "day_of_week", "is_weekend", "is_market_holiday",
]

# Attributes whose change makes a new version.
TRACKED_FIELDS = ["fund_name", "sector", "instrument_type"]

# Columns of the instrument dimension.
DIM_STOCK = T.StructType([
    T.StructField("stock_key", T.IntegerType(), False),
    T.StructField("ticker_symbol", T.StringType()),
    T.StructField("fund_name", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("instrument_type", T.StringType()),
    T.StructField("valid_from", T.DateType()),
    T.StructField("valid_to", T.DateType()),
    T.StructField("is_current", T.BooleanType()),
])
DIM_STOCK_COLS = [f.name for f in DIM_STOCK.fields]

# Columns of the price fact.
FACT = T.StructType([
    T.StructField("price_key", T.LongType()),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("stock_key", T.IntegerType()),
    T.StructField("close_price", T.DoubleType()),
    T.StructField("daily_return_pct", T.DoubleType()),
    T.StructField("portfolio_value", T.DoubleType()),
    T.StructField("ingested_at", T.StringType()),
    T.StructField("processed_at", T.StringType()),
])
FACT_COLS = [f.name for f in FACT.fields]

# The fact as stored.
STORED_FACT = T.StructType(FACT.fields + [
    T.StructField("segment", T.StringType()),
    T.StructField("month_key", T.IntegerType()),
])

# The analyst dataset (fact joined to both dimensions).
STAR_COLS = [
    "close_price", "daily_return_pct", "portfolio_value", "processed_at",
    "trade_date", "year", "quarter", "month_name", "is_weekend",
    "ticker_symbol", "fund_name", "sector", "instrument_type",
]
