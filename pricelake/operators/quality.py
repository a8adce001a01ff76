"""Data-quality audits and profiling, each a single aggregate pass."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.functions.numeric import exact_avg, round_half_away

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def bronze_counts(bronze: DataFrame) -> DataFrame:
    """Rows and date range per ticker, by ticker."""
    return bronze.groupBy("ticker_symbol").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("Date").alias("earliest_date"),
        F.max("Date").alias("latest_date")).orderBy("ticker_symbol")


def bronze_null_audit(bronze: DataFrame) -> DataFrame:
    return bronze.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("Close").isNull()).alias("null_close"),
        F.count_if(F.col("ticker_symbol").isNull()).alias("null_ticker"),
        F.count_if(F.col("Date").isNull()).alias("null_date"))


def silver_counts(silver: DataFrame) -> DataFrame:
    """Rows, date range and mean price (2 dp) per ticker and type, by ticker.

    Prices are summed as decimals of 8 places, so the mean does not depend on
    the order of the rows."""
    return silver.groupBy("ticker_symbol", "instrument_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("trade_date").alias("earliest_date"),
        F.max("trade_date").alias("latest_date"),
        round_half_away(exact_avg("close_price", 8), 2)
        .alias("avg_price")).orderBy("ticker_symbol", "instrument_type")


def silver_null_audit(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("close_price").isNull()).alias("null_close"),
        F.count_if(F.col("trade_date").isNull()).alias("null_date"),
        F.count_if(F.col("ticker_symbol").isNull()).alias("null_ticker"),
        F.count_if(F.col("close_price") <= 0).alias("invalid_price"))


BUCKETS = 1 << 16    # hash buckets of the duplicate audit: one small table


def repeat_candidates(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    """The keys of the rows among which the ``n`` most repeated keys are.

    Rows are counted per hash bucket of the key, which combines in the map tasks
    to ``BUCKETS`` rows.  No key has more rows than its bucket, so the n-th
    largest exact count of the ``n`` fullest buckets' keys (2, if there are
    fewer) rules out every bucket with less.  Where keys repeat evenly and no
    bucket falls short, all rows stay.
    """
    rows = df.select(*keys, F.pmod(F.xxhash64(*keys), F.lit(BUCKETS))
                     .alias("__bucket"))
    sizes = rows.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__rows")) \
        .where(F.col("__rows") > 1)

    def within(buckets: DataFrame) -> DataFrame:
        # at most BUCKETS longs, whatever the rows
        return rows.join(F.broadcast(buckets.select("__bucket")), "__bucket",
                         "left_semi").select(*keys)
    fullest = sizes.orderBy(F.desc("__rows"), "__bucket").limit(n)
    least = (_repeats(within(fullest), keys).orderBy(F.desc("occurrences"))
             .limit(n).agg(F.when(F.count(F.lit(1)) == n, F.min("occurrences"))
                           .otherwise(2)).scalar())
    return within(sizes.where(F.col("__rows") >= least))


def _repeats(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences")) \
        .where(F.col("occurrences") > 1)


def duplicate_audit(df: DataFrame, keys: Sequence[str] = ("ticker_symbol",
                                                          "trade_date"),
                    n: int = 10) -> DataFrame:
    """Keys with more than one row, the ``n`` most repeated (ties by key)."""
    keys = list(keys)
    return _repeats(repeat_candidates(df, keys, n), keys) \
        .orderBy(F.desc("occurrences"), *keys).limit(n)


def profile_nulls(df: DataFrame) -> DataFrame:
    """Null count of every column, one pass, as (column_name, null_count)."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return wide.unpivot([], df.columns, "column_name", "null_count")


# Quartiles: first digit of the selection (cells per doubling of a value's
# size), and cells that the values of one digit are cut into.
DIGITS = 128
CELLS = 4096
QUARTILES = (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))


def _digit(x: Column) -> Column:
    """A whole number that never falls as ``x`` grows: the sign and, on a scale
    of ``DIGITS`` steps per power of two, the size (zero is 0; the logarithm is
    monotone, so values are never put out of order)."""
    size = F.floor(F.least(F.log2(F.abs(x)), F.lit(1099.0))
                   * F.lit(float(DIGITS))) + F.lit(1100 * DIGITS)
    return F.when(x == 0, F.lit(0)).when(x > 0, size).otherwise(-size) \
        .cast("int")


def profile_describe(df: DataFrame, digits: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max of every numeric column.

    Exact at every size, by radix selection in two scans (nulls and NaN do not
    count):

    1. Every value is counted under its column and first digit (``_digit``), in
       all columns at once, by a hash aggregate that combines in the map tasks;
       per digit it also keeps mean, variance and the least and greatest value.
       These few rows add up to the moments, and their running sums name the
       digits that hold the wanted ranks.  The answers, a row per column and
       quartile, are read when the query is built.
    2. The second scan takes the values of those digits alone and counts them
       per distinct value, so a value that fills a third of the table is one
       row per task.  They are cut into cells between their least and greatest
       value; only the cell of a rank is ranked value by value.

    Quartiles interpolate linearly between neighbours, as pandas ``describe``
    does.  ``digits`` rounds mean, std and quartiles, whose last bits depend
    on the order of summation.
    """
    spark = df.sparkSession
    cols = [f.name for f in df.schema.fields
            if isinstance(f.dataType, NUMERIC)]
    r = (lambda v: round_half_away(v, digits)) if digits is not None \
        else (lambda v: v)

    def x(c):
        v = F.col(c).cast("double")
        return F.when(~F.isnan(v), v)

    def upto(n, window):
        return F.sum(n).over(window.rowsBetween(Window.unboundedPreceding, 0))
    names = [name for name, _ in QUARTILES]
    stats = "column_name string, n double, mean double, std double, " \
        "min double, max double"
    if not cols:
        return spark.createDataFrame([], f"column_name string, count double, "
                                     "mean double, std double, min double, "
                                     f"{', '.join(f'{n} double' for n in names)}"
                                     ", max double")
    each = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), x(c).alias("x"))
        for i, c in enumerate(cols)])).alias("v")).select("v.*") \
        .where("x is not null")
    # scan 1: a row per column and digit
    by_digit = each.groupBy("i", _digit(F.col("x")).alias("d")).agg(
            F.count(F.lit(1)).alias("c"), F.avg("x").alias("m"),
            F.var_pop("x").alias("v"), F.min("x").alias("lo"),
            F.max("x").alias("hi"))
    whole = Window.partitionBy("i")
    w = by_digit.withColumn("end", upto("c", whole.orderBy("d"))) \
        .withColumn("n", F.sum("c").over(whole)) \
        .withColumn("mean", F.sum(F.col("m") * F.col("c") / F.col("n")).over(whole))

    def rank(q, up):
        at = (F.col("n") - 1) * F.lit(q)
        return (F.ceil(at) if up else F.floor(at)) + 1

    def of_digit(q, up, col):
        k = rank(q, up)
        return F.max(F.when((F.col("end") >= k) & (F.col("end") - F.col("c") < k),
                            F.col(col)))
    # a row per column: its moments, and per quartile the digits of both ranks
    gap = F.col("m") - F.col("mean")
    facts = {f["i"]: f for f in w.groupBy("i").agg(
        F.max("n").alias("n"), F.max("mean").alias("mean"),
        F.sum((F.col("v") + gap * gap) * F.col("c")).alias("m2"),
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        *[f.alias(f"{a}_{name}") for name, q in QUARTILES for a, f in (
            ("lo", of_digit(q, False, "lo")), ("hi", of_digit(q, True, "hi")),
            ("end", of_digit(q, False, "end")),
            ("c", of_digit(q, False, "c")))]).collect()}
    rows, brackets = [], []
    for i, c in enumerate(cols):
        f = facts.get(i)
        n = f["n"] if f else 0
        std = None if n < 2 else \
            (f["m2"] / (n - 1)) ** 0.5 if math.isfinite(f["m2"]) else math.nan
        rows.append((c, float(n), *((f["mean"], std, f["lo"], f["hi"]) if f
                                    else (None,) * 4)))
        for name, q in QUARTILES if f else ():
            at = (n - 1) * q
            brackets.append((c, name, f[f"end_{name}"] - f[f"c_{name}"],
                             f[f"lo_{name}"], f[f"hi_{name}"],
                             math.floor(at) + 1, math.ceil(at) + 1,
                             at - math.floor(at)))
    rows = spark.createDataFrame(rows, stats)
    # scan 2: the values between the ends of each bracket, by a join with one
    # row per column and quartile (rows below the bracket, wanted ranks): many
    # conditions in a row would make code that the JVM does not compile
    spots = F.broadcast(spark.createDataFrame(
        [(cols.index(b[0]), *b) for b in brackets],
        "i int, column_name string, q string, below long, lo double, "
        "hi double, r1 long, r2 long, part double"))
    values = each.join(spots.select("i", "q", "lo", "hi"), "i") \
        .where("x >= lo and x <= hi").groupBy("i", "q", "x") \
        .agg(F.count(F.lit(1)).alias("c"))
    width = F.col("hi") - F.col("lo")
    cell = F.when((width > 0) & (width < float("inf")), F.least(
        F.lit(CELLS - 1), F.floor((F.col("x") - F.col("lo")) / width * CELLS))) \
        .otherwise(0)
    key = ["column_name", "q", "cell"]
    placed = values.join(spots, ["i", "q"]).withColumn("cell", cell)
    cells = placed.groupBy(*key, "below", "r1", "r2").agg(F.sum("c").alias("c"))
    by_cell = Window.partitionBy("column_name", "q").orderBy("cell")
    cells = cells.withColumn("end", F.col("below") + upto("c", by_cell)) \
        .withColumn("before", F.col("end") - F.col("c")) \
        .where("before < r2 and end >= r1").select(*key, "before")
    by_value = Window.partitionBy(*key).orderBy("x")
    ranked = placed.join(F.broadcast(cells), key) \
        .withColumn("end", F.col("before") + upto("c", by_value)) \
        .withColumn("start", F.col("end") - F.col("c"))

    def value(rank_):
        return F.max(F.when((F.col("start") < F.col(rank_))
                            & (F.col("end") >= F.col(rank_)), F.col("x")))
    between = F.when(F.col("a") == F.col("b"), F.col("a")).otherwise(
        F.col("a") + (F.col("b") - F.col("a")) * F.col("part"))
    quartiles = (ranked.groupBy("column_name", "q")
                 .agg(value("r1").alias("a"), value("r2").alias("b"),
                      F.max("part").alias("part"))
                 .groupBy("column_name").agg(*[
                     F.max(F.when(F.col("q") == name, between))
                     .alias(name) for name in names]))
    return rows.join(F.broadcast(quartiles), "column_name", "left").select(
        "column_name", F.col("n").alias("count"),
        r(F.col("mean")).alias("mean"), r(F.col("std")).alias("std"), "min",
        *[r(F.col(n)).alias(n) for n in names], "max")


def profile_schema(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types (metadata only) plus the row count."""
    meta = spark.createDataFrame(
        [(i, f.name, f.dataType.simpleString()) for i, f in
         enumerate(df.schema.fields)],
        "position int, column_name string, data_type string")
    return meta.withColumn("row_count", df.agg(F.count(F.lit(1))).scalar())
