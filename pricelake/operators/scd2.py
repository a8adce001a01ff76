"""SCD Type 2 instrument dimension.

``scd2_merge`` compares the current rows of the previous dimension with the
incoming holdings in one full-outer join on ticker; a match puts out none, one
or two rows (an exploded array), so the join is not repeated per outcome.  History
takes no part in the join or the numbering:

* history rows (not current) pass through unchanged;
* unchanged (all tracked fields equal, null-safe): the current row is kept;
* changed: the current row is closed (``valid_to`` = today, not current) and
  a new version is inserted (``valid_from`` = today, sentinel ``valid_to``);
* new ticker: a version is inserted;
* removed ticker (current row, no incoming row): policy ``on_removed`` --
  ``close`` (default), ``keep`` or ``drop`` (the reference's behaviour).

New versions get keys ``max(existing key, 0) + 1 ...`` in configuration
order (``ordinal``), numbered in parallel by ``sequential_ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricelake.operators.numbering import sequential_ids
from pricelake.params import DEFAULT_SECTOR, SENTINEL_VALID_TO, RunParams
from pricelake.schemas import DIM_STOCK, DIM_STOCK_COLS, TRACKED_FIELDS


def incoming_rows(holdings: DataFrame) -> DataFrame:
    return holdings.select(
        "ticker_symbol", "fund_name",
        F.coalesce(F.col("sector"), F.lit(DEFAULT_SECTOR)).alias("sector"),
        "instrument_type", F.col("ordinal").cast("long").alias("ordinal"))


def current_versions(dim: DataFrame) -> DataFrame:
    return dim.where(F.coalesce(F.col("is_current"), F.lit(False)))


def scd2_merge(prev: DataFrame, holdings: DataFrame, params: RunParams,
               on_removed: str | None = None) -> DataFrame:
    """The next dimension state (history + kept + closed + inserted rows)."""
    return scd2_parts(prev, holdings, params, on_removed).drop("part")


def scd2_parts(prev: DataFrame, holdings: DataFrame, params: RunParams,
               on_removed: str | None = None) -> DataFrame:
    """The merge output with a ``part`` label per row: history, kept,
    closed or inserted (the union the dimension is assembled from)."""
    policy = on_removed or params.on_removed
    if policy not in ("keep", "close", "drop"):
        raise ValueError(f"on_removed must be keep, close or drop: {policy}")
    today = F.lit(params.today)
    is_cur = F.coalesce(F.col("is_current"), F.lit(False))

    inc = incoming_rows(holdings).select(
        "ticker_symbol", "ordinal",
        *[F.col(c).alias(f"n_{c}") for c in TRACKED_FIELDS])
    j = prev.where(is_cur).select(
        *DIM_STOCK_COLS, F.col("ticker_symbol").alias("p_ticker")).join(
        inc, "ticker_symbol", "full_outer")

    same = F.lit(True)
    for c in TRACKED_FIELDS:
        same = same & F.col(c).eqNullSafe(F.col(f"n_{c}"))
    is_new = F.col("stock_key").isNull()
    gone = F.col("ordinal").isNull()

    max_key = prev.agg(F.max("stock_key").alias("k")).scalar()
    first_from = F.lit(params.initial_valid_from or params.today)
    valid_from = F.when(max_key.isNull(), first_from).otherwise(today)

    def row(part, key, ticker, prefix, since, until, current):
        return F.struct(
            F.lit(part).alias("part"), key.cast("int").alias("stock_key"),
            ticker.alias("ticker_symbol"),
            *[F.col(f"{prefix}{c}").alias(c) for c in TRACKED_FIELDS],
            since.alias("valid_from"), until.alias("valid_to"),
            current.alias("is_current"), F.col("ordinal"))

    def before(part, until=F.col("valid_to"), current=F.col("is_current")):
        return row(part, F.col("stock_key"), F.col("p_ticker"), "",
                   F.col("valid_from"), until, current)
    closed = before("closed", today, F.lit(False))
    inserted = row("inserted", F.lit(None), F.col("ticker_symbol"), "n_",
                   valid_from, F.lit(SENTINEL_VALID_TO), F.lit(True))
    removed = {"keep": F.array(before("kept")), "close": F.array(closed),
               "drop": F.lit(None)}[policy].cast(_row_type())
    out = (F.when(is_new, F.array(inserted))
           .when(gone, removed)
           .when(same, F.array(before("kept")))
           .otherwise(F.array(closed, inserted)))
    rows = j.select(F.explode(out.cast(_row_type())).alias("r")).select("r.*")
    # the inserted rows come first in this numbering, in holdings order; the
    # others of the join keep the keys they have
    is_in = F.col("part") == "inserted"
    rows = sequential_ids(rows, F.when(is_in, 0).otherwise(1),
                          F.when(is_in, F.col("ordinal"))
                          .otherwise(F.col("stock_key")), "position",
                          start=F.coalesce(max_key, F.lit(0)))
    names = ["part", *DIM_STOCK_COLS]
    rows = rows.withColumn("stock_key", F.when(is_in, F.col("position"))
                           .otherwise(F.col("stock_key")))
    history = prev.where(~is_cur).withColumn("part", F.lit("history"))
    types = {f.name: f.dataType for f in DIM_STOCK.fields}
    return rows.select(*names).unionByName(history.select(*names)).select(
        "part", *[F.col(c).cast(types[c]).alias(c) for c in DIM_STOCK_COLS])


def _row_type() -> T.ArrayType:
    """Rows that one match of the merge puts out."""
    return T.ArrayType(T.StructType(
        [T.StructField("part", T.StringType()),
         *[T.StructField(f.name, f.dataType) for f in DIM_STOCK.fields],
         T.StructField("ordinal", T.LongType())]))


def first_dimension(spark, holdings: DataFrame, params: RunParams) -> DataFrame:
    """The dimension of a first run: every holding inserted, keys 1..n."""
    empty = spark.createDataFrame([], DIM_STOCK)
    return scd2_merge(empty, holdings, params)


# Days of a block of the as-of merge: what one task of a ticker covers.
ASOF_BLOCK_DAYS = 1024


def scd2_asof(facts: DataFrame, dim: DataFrame, date_col: str = "trade_date",
              block_days: int = ASOF_BLOCK_DAYS) -> DataFrame:
    """Attach the dimension version valid on each fact's date, by a merge.

    Prices and versions are laid side by side, sorted by date within (ticker,
    block of days), and each price takes the last version before it, if that
    has not ended (``[valid_from, valid_to)``).  A version is put once into its
    first block and, as a boundary row, into each later block that it reaches,
    up to the newest price; so the rows sorted are the prices, the versions and
    at most one boundary row per version and block, however many versions a
    ticker has, and no price meets a version it does not belong to.  A long or
    hot history is spread over its blocks.

    Prices before the first version, in a gap or after a closing date have no
    match and drop out, as have those without a ticker or date.  Versions of no
    length (opened and closed on one day) hold for no date.  The versions of a
    ticker must not overlap; where they do, the newest one counts.
    """
    def block(day):
        return F.floor(F.unix_date(day) / F.lit(block_days)).cast("int")
    day = F.to_date(F.col(date_col))
    newest = facts.agg(F.max(day)).scalar()
    d = dim.select(*DIM_STOCK_COLS).where(
        F.col("ticker_symbol").isNotNull()
        & (F.col("valid_from") < F.col("valid_to"))
        & (F.col("valid_from") <= newest))
    last = F.least(F.date_sub("valid_to", 1), newest)
    rest = [c for c in DIM_STOCK_COLS if c != "ticker_symbol"]
    versions = d.select(
        F.col("ticker_symbol").alias("__t"),
        F.struct("valid_from", "stock_key", *[
            c for c in rest if c not in ("valid_from", "stock_key")]).alias("__v"),
        F.explode(F.sequence(block(F.col("valid_from")), block(last))).alias("__b"),
        F.lit(None).cast(facts.schema).alias("__f"))
    # a boundary row stands before every price of its block
    first = F.date_from_unix_date(F.col("__b") * F.lit(block_days))
    versions = versions.withColumn("__at", F.greatest(
        first, F.col("__v.valid_from")))
    prices = facts.where(F.col("ticker_symbol").isNotNull() & day.isNotNull()) \
        .select(F.col("ticker_symbol").alias("__t"),
                F.lit(None).cast(versions.schema["__v"].dataType).alias("__v"),
                block(day).alias("__b"), F.struct(*facts.columns).alias("__f"),
                day.alias("__at"))
    merged = Window.partitionBy("__t", "__b").orderBy(
        "__at", F.col("__f").isNotNull(), "__v") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = versions.unionByName(prices).select(
        "__f", "__at", F.last("__v", ignorenulls=True).over(merged).alias("__v"))
    return out.where(F.col("__f").isNotNull()
                     & (F.col("__at") < F.col("__v.valid_to"))).select(
        "__f.*", *[F.col(f"__v.{c}").alias(c) for c in rest])


def scd2_counts(dim: DataFrame) -> DataFrame:
    return dim.agg(F.count_if(F.col("is_current")).alias("current_rows"),
                   F.count(F.lit(1)).alias("total_rows"))

