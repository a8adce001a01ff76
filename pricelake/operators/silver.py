"""Raw -> cleaned layer: projection, casts, validation, keep-first dedup.

Order of steps (deviations from the reference are options, see README):

1. the ticker is stripped and upper-cased first, so the instrument-type
   lookup sees the cleaned symbol (the reference looks up the raw one);
2. the null/empty ticker check runs on the real value (the reference casts
   a null to the string ``'None'`` first, so its check never fires);
3. rows are validated, then de-duplicated (``reference_order=True`` flips
   this: an invalid first row then hides a valid duplicate).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from pricelake.functions.text import clean_ticker
from pricelake.params import MUTUAL_FUND, RunParams
from pricelake.schemas import FUND_NULLED, RENAMES, SILVER_COLS, SILVER_KEPT


KEY = ["ticker_symbol", "trade_date"]
# Rows of a bucket of keys from which on its copies combine before the shuffle.
HEAVY_ROWS = 1 << 20
KEY_BUCKETS = 1 << 16
HEAVY_BUCKETS = 1 << 10
DEFAULT_ORDER = ["ingested_at", "batch_id"]
# A large load is worked off in slices of its tickers, of about as many rows, so that
# shuffle files of one slice lie on disk at a time; at most so many slices (of more
# rows then), as each reads the input again.
SLICE_ROWS = 1 << 25
MAX_SLICES = 4


def slice_count(df: DataFrame) -> int:
    return max(1, min(MAX_SLICES, -(-df.count() // SLICE_ROWS)))


def slices(df: DataFrame, n: int, raw: bool = False) -> list[DataFrame]:
    """``df`` in ``n`` parts, all rows of a ticker (cleaned first if ``raw``) in one."""
    if n == 1:
        return [df]
    ticker = clean_ticker("ticker_symbol") if raw else F.col("ticker_symbol")
    part = F.pmod(F.xxhash64(ticker), F.lit(n))
    return [df.where(part == i) for i in range(n)]


def rename_columns(df: DataFrame) -> DataFrame:
    """Provider names -> contract names (``Date`` -> ``trade_date`` ...)."""
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items()
                                  if k in df.columns})


def type_lookup(df: DataFrame, holdings: DataFrame) -> DataFrame:
    """Left join of the instrument type on ticker; unknown tickers get null."""
    types = holdings.select("ticker_symbol", "instrument_type")
    return df.join(types, "ticker_symbol", "left")


def null_out_by_type(df: DataFrame) -> DataFrame:
    """OHLV columns are meaningless for mutual funds: null them.

    A null type (unknown ticker) keeps its values.
    """
    is_fund = F.coalesce(F.col("instrument_type") == F.lit(MUTUAL_FUND),
                         F.lit(False))
    return df.withColumns({
        c: F.when(is_fund, F.lit(None).cast(df.schema[c].dataType))
            .otherwise(F.col(c))
        for c in FUND_NULLED})


def project_contract(df: DataFrame) -> DataFrame:
    """Keep exactly the twelve contract columns, in contract order."""
    return df.select(*SILVER_KEPT)


def cast_types(df: DataFrame) -> DataFrame:
    """Timestamp -> date, price -> double, ticker stripped + upper-cased."""
    return df.withColumns({
        "trade_date": F.to_date("trade_date"),
        "close_price": F.col("close_price").cast("double"),
        "ticker_symbol": clean_ticker("ticker_symbol"),
    })


def valid_price(c: str | Column = "close_price") -> Column:
    """Strictly positive and not NaN (NaN > 0 is true in SQL engines)."""
    c = F.col(c) if isinstance(c, str) else c
    return (c > 0) & ~F.isnan(c)


def not_future(as_of: dt.date, c: str | Column = "trade_date") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c <= F.lit(as_of)


def valid_ticker(c: str | Column = "ticker_symbol") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & (c != F.lit(""))


def validation_rule(as_of: dt.date) -> Column:
    """All three rules; a null outcome counts as invalid in ``where``.

    Kept as plain conjuncts so the date rule reaches the Parquet scan.
    """
    return valid_price() & not_future(as_of) & valid_ticker()


def validate(df: DataFrame, as_of: dt.date) -> DataFrame:
    return df.where(validation_rule(as_of))


def validate_counts(df: DataFrame, as_of: dt.date) -> DataFrame:
    """Rows dropped by each rule and by dedup, in one aggregate pass.

    ``df`` is the cast frame before validation.  One row.
    """
    counts, ok = _rule_counts(as_of)
    return df.agg(
        *counts, F.count_distinct(F.when(ok, F.struct(*KEY))).alias("rows_out"),
    ).withColumn("duplicates", F.col("rows_valid") - F.col("rows_out"))


def _rule_counts(as_of: dt.date) -> tuple[list[Column], Column]:
    ok_price = F.coalesce(valid_price(), F.lit(False))
    ok_date = F.coalesce(not_future(as_of), F.lit(False))
    ok_ticker = valid_ticker()
    ok = ok_price & ok_date & ok_ticker
    return [F.count(F.lit(1)).alias("rows_in"),
            F.count_if(~ok_price).alias("invalid_price"),
            F.count_if(~ok_date).alias("future_date"),
            F.count_if(~ok_ticker).alias("invalid_ticker"),
            F.count_if(ok).alias("rows_valid")], ok


def rule_counts(bronze: DataFrame, holdings: DataFrame,
                params: RunParams) -> DataFrame:
    """One row: what ``clean`` observes of these raw rows."""
    return prepare(bronze, holdings).agg(*_rule_counts(params.today)[0])


def dedup_first(df: DataFrame, keys: Sequence[str] = tuple(KEY),
                order: Sequence[str] = tuple(DEFAULT_ORDER),
                keep: str = "first", counted: DataFrame | None = None,
                heavy_rows: int = HEAVY_ROWS,
                heavy: DataFrame | None = None) -> DataFrame:
    """One row per key: the first by ``order`` (nulls first), ties by payload;
    ``keep="last"`` keeps the last instead (restated prices: newest wins).

    Written as ``min(struct(order..., payload...))`` per key.  Most keys have one
    row, so sorting every map task's rows to combine them gains nothing: rows
    are shuffled by key and reduced there.  Only keys in buckets of more than
    ``heavy_rows`` rows (counted per hash bucket first; the fullest
    ``HEAVY_BUCKETS``) are reduced inside each map task before the shuffle, so a
    key with millions of copies never lands whole in one task.  Both ways give
    the same row.  The survivor is deterministic, unlike ``dropDuplicates``.

    ``counted``: a cheaper frame with the keys of the same rows (others may come
    along), which the buckets are counted from.  ``heavy``: the ``heavy_buckets``,
    where they are known.
    """
    keys = list(keys)
    bucket = _bucket(keys)
    if heavy is None:
        heavy = heavy_buckets(df if counted is None else counted, keys, heavy_rows)
    found = heavy.agg(F.collect_list("__b")).scalar()
    # no row is hashed for it where no bucket is heavy
    is_heavy = (F.size(found) > 0) & F.array_contains(found, bucket)
    light = _first_copies(df.where(~is_heavy).repartition(*keys), keys, order, keep)
    # the join changes no row: while it finds no heavy bucket, AQE drops its side
    held = df.where(is_heavy).withColumn("__b", bucket) \
        .join(F.broadcast(heavy), "__b", "left_semi").drop("__b")
    return light.unionByName(_first_copies(held, keys, order, keep))


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(KEY_BUCKETS)).cast("int")


def heavy_buckets(df: DataFrame, keys: Sequence[str] = tuple(KEY),
                  heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """The fullest hash buckets of keys with more than ``heavy_rows`` rows."""
    return (df.groupBy(_bucket(keys).alias("__b")).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > heavy_rows)
            .orderBy(F.desc("__n"), "__b").limit(HEAVY_BUCKETS).select("__b"))


def _first_copies(df: DataFrame, keys: list[str], order: Sequence[str],
                  keep: str) -> DataFrame:
    fields = [c for c in dict.fromkeys([*order, *df.columns]) if c not in keys]
    pick = F.max if keep == "last" else F.min
    # a hash of the key goes first: it alone decides nearly all comparisons of
    # the sort below the aggregate
    out = df.groupBy(F.xxhash64(*keys).alias("__h"), *keys).agg(
        pick(F.struct(*[F.col(c) for c in fields])).alias("__first"))
    return out.select(*[F.col(c) if c in keys else F.col(f"__first.{c}").alias(c)
                        for c in df.columns])


def silver_metadata(df: DataFrame, params: RunParams) -> DataFrame:
    return df.withColumns({
        "processed_at": F.lit(params.run_iso),
        "silver_batch_id": F.lit(params.batch_id),
    })


def prepare(bronze: DataFrame, holdings: DataFrame) -> DataFrame:
    """Rename, cast, type lookup and null-out: the row-local part of cleaning."""
    df = cast_types(rename_columns(bronze))
    df = type_lookup(df, holdings)
    return null_out_by_type(df)


def clean(bronze: DataFrame, holdings: DataFrame, params: RunParams,
          order: Sequence[str] = tuple(DEFAULT_ORDER),
          reference_order: bool = False, keep: str = "first",
          seen: Observation | None = None,
          heavy: DataFrame | None = None) -> DataFrame:
    """The full raw -> cleaned transformation (no I/O).

    ``seen`` gets the row counts of ``validate_counts`` (but the distinct
    keys) while the result is written, without a pass of its own.

    ``keep="last"`` keeps the newest copy of a (ticker, date) instead of the
    first: the restate mode, for sources that restate adjusted prices.
    """
    df = prepare(bronze, holdings)
    keys = cast_types(rename_columns(bronze)).select(*KEY)
    if seen is not None:
        df = df.observe(seen, *_rule_counts(params.today)[0])
    if reference_order:
        df = validate(dedup_first(df, KEY, order, keep, keys, heavy=heavy),
                      params.today)
    else:
        df = dedup_first(validate(df, params.today), KEY, order, keep, keys,
                         heavy=heavy)
    return silver_metadata(project_contract(df), params).select(*SILVER_COLS)


def clean_slices(bronze: DataFrame, holdings: DataFrame, params: RunParams, n: int,
                 seen: Sequence[Observation | None] | None = None,
                 **options) -> list[DataFrame]:
    """``clean`` in ``n`` slices of tickers, to be written one after the other; the
    buckets are counted once (at most ``HEAVY_BUCKETS`` numbers).  ``seen``: one for
    each."""
    if n > 1:
        found = heavy_buckets(cast_types(rename_columns(bronze))).collect()
        options["heavy"] = bronze.sparkSession.createDataFrame(found, "__b int")
    return [clean(rows, holdings, params, seen=s, **options)
            for rows, s in zip(slices(bronze, n, raw=True), seen or [None] * n)]
