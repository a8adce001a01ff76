"""Dense sequential numbering without a single-task window over the rows.

``ROW_NUMBER() OVER (ORDER BY a, b)`` with no partition moves every row
into one task.  ``sequential_ids`` computes the same numbers in parallel
when the order is a pair ``(coarse, fine)`` that is unique per row and
``fine`` is an integer:

1. rows are grouped into cells ``(coarse, fine div block)``; a cell holds at
   most ``block`` rows because ``fine`` is unique within ``coarse``, so the
   ``row_number`` window inside a cell is bounded no matter how skewed the
   data is;
2. cell sizes come from a map-side-combined ``count`` over the two key
   columns only.  Their prefix sums are taken on two levels: within each
   coarse value over its blocks (partitioned), and over the coarse values'
   totals.  The latter is the only unpartitioned window; it sees one row per
   coarse value (for the price fact: at most one per calendar day);
3. number = offset + row number inside the cell.

The full rows cross the network once (for the in-cell window); the counts
branch reads only the key columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 16384
LAYOUT_BLOCK = 1 << 17


def _before(n: str, window) -> Column:
    """Sum of ``n`` over the rows that come before."""
    return F.coalesce(F.sum(n).over(window.rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))


def _offsets(cells: DataFrame, *names: str) -> DataFrame:
    """__c, __b, ``names`` (given by __c), __off: the rows before each cell.

    Cell sizes come from a partial count (combines map-side, tiny shuffle); one
    row per coarse value holds its cells with their offsets within it, and the
    running sum over the coarse values adds the rows before it."""
    counts = cells.groupBy("__c", "__b", *names).agg(F.count(F.lit(1)).alias("__n"))
    within = Window.partitionBy("__c")
    inner = counts.select(
        "__c", "__b", *names, F.sum("__n").over(within).alias("__all"),
        _before("__n", within.orderBy("__b")).alias("__in"))
    outer = inner.groupBy("__c").agg(
        F.max("__all").alias("__n"),
        F.collect_list(F.struct("__b", *names, "__in")).alias("__cells"))
    return outer.select(
        "__c", _before("__n", Window.orderBy("__c")).alias("__out"), "__cells") \
        .select("__c", "__out", F.explode("__cells").alias("__x")).select(
        "__c", F.col("__x.__b").alias("__b"),
        *[F.col(f"__x.{n}").alias(n) for n in names],
        (F.col("__out") + F.col("__x.__in")).alias("__off"))


def sequential_ids(df: DataFrame, coarse: Column, fine: Column, name: str,
                   block: int = DEFAULT_BLOCK,
                   start: int | Column = 0) -> DataFrame:
    """Add ``name`` = start + row_number() over (order by coarse, fine).

    ``(coarse, fine)`` must be unique per row and ``fine`` integral.
    ``start`` may be a literal or a column of a one-row frame already joined.
    """
    cols = df.columns
    cells = df.withColumns({
        "__c": coarse,
        "__f": fine.cast("long"),
    }).withColumn("__b", F.floor(F.col("__f") / F.lit(block)).cast("long"))
    in_cell = Window.partitionBy("__c", "__b").orderBy("__f")
    numbered = cells.withColumn("__rn", F.row_number().over(in_cell))

    offsets = _offsets(cells)
    start_col = start if isinstance(start, Column) else F.lit(start)
    # Every cell has exactly one offset row, so a left join equals the inner
    # join; it lets the optimizer drop the numbering when the id is unused.
    return numbered.join(offsets, ["__c", "__b"], "left").select(
        *cols,
        (start_col.cast("long") + F.col("__off").cast("long")
         + F.col("__rn").cast("long")).alias(name))


def _cells(df: DataFrame, coarse: Column, fine: Column, block: int) -> DataFrame:
    return df.withColumns({
        "__c": coarse,
        "__f": fine.cast("long"),
    }).withColumn("__b", F.floor(F.col("__f") / F.lit(block)).cast("long"))


def layout_offsets(df: DataFrame, part: str, coarse: Column, fine: Column,
                   block: int = LAYOUT_BLOCK) -> DataFrame:
    """The rows before each cell of ``df``: one row per (part, block)."""
    return _offsets(_cells(df, coarse, fine, block), part).groupBy(
        part, "__b").agg(F.map_from_entries(
            F.collect_list(F.struct("__c", "__off"))).alias("__offs"))


def laid_out_ids(df: DataFrame, part: str, coarse: Column, fine: Column,
                 name: str, block: int = LAYOUT_BLOCK,
                 start: int | Column = 0,
                 offsets: DataFrame | None = None) -> DataFrame:
    """The numbers of ``sequential_ids``, with the rows in the layout of a table
    that is partitioned by ``part``: a column of ``df`` that follows from
    ``coarse``, of bounded length in coarse values (a month of days).

    Rows cross the network once, by (part, fine div block), and are sorted once,
    by (part, coarse, fine) within a task, both for the numbers and for the
    files; writing them needs no sampling, further exchange or sort.  A cell's
    offset is looked up in one row per (part, block).

    ``offsets``: the ``layout_offsets`` of a table of which ``df`` holds some parts
    whole; its rows get the numbers that they have in that table.
    """
    cols = df.columns
    cells = _cells(df, coarse, fine, block)
    if offsets is None:
        offsets = layout_offsets(df, part, coarse, fine, block)
    in_cell = Window.partitionBy(part, "__c", "__b").orderBy("__f")
    start_col = start if isinstance(start, Column) else F.lit(start)
    return (cells.repartition(part, "__b").join(offsets, [part, "__b"], "left")
            .select(*cols, "__c", "__b", "__f",
                    F.col("__offs")[F.col("__c")].alias("__off"))
            .withColumn("__rn", F.row_number().over(in_cell))
            .select(*cols, (start_col.cast("long") + F.col("__off").cast("long")
                            + F.col("__rn").cast("long")).alias(name)))
