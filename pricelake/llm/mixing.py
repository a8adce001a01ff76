"""Mix sources to target weights.

A document's size is its number of white-space separated words.  The sources,
ordered by code point with null last, weigh 5, 2, 1, 5, 2, 1, ... and share
``share`` of all words; no target exceeds ``cap`` times its source's words,
and what a source cannot take is shared again by weight among the others.
The fixpoint is found in closed form: with sources ordered by cap / weight,
the first ones are capped and the rest take ``level * weight``.

Each document gets a hash-random key.  A source is range-sorted by the top
bits of that key into cells of about ``ROWS_PER_CELL`` documents; prefix sums
of the cells' words give the one cell in which the source's budget ends.
Whole cells before it are taken, cells after it are not, and only the
documents of the cutting cell are ordered and summed one by one; the document
at the cut gives just the words that are missing, so a source gives exactly
floor(target) words.  Budgets above the source's words repeat whole epochs.

Cells are small at every size (also those of a source with a third of all
rows).  Rows that share an id share a key, hence a cell; those alike in id and
size are ordered as one row with a count, so a null or repeated id of many rows
costs as many rows as it has sizes.  Nothing but the cutting cells and the cell and source tables is windowed, and per-source
values reach the rows through a join that Spark broadcasts only below its own
size threshold.  The source table itself (one row per distinct source) is
ordered in one task.

Null and empty texts have size 0; a null source is a source of its own; rows
that repeat an id are documents of their own, ordered by size within ties.
Reruns agree, as the key depends on the id alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import n_space_words, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
KEY_BITS = 60
ROWS_PER_CELL = 8192
COPIES_PER_BLOCK = 4096   # rows of one id and size that one task row stands for


def _key():
    digest = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("bigint")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   cap: int = CAP) -> DataFrame:
    """source, source_size, target of a (source, size) table."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    kind = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), kind + 1)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    per = per.select("source", "source_size", weight.alias("w"),
                     total.alias("total"),
                     (F.col("source_size") * cap).cast("double").alias("most"))
    by_ratio = Window.orderBy(F.col("most") / F.col("w"),
                              F.col("source").asc_nulls_last())
    before = F.sum("most").over(by_ratio.rowsBetween(
        Window.unboundedPreceding, -1))
    rest = F.sum("w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - F.coalesce(before, F.lit(0.0)))
                         / rest).withColumn("r", F.row_number().over(by_ratio))
    fits = F.col("level") <= F.col("most") / F.col("w")
    level = F.min(F.when(fits, F.struct("r", "level"))).over(
        Window.partitionBy())["level"]
    return per.select("source", "source_size", F.least(
        F.col("most"), F.coalesce(level * F.col("w"), F.col("most")))
        .alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", source_col: str = "source",
                weights=WEIGHTS, share: float = SHARE,
                cap: int = CAP) -> DataFrame:
    """id, source, size, source_size, target, taken: one row per document."""
    rows = docs.select(F.col(id_col).alias("id"),
                       F.col(source_col).alias("source"),
                       n_space_words(F.col(text_col)).alias("size"))
    rows = stored(rows.withColumn("key", _key()), "mix-sizes")
    # one number decides the cell width: cells stay small as the input grows
    n = rows.count()
    bits = max(0, (max(1, n) // ROWS_PER_CELL).bit_length())
    rows = rows.withColumn("cell", F.shiftright("key", KEY_BITS - bits))

    targets = source_targets(rows, weights, share, cap)
    # integer division and remainder; a source without words takes nothing
    budget = F.floor("target").cast("bigint")
    epochs = F.coalesce(F.try_divide(budget, F.col("source_size")),
                        F.lit(0.0))
    plan = targets.withColumn("epochs", F.floor(epochs).cast("bigint")) \
        .withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    cells = rows.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("source").orderBy("cell")
    cells = cells.withColumn("upto", F.sum("words").over(in_order))
    p, c = plan.alias("p"), cells.alias("c")
    # the cell where the prefix sum first exceeds what is left to take
    cut = (c.join(p, F.col("c.source").eqNullSafe(F.col("p.source")))
           .where(F.col("upto") > F.col("rest"))
           .groupBy(F.col("p.source").alias("source"))
           .agg(F.min(F.struct(F.col("cell"), (F.col("upto") - F.col("words"))
                               .alias("before"))).alias("cut")))
    q = cut.alias("q")
    plan = p.join(q, F.col("p.source").eqNullSafe(F.col("q.source")), "left") \
        .select("p.*", F.col("cut.cell").alias("cut_cell"),
                F.col("cut.before").alias("cut_before"))
    # a row per source: stored, so that the size used by the joins is known
    plan = stored(plan, "mix-plan")

    r, s = rows.alias("r"), plan.alias("s")
    full = r.join(s, F.col("r.source").eqNullSafe(F.col("s.source"))).select(
        F.col("r.id").alias(id_col), F.col("r.source").alias(source_col),
        F.col("r.size").alias("size"), "r.key", "r.cell", "s.source_size",
        "s.target", "s.epochs", "s.rest", "s.cut_cell", "s.cut_before")
    out = [id_col, source_col, "size", "source_size", "target"]
    whole = F.col("epochs") * F.col("size")
    easy = full.where("cell <> cut_cell or cut_cell is null").select(
        *out, (whole + F.when(F.col("cell") < F.col("cut_cell"), F.col("size"))
               .otherwise(F.when(F.col("cut_cell").isNull(), F.least(
                   F.col("size"), F.col("rest"))).otherwise(0)))
        .cast("bigint").alias("taken"))
    # rows that share id and size are alike: one row with their number is summed,
    # and they are written out again in blocks
    alike = full.where("cell = cut_cell").groupBy(
        *out, "key", "cell", "epochs", "rest", "cut_before").agg(
        F.count("*").alias("copies"))
    w = Window.partitionBy(source_col, "cell").orderBy(
        "key", id_col, "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(w), F.lit(0))
    blocks = alike.withColumn("left", F.col("rest") - F.col("cut_before") - before) \
        .withColumn("block", F.explode(F.sequence(
            F.lit(0).cast("bigint"),
            F.floor((F.col("copies") - 1) / COPIES_PER_BLOCK)))) \
        .repartition("key", "size", "block")
    first = F.col("block") * COPIES_PER_BLOCK
    at_cut = blocks.withColumn("copy", F.explode(F.sequence(
        first, F.least(F.col("copies"), first + COPIES_PER_BLOCK) - 1))).select(
        *out, (whole + F.greatest(F.lit(0), F.least(
            F.col("size"), F.col("left") - F.col("copy") * F.col("size"))))
        .cast("bigint").alias("taken"))
    return easy.unionByName(at_cut)


def sql(documents: str = "documents", out: str = "") -> str:
    """The same mix as DuckDB SQL over a relation of documents (one window
    over each whole source instead of cells)."""
    weight = "CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 " \
        "WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END"
    return rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''),
           '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15)
              AS BIGINT) AS k
  FROM {documents}),
per AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size
        FROM sized GROUP BY source),
weighted AS (SELECT source, source_size, CAST({weight} AS DOUBLE) AS w,
                    CAST(2 * source_size AS DOUBLE) AS most,
                    1.5::DOUBLE * sum(source_size) OVER () AS total FROM per),
levels AS (
  SELECT *, row_number() OVER o AS r,
         (total - coalesce(sum(most) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING
                                           AND 1 PRECEDING), 0))
         / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
           AS lvl
  FROM weighted WINDOW o AS (ORDER BY most / w, source NULLS LAST)),
chosen AS (SELECT arg_min(lvl, r) AS lvl FROM levels WHERE lvl <= most / w),
targets AS (
  SELECT source, source_size,
         least(most, coalesce(chosen.lvl * w, most)) AS target
  FROM levels, chosen),
budgets AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
            ELSE CAST(floor(target) AS BIGINT) // source_size END AS epochs
  FROM targets),
ordered AS (
  SELECT s.doc_id, s.source, s.size, b.source_size, b.target, b.epochs,
         CAST(floor(b.target) AS BIGINT) - b.epochs * b.source_size AS rest,
         coalesce(sum(s.size) OVER (PARTITION BY s.source
                  ORDER BY s.k, s.doc_id, s.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, source, size, source_size, target,
       CAST(epochs * size + greatest(0, least(size, rest - before)) AS BIGINT)
         AS taken
FROM ordered{out}"""
