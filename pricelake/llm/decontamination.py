"""Benchmark decontamination with a distributed positional inverted index.

Words are runs of digits, letters a-z (A-Z lower-cased) and non-ASCII
characters.  A benchmark item gives all windows of ``WINDOW`` consecutive
words; an item with fewer words is one window.

1. The corpus frequency of every test term is counted over all documents.  A
   window with a term that no document holds cannot occur and is left out.
2. Each window names its rarest terms (``LISTS`` of them, ties by offset).
   One pass over the texts stores the postings (document, term, position) of
   all those terms; a posting of a term that is some window's rarest also
   keeps its neighbouring words.  Positions are preselected by a hashed bit
   table of fixed size, the join with the terms that follows is exact.
3. Per window the postings of the rarest term, moved by its offset, are
   intersected with the offset-adjusted list of the next term; the neighbour
   words then confirm the exact phrase or, with ``slop`` > 0, that all words
   of the window lie together within its length plus ``slop`` words.
4. Hit words are the union of the matched intervals of a document.

Everything is joins, partial aggregates and array functions.  A passage that
many documents share only makes as many rows as it has occurrences; hot terms
are split by Spark's skew join; tables made from the benchmark are stored
first, so that Spark broadcasts them only below its own size threshold.

Defined cases: null and empty texts have no words; repeated documents, also
under one id, each get a row; an item without words never matches; items with
a null id mark words but are not counted or listed; an empty benchmark leaves
every document clean.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import ALNUM_SEP, ascii_lower, stored

WINDOW = 10
LISTS = 2
BITS = 1 << 17


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))),
                                  ALNUM_SEP), "")


def item_windows(items: DataFrame, id_col: str = "item_id",
                 text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """w (the words joined by blanks), words, item_id: distinct."""
    rows = items.select(F.col(id_col).alias("item_id"),
                        words_of(F.col(text_col)).alias("all"))
    n = F.least(F.lit(window), F.size("all"))
    at = F.explode(F.sequence(F.lit(0), F.size("all") - n))
    rows = rows.where(F.size("all") > 0).select("item_id", "all", at.alias("i"))
    rows = rows.select("item_id", F.slice("all", F.col("i") + 1, n)
                       .alias("words"))
    return rows.select(F.array_join("words", " ").alias("w"), "words",
                       "item_id").distinct()


def _bit_table(df: DataFrame) -> bytes:
    """Per hash bucket of terms: 0 nothing, 1 a listed term, 2 a rarest one."""
    table = bytearray(BITS)
    rows = df.groupBy(_bucket(F.col("term")).alias("b")).agg(
        F.max(F.when(F.col("rarest"), 2).otherwise(1)))
    for b, kind in rows.toLocalIterator():     # at most BITS rows
        table[b] = kind
    return bytes(table)


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BITS)).cast("int")


class PhraseIndex:
    """``docs``: rid, doc_id, n_words.  ``postings``: rid, term, pos, first,
    near.  ``windows``: w, words, lists.  ``items``: w, item_id."""

    def __init__(self, docs, postings, windows, items, slop):
        self.docs, self.postings = docs, postings
        self.windows, self.items, self.slop = windows, items, slop


def build_index(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", item_col: str = "item_id",
                item_text: str = "text", window: int = WINDOW,
                slop: int = 0, carry: tuple[str, ...] = ()) -> PhraseIndex:
    pairs = stored(item_windows(items, item_col, item_text, window),
                   "decon-windows")
    terms = stored(pairs.select(F.explode("words").alias("term")).distinct(),
                   "decon-terms")
    counts = stored(
        docs.select(F.explode(words_of(F.col(text_col))).alias("term"))
        .join(terms, "term").groupBy("term").agg(F.count("*").alias("n")),
        "decon-counts")

    listed = (pairs.select("w", "words").distinct()
              .select("w", "words", F.posexplode("words").alias("off", "term"))
              .join(counts, "term")
              .groupBy("w", "words")
              .agg(F.sort_array(F.collect_list(F.struct("n", "off", "term")))
                   .alias("lists"))
              .where(F.size("lists") == F.size("words"))
              .select("w", "words", F.slice("lists", 1, LISTS).alias("lists")))
    windows = stored(listed, "decon-lists")
    used = stored(
        windows.select(F.posexplode("lists").alias("rank", "l"))
        .groupBy(F.col("l.term").alias("term"))
        .agg((F.min("rank") == 0).alias("rarest")), "decon-used")

    bits = F.lit(bytearray(_bit_table(used)))
    reach = window - 1 + slop
    kind = lambda term: F.substring(bits, _bucket(term) + 1, F.lit(1))
    w = F.col("words")
    marks = F.filter(
        F.transform(w, lambda t, i: F.struct(i.alias("pos"), t.alias("term"),
                                             kind(t).alias("k"))),
        lambda s: s["k"] != F.lit(bytearray(1)))
    hits = F.transform(marks, lambda s: F.struct(
        s["pos"].alias("pos"), s["term"].alias("term"),
        F.greatest(s["pos"] - reach, F.lit(0)).alias("first"),
        F.when(s["k"] == F.lit(bytearray(b"\x02")), F.slice(
            w, F.greatest(s["pos"] - reach, F.lit(0)) + 1,
            F.least(s["pos"], F.lit(reach)) + reach + 1)).alias("near")))
    per_doc = docs.select(F.monotonically_increasing_id().alias("rid"),
                          F.col(id_col).alias("doc_id"),
                          *[F.col(c) for c in carry],
                          words_of(F.col(text_col)).alias("words"))
    per_doc = stored(per_doc.select(
        "rid", "doc_id", *carry, F.size("words").cast("bigint").alias("n_words"),
        hits.alias("hits")), "decon-postings")
    postings = (per_doc.select("rid", F.explode("hits").alias("h"))
                .select("rid", "h.*").join(used, "term"))
    return PhraseIndex(per_doc.drop("hits"), postings, windows,
                       pairs.select("w", "item_id"), slop)


def matches(index: PhraseIndex) -> DataFrame:
    """rid, start, n (words), w, exact: every place where a window occurs
    (``start`` is that of the exact phrase, else of the neighbourhood)."""
    first, second = F.col("lists")[0], F.get(F.col("lists"), F.lit(1))
    windows = index.windows.select(
        first["term"].alias("term"), first["off"].alias("off"), "w", "words",
        second["term"].alias("term2"), second["off"].alias("off2"))
    found = (index.postings.where("rarest").join(windows, "term")
             .withColumn("start", F.col("pos") - F.col("off")))
    n = F.size("words")
    phrase = F.slice("near", F.col("start") - F.col("first") + 1, n)
    out = ["rid", "start", n.alias("n"), "w"]
    exact = found.where("start >= 0")
    lists = index.postings.select(F.col("rid").alias("rid2"),
                                  F.col("term").alias("t2"),
                                  F.col("pos").alias("pos2"))
    both = exact.where("term2 is not null").join(
        lists, (F.col("rid") == F.col("rid2")) & (F.col("term2") == F.col("t2"))
        & (F.col("start") + F.col("off2") == F.col("pos2")), "left_semi")
    exact = both.unionByName(exact.where("term2 is null")) \
        .where(phrase == F.col("words")).select(*out, F.lit(True).alias("exact"))
    if not index.slop:
        return exact
    span = n + index.slop
    at = F.filter(F.sequence(F.lit(0), F.greatest(
        F.size("near") - span, F.lit(0))), lambda s: F.size(F.array_except(
            F.col("words"), F.slice("near", s + 1, span))) == 0)
    close = (found.withColumn("at", at).where(F.size("at") > 0)
             .where(~F.coalesce(phrase == F.col("words"), F.lit(False))
                    | (F.col("start") < 0))
             .select("rid", (F.col("first") + F.col("at")[0]).alias("start"),
                     span.alias("n"), "w", F.lit(False).alias("exact")))
    return exact.unionByName(close.distinct())


def contamination(index: PhraseIndex, found: DataFrame | None = None,
                  ) -> DataFrame:
    """One row per document: its columns, n_hit, n_items, items_sha256 and
    contaminated, from the exact matches."""
    if found is None:
        found = matches(index)
    found = stored(found.where("exact").select("rid", "start", "n", "w"),
                   "decon-found")
    in_doc = Window.partitionBy("rid").orderBy("start", "n")
    end = F.col("start") + F.col("n")
    upto = F.max(end).over(in_doc.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), end - F.greatest(
        F.col("start"), F.coalesce(upto, F.lit(0))))
    hit = (found.select("rid", "start", "n").distinct()
           .withColumn("new", new).groupBy("rid")
           .agg(F.sum("new").alias("n_hit")))
    items = (found.select("rid", "w").distinct().join(index.items, "w")
             .select("rid", "item_id").distinct().groupBy("rid")
             .agg(F.count("item_id").alias("n_items"),
                  F.array_join(F.sort_array(F.collect_list(
                      F.col("item_id").cast("string"))), ",").alias("items")))
    per_doc = index.docs.join(hit, "rid", "left").join(items, "rid", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    return per_doc.withColumns({
        "n_hit": count("n_hit"), "n_items": count("n_items"),
        "items_sha256": F.sha2(F.coalesce("items", F.lit("")), 256)}) \
        .withColumn("contaminated", F.col("n_hit") > 0).drop("rid", "items")


SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM documents),
b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
  FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
         words[i + 1 : i + least(10, len(words))] AS w
  FROM (SELECT item_id, words, unnest(range(0, len(words)
               - least(10, len(words)) + 1)) AS i FROM b WHERE len(words) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
places AS (
  SELECT doc_id, n, i, words[i + 1 : i + n] AS w
  FROM (SELECT doc_id, words, n, unnest(range(0, len(words) - n + 1)) AS i
        FROM d, lens WHERE len(words) >= n)),
found AS (SELECT p.doc_id, p.i, p.n, wins.item_id
          FROM places p JOIN wins ON p.n = wins.n AND p.w = wins.w),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found)
        GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items,
               string_agg(s, ',' ORDER BY s) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM found)
        GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
       CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""
