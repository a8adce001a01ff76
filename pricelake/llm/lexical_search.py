"""Ranked lexical search over per-term posting lists in geometric blocks.

Every query item gets its ``k`` best documents by a sum of integer impacts,
``w * ((10^9 * tf) div (1000 * tf + 8 * m))`` per term they share, where w falls
with the number of documents that hold the term and m grows with the document's
length (``weights``, ``impacts``).  Equal scores go to the smaller doc_id.

*Query set.*  The items are taken in blocks of at most ``QUERY_TERMS`` terms, so
what is sent to the tasks is bounded; each block is held against all documents.

*Index.*  One pass over the texts counts all terms and keeps, per document, its
terms that the block's items hold (a sparse vector).  The documents of a task,
``SHARD`` at a time, make up a shard: flat arrays of vectors and of posting
lists.  A posting list is clustered by similarity: documents have a sketch (a
random projection of their impacts), and each joins the nearest of a few
documents of the list taken at even steps.  Each cluster is a block with its
documents and a summary: per term the largest impact of any of them, for the
list's own term and the commoner terms that share an item with it.  The index is
stored.

*Search.*  A document counts in the list of the rarest of the item's terms that
it holds: there a summary's sum over the item's terms bounds its whole score, as
it holds none of the rarer ones.  A first pass scores the documents of each
shard's most promising block; the k-th best of all these is a floor for the
item.  The second pass scores, best bounds first, whole vectors of the blocks
whose bound reaches the floor and the k-th best found so far; only the others
are skipped, so the result is exact.  The k best of each shard are merged.

Results in odd cases: a null or empty text, or one without terms, is no document
and no query.  Every row is an item or a document of its own, also where ids or
texts repeat; a null doc_id comes after all others of equal score.  Very long
texts are read whole; memory grows with their distinct query terms only.  Empty
tables give an empty result.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import ALNUM_SEP, ascii_lower, stored

QUERY_TERMS = 1 << 17    # terms (summed over the items) of a block of items
SHARD = 1 << 13          # documents of a shard
SHARD_ENTRIES = 1 << 19  # ... or entries of their vectors
BLOCK = 32               # documents per block, on average, of a long list
SKETCH = 16              # numbers in a document's sketch

TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
# flat arrays of a shard, stored as bytes
ARRAYS = {"doc_ids": "<i8", "no_id": "?", "doc_ends": "<i4", "doc_terms": "<i4",
          "doc_impacts": "<i8", "block_terms": "<i4", "block_ends": "<i4",
          "members": "<i4", "top_ends": "<i8", "top_terms": "<i4", "tops": "<i8"}


@dataclass(frozen=True)
class Items:
    """A block of query items (bounded, on the driver): distinct terms of the
    block, and each item's terms by number."""
    ids: list
    vocabulary: dict[bytes, int]
    terms: list[np.ndarray]


def partners(terms: list[np.ndarray], n_terms: int) -> list[np.ndarray]:
    """Per term, itself and the commoner terms that share an item with it.
    Terms are numbered from the rarest."""
    of: list[list] = [[] for _ in range(n_terms)]
    for t in terms:
        for i, x in enumerate(t.tolist()):
            of[x].append(t[i:])
    return [np.unique(np.concatenate(x)) if x else np.zeros(0, np.int32)
            for x in of]


def item_blocks(items: DataFrame, most: int = QUERY_TERMS):
    """The items with any term, in blocks of at most ``most`` terms (an item of
    more is a block of its own)."""
    words = F.split(ascii_lower(F.col("text")), ALNUM_SEP)
    rows = items.select("item_id", F.array_distinct(F.filter(
        words, lambda w: w != "")).alias("w")).where(F.size("w") > 0)
    ids, vocabulary, terms, n = [], {}, [], 0
    for item_id, w in rows.toLocalIterator():
        if ids and n + len(w) > most:
            yield Items(ids, vocabulary, terms)
            ids, vocabulary, terms, n = [], {}, [], 0
        ids.append(item_id)
        terms.append(np.array([vocabulary.setdefault(x.encode(), len(vocabulary))
                               for x in w], np.int32))
        n += len(w)
    if ids:
        yield Items(ids, vocabulary, terms)


def term_vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf) of every document with a term: its number of
    terms, and those of the vocabulary with their occurrences."""
    def run(batches):
        get = vocabulary.get
        for batch in batches:
            ns, terms, tfs = [], [], []
            for text in batch.column(1):
                found = TERM.findall((text.as_py() or "").encode().lower())
                own = Counter(map(get, found))
                own.pop(None, None)
                codes = np.array(sorted(own), np.int32)
                ns.append(len(found))
                terms.append(codes)
                tfs.append(np.array([own[c] for c in codes.tolist()], np.int32))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "n": pa.array(ns, pa.int64()),
                "terms": pa.array(terms, pa.list_(pa.int32())),
                "tf": pa.array(tfs, pa.list_(pa.int32()))})
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, tf array<int>").where("n > 0")


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


def impacts(w, tf, n, n_docs: int, total: int):
    m = 10 + 90 * n * n_docs // total
    return w * (10 ** 9 * tf // (1000 * tf + 8 * m))


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(
        starts - (ends - lens), lens)


def ranges(ends: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of the ranges ``at``, given where each ends."""
    starts = np.where(at > 0, ends[at - 1], 0)
    return starts, ends[at] - starts


def sketches(ends, terms, values, n_terms: int) -> np.ndarray:
    """A unit vector per document: similar impacts, similar direction."""
    signs = np.random.default_rng(1).standard_normal((n_terms, SKETCH)) \
        .astype(np.float32)
    out = np.zeros((len(ends), SKETCH), np.float32)
    doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    for lo in range(0, len(terms), 1 << 18):
        s = slice(lo, lo + (1 << 18))
        part = signs[terms[s]] * values[s, None].astype(np.float32)
        first = np.flatnonzero(np.diff(doc[s], prepend=-1))
        out[doc[s][first]] += np.add.reduceat(part, first)
    norm = np.sqrt((out * out).sum(1, keepdims=True))
    return out / np.where(norm > 0, norm, 1)


def build_shard(ids, no_id, ends, terms, values, cols_of, block=BLOCK) -> dict:
    """Flat arrays of a shard: vectors (terms ascending, so rarest first),
    posting lists in blocks, summaries over the columns of each term."""
    n_terms = len(cols_of)
    sketch = sketches(ends, terms, values, n_terms)
    doc = np.repeat(np.arange(len(ends), dtype=np.int32), np.diff(ends, prepend=0))
    order = np.argsort(terms, kind="stable")
    held, first = np.unique(terms[order], return_index=True)
    column = np.full(n_terms, -1, np.int64)
    out = {c: [] for c in ("block_terms", "sizes", "members", "top_sizes",
                           "top_terms", "tops")}
    for t, starts in zip(held.tolist(), np.split(order, first[1:])):
        docs = doc[starts]
        n_blocks = -(-len(docs) // block)
        of = np.zeros(len(docs), np.int64)
        if n_blocks > 1:
            centres = sketch[docs[np.arange(n_blocks) * len(docs) // n_blocks]]
            of = np.argmax(sketch[docs] @ centres.T, axis=1)
        cols = cols_of[t]
        column[cols] = np.arange(len(cols))
        top = np.zeros((n_blocks, len(cols)), np.int64)
        # of the list's documents the term and all commoner ones, some at a time
        lens = ends[docs] - starts
        step = np.searchsorted(np.cumsum(lens), np.arange(
            1 << 20, lens.sum() + (1 << 20), 1 << 20)) + 1
        lo = 0
        for hi in step.tolist():
            at = spread(starts[lo:hi], lens[lo:hi])
            c = column[terms[at]]
            row = np.repeat(of[lo:hi], lens[lo:hi])
            ok = c >= 0
            np.maximum.at(top, (row[ok], c[ok]), values[at[ok]])
            lo = hi
        column[cols] = -1
        by = np.argsort(of, kind="stable")
        sizes = np.bincount(of, minlength=n_blocks)
        full = sizes > 0
        r, c = np.nonzero(top[full])
        out["block_terms"].append(np.full(full.sum(), t, np.int32))
        out["sizes"].append(sizes[full])
        out["members"].append(docs[by])
        out["top_sizes"].append(np.bincount(r, minlength=int(full.sum())))
        out["top_terms"].append(cols[c].astype(np.int32))
        out["tops"].append(top[full][r, c])
    flat = {c: np.concatenate(x) for c, x in out.items()}
    return {"doc_ids": ids, "no_id": no_id, "doc_ends": ends.astype(np.int32),
            "doc_terms": terms, "doc_impacts": values,
            "block_terms": flat["block_terms"],
            "block_ends": np.cumsum(flat["sizes"]).astype(np.int32),
            "members": flat["members"], "top_ends": np.cumsum(flat["top_sizes"]),
            "top_terms": flat["top_terms"], "tops": flat["tops"]}


def build_index(vectors: DataFrame, items: Items, df: np.ndarray, n_docs: int,
                total: int, shard: int = SHARD,
                ) -> tuple[DataFrame, list[np.ndarray]]:
    """The stored index, a row of flat arrays per shard, and the items' terms
    by their numbers in it."""
    # terms are numbered anew, from the rarest
    rank = np.empty(len(df), np.int32)
    rank[np.argsort(df, kind="stable")] = np.arange(len(df))
    terms_of = [np.sort(rank[t]) for t in items.terms]
    cols_of, w = partners(terms_of, len(df)), weights(np.sort(df), n_docs)

    def make(rows):
        ids = pa.concat_arrays([r[0] for r in rows])
        n, terms, tf = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
        size = np.concatenate([r[4] for r in rows])
        ends, terms = np.cumsum(size), rank[terms]
        order = np.lexsort((terms, np.repeat(np.arange(len(size)), size)))
        terms, tf = terms[order], tf[order]
        values = impacts(w[terms], tf.astype(np.int64), np.repeat(n, size),
                         n_docs, total)
        got = build_shard(ids.fill_null(0).to_numpy(zero_copy_only=False),
                          ids.is_null().to_numpy(zero_copy_only=False),
                          ends, terms, values, cols_of)
        return pa.RecordBatch.from_arrays(
            [pa.array([got[c].astype(t).tobytes()], pa.binary())
             for c, t in ARRAYS.items()], names=list(ARRAYS))

    def run(batches):
        rows, docs, entries = [], 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                terms, tf = part.column("terms"), part.column("tf")
                size = np.diff(terms.offsets.to_numpy())
                # copies, as the batch's memory is used again
                rows.append((part.column("doc_id"), part.column("n").to_numpy().copy(),
                             terms.flatten().to_numpy().copy(),
                             tf.flatten().to_numpy().copy(), size.copy()))
                docs, entries = docs + part.num_rows, entries + int(size.sum())
                if docs >= shard or entries >= SHARD_ENTRIES:
                    yield make(rows)
                    rows, docs, entries = [], 0, 0
        if rows:
            yield make(rows)
    return stored(vectors.where(F.size("terms") > 0).mapInArrow(
        run, ", ".join(f"{c} binary" for c in ARRAYS)),
        "lexical-index"), terms_of


def best(score, ids, no_id, k):
    """Places of the ``k`` best: by score, then id, null ids last."""
    return np.lexsort((ids, no_id, -score))[:k]


def search_shard(s: dict, terms: np.ndarray, n_terms: int, k: int,
                 floor: int | None) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Documents (places in the shard) and scores of the best ``k`` of an item
    that reach ``floor``; without a floor, of the most promising block only.
    Also the number of blocks, and of those whose documents were scored."""
    wanted = np.zeros(n_terms, bool)
    wanted[terms] = True
    # the blocks of the item's lists, and a bound for each
    lo = np.searchsorted(s["block_terms"], terms, "left")
    hi = np.searchsorted(s["block_terms"], terms, "right")
    blocks = spread(lo, hi - lo)
    none = np.zeros(0, np.int64)
    if not len(blocks):
        return none, none, 0, 0
    starts, lens = ranges(s["top_ends"], blocks)
    at = spread(starts, lens)
    value = np.where(wanted[s["top_terms"][at]], s["tops"][at], 0)
    bound = np.add.reduceat(value, np.cumsum(lens) - lens)
    order = np.argsort(-bound, kind="stable")
    blocks, bound = blocks[order], bound[order]
    seen = np.zeros(len(s["doc_ends"]), bool)
    docs, scores, done, step = none, none, 0, 1
    least = max(1, floor or 1)
    while done < len(blocks) and bound[done] >= least:
        some = blocks[done:done + step]
        some = some[bound[done:done + step] >= least]
        starts, lens = ranges(s["block_ends"], some)
        new = np.unique(s["members"][spread(starts, lens)])
        new = new[~seen[new]]
        seen[new] = True
        if len(new):
            starts, lens = ranges(s["doc_ends"], new)
            at = spread(starts, lens)
            value = np.where(wanted[s["doc_terms"][at]], s["doc_impacts"][at], 0)
            score = np.add.reduceat(value, np.cumsum(lens) - lens)
            docs, scores = np.append(docs, new), np.append(scores, score)
            ok = scores >= least
            docs, scores = docs[ok], scores[ok]
            top = best(scores, s["doc_ids"][docs], s["no_id"][docs], k)
            docs, scores = docs[top], scores[top]
        done += len(some)
        step *= 2
        if len(docs) == k:
            least = max(least, int(scores[-1]))
        if floor is None:
            break
    return docs, scores, len(blocks), done


def search(index: DataFrame, ids: list, terms_of: list[np.ndarray],
           n_terms: int, id_type, k: int,
           floors: np.ndarray | None) -> DataFrame:
    """(item, item_id, doc_id, score): per item the ``k`` best of each shard
    (``floors`` given), or the scores of each shard's most promising block."""
    from pyspark.sql.pandas.types import to_arrow_type
    kinds = {"item": pa.int32(), "item_id": to_arrow_type(id_type),
             "doc_id": pa.int64(), "score": pa.int64()}

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                s = {c: np.frombuffer(batch.column(c)[i].as_buffer(), t)
                     for c, t in ARRAYS.items()}
                rows = []
                for q, terms in enumerate(terms_of):
                    docs, scores, _, _ = search_shard(
                        s, terms, n_terms, k,
                        None if floors is None else int(floors[q]))
                    rows += [(q, ids[q], None if s["no_id"][d]
                              else int(s["doc_ids"][d]), int(x))
                             for d, x in zip(docs, scores)]
                cols = list(zip(*rows)) or [()] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, kinds.values())],
                    names=list(kinds))
    return index.mapInArrow(run, f"item int, item_id {id_type.simpleString()}, "
                            "doc_id long, score long")


def floor_of(found: DataFrame, n_items: int, k: int) -> np.ndarray:
    """Per item the k-th best score found (1 where there are fewer): a row per
    item of the block reaches the driver."""
    at = Window.partitionBy("item").orderBy(F.desc("score"))
    out = np.ones(n_items, np.int64)
    for item, score in found.withColumn("r", F.row_number().over(at)).where(
            F.col("r") == k).select("item", "score").collect():
        out[item] = score
    return out


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10,
                  query_terms: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents (doc_id, text)
    of every item (item_id, text)."""
    spark, id_type = docs.sparkSession, items.schema["item_id"].dataType
    order = Window.partitionBy("item").orderBy(
        F.desc("score"), F.asc_nulls_last("doc_id"))
    out = spark.createDataFrame([], f"item_id {id_type.simpleString()}, rank int, "
                                "doc_id long, score long")
    for some in item_blocks(items, query_terms):
        vectors = stored(term_vectors(docs, some.vocabulary), "lexical-vectors")
        n_docs, total = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
        df = np.zeros(len(some.vocabulary), np.int64)
        # at most QUERY_TERMS rows
        for t, n in vectors.select(F.explode("terms").alias("t")) \
                .groupBy("t").count().toLocalIterator():
            df[t] = n
        if not df.any():
            continue
        index, terms_of = build_index(vectors, some, df, n_docs, total)
        ask = (index, some.ids, terms_of, len(df), id_type, k)
        found = search(*ask, floor_of(search(*ask, None), len(some.ids), k))
        best_ = stored(found, "lexical-found").withColumn(
            "rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out = out.unionByName(best_.select("item_id", "rank", "doc_id", "score"))
    return out


SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS doc, regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
sizes AS (SELECT doc, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
tfs AS (SELECT doc, t, count(*) AS tf FROM (SELECT doc, unnest(w) AS t FROM d)
        GROUP BY doc, t),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * df + 1 AS DOUBLE)))
                 AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), whole),
terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t
  FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf)
           // (1000 * tf + 8 * (10 + (90 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM terms JOIN tfs USING (t) JOIN weights USING (t)
       JOIN sizes USING (doc), whole
  GROUP BY item_id, doc, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id
                               ORDER BY score DESC, doc_id) AS rank
  FROM scored WHERE score > 0)
WHERE rank <= 10"""
