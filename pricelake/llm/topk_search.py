"""Exact top-k search with a pivot-distance index.

Components become floor(1024 * x); the score is the integer inner product.
Every vector x gets one more coordinate sqrt(M - |x|^2), M being the largest
squared norm, and queries get 0 there: then
``distance(q, x)^2 = |q|^2 + M - 2 <q, x>``, so the largest scores are the
nearest vectors and the triangle inequality holds.

*Index.*  Pivots are centres fitted on a bounded sample (``SAMPLE`` vectors
with the smallest hashes).  Every vector is keyed by (nearest pivot, ring),
ring = its distance cut into annuli of equal width.  A ring with more than
``CELL`` vectors is dealt over several cells by hash, so no cell grows with
the data, not even the ring of a vector that a third of all rows repeat.

*Search.*  Queries travel in chunks of at most ``CHUNK``.  First each is held
against the cell it lies in, which gives a k-th score.  Then it is sent to the
cells of every ring that the triangle inequality
``|d(q, p) - d(x, p)| <= d(q, x)`` cannot rule out.  A task holds one cell at a
time and streams the chunks past it; the bound tightens as scores come in.
Only k rows per query and task are shuffled for the final ranking.  The driver
gets the sample, the pivots and one row per ring, all of bounded size.

Defined cases: null ids, null vectors and vectors with a null or non-finite
component take no part; vectors of different length are compared on their
common components; rows that share a vec_id, with other vectors or the same
one, are rows of their own, as queries (ranked together, by query_id) and as
candidates of other ids; fewer than k candidates give fewer rows; ties go to
the smaller vec_id.
Scores are 64-bit integers; larger inner products are not supported.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import stored

K = 10
SCALE = 1024
PIVOTS = 16
MAX_RINGS = 64       # annuli of a pivot; fewer for small tables
SAMPLE = 4096
CELL = 4096          # vectors that one cell is meant to hold
CHUNK = 32           # queries of a chunk
HELD_CHUNKS = 256    # chunks whose best scores a task keeps at once
SLACK = 1e-6         # relative; covers the rounding of distances


def scaled(vectors: DataFrame, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """vec_id, v (array of bigint): the valid rows."""
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c)
                    & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()
                         & F.coalesce(fine, F.lit(False)))
    return (rows.select(F.col(id_col).cast("bigint").alias("vec_id"),
                        x.alias("x"))
            .select("vec_id", F.transform("x", lambda c: F.floor(c * SCALE)
                                          .cast("bigint")).alias("v")))


def _numbered(vectors: DataFrame) -> DataFrame:
    """rid (a number of its own for every row), vec_id, v."""
    return stored(vectors.select(F.monotonically_increasing_id().alias("rid"),
                                 "vec_id", "v"), "topk-vectors")


def _matrix(col, dim: int) -> np.ndarray:
    """Rows of an Arrow list column, filled with 0 up to ``dim``."""
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    off = np.asarray(col.offsets)
    flat = np.asarray(col.values)
    out = np.zeros((len(col), dim), np.float64)
    size = np.diff(off)
    if len(size) and (size == dim).all():
        out[:] = flat[off[0]:off[-1]].reshape(-1, dim)
    else:
        for i, (a, b) in enumerate(zip(off[:-1], off[1:])):
            out[i, :b - a] = flat[a:b]
    return out


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    norm = (x * x).sum(1)
    return np.hstack([x, np.sqrt(np.maximum(most - norm, 0))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(d, 0))


def fit_pivots(sample: np.ndarray, n: int, rounds: int = 5) -> np.ndarray:
    """Centres of the sample: farthest-first start, then Lloyd's rounds."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    centres = [sample[0]]
    d = ((sample - sample[0]) ** 2).sum(1)
    while len(centres) < n and d.max() > 0:
        centres.append(sample[int(d.argmax())])
        d = np.minimum(d, ((sample - centres[-1]) ** 2).sum(1))
    c = np.array(centres)
    for _ in range(rounds):
        near = _distances(sample, c).argmin(1)
        for j in range(len(c)):
            own = sample[near == j]
            if len(own):
                c[j] = own.mean(0)
    return c


class Index:
    """The stored index and its small facts.

    ``rows``: cell, pivot, dist, rid, vec_id, v.  ``rings``: (pivot, ring) ->
    (smallest, largest distance, first cell, cells).
    """

    def __init__(self, rows, pivots, most, dim, width, rings):
        self.rows, self.pivots, self.most, self.dim = rows, pivots, most, dim
        self.width, self.rings = width, rings


def build_index(vectors: DataFrame, id_col: str = "vec_id",
                vec_col: str = "embedding", pivots: int = PIVOTS) -> Index:
    base = _numbered(scaled(vectors, id_col, vec_col))
    norm = F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double")
                       * c.cast("double"))
    facts = base.agg(F.max(norm), F.max(F.size("v")), F.count("*")).first()
    most, dim, n = float(facts[0] or 0.0), int(facts[1] or 0), facts[2]
    sample = (base.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE)
              .select("v").toArrow())
    lifted = _lifted(_matrix(sample.column(0), dim), most)
    centres = fit_pivots(lifted, pivots)
    rings = int(min(MAX_RINGS, max(4, n // (CELL * pivots))))
    near = _distances(lifted, centres).min(1) if len(lifted) else np.zeros(1)
    width = max(float(near.max()) / rings, 1e-9)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _distances(_lifted(_matrix(batch.column(2), dim), most), centres)
            p = d.argmin(1)
            dist = d[np.arange(len(d)), p]
            ring = np.minimum(dist // width, 2 * rings).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p.astype(np.int32)), pa.array(ring), pa.array(dist),
                 *batch.columns],
                names=["pivot", "ring", "dist", "rid", "vec_id", "v"])

    rows = stored(base.mapInArrow(key, "pivot int, ring int, dist double, "
                                  "rid bigint, vec_id bigint, v array<bigint>"),
                  "topk-keyed")
    found, first = {}, 0
    for r in rows.groupBy("pivot", "ring").agg(
            F.min("dist"), F.max("dist"), F.count("*")) \
            .sort("pivot", "ring").collect():
        cells = -(-r[4] // CELL)
        found[(r[0], r[1])] = (r[2], r[3], first, cells)
        first += cells
    spark = vectors.sparkSession
    facts = spark.createDataFrame(
        [(p, r, v[2], v[3]) for (p, r), v in found.items()],
        "pivot int, ring int, first int, cells int")
    rows = rows.join(F.broadcast(facts), ["pivot", "ring"]).select(
        (F.col("first") + F.pmod(F.xxhash64("rid"), F.col("cells"))
         .cast("int")).alias("cell"), "pivot", "ring", "dist", "rid", "vec_id", "v")
    return Index(rows, centres, most, dim, width, found)


def _reach(qq: float, most: float, score: float) -> float:
    """Distance beyond which no vector scores ``score`` or more."""
    d2 = qq + most - 2.0 * float(score)
    return float(np.sqrt(max(d2, 0.0)) * (1 + SLACK)
                 + SLACK * np.sqrt(qq + most))


def _chunks(queries: DataFrame, index: Index, own_cell: bool) -> DataFrame:
    """Query rows (cell, rid, vec_id, v, kth) -> chunk rows sent to cells: to their
    own, or to all that the triangle inequality leaves."""
    dim, most, pivots, rings = index.dim, index.most, index.pivots, index.rings

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = np.asarray(batch.column(0))
            ids = np.stack([np.asarray(batch.column(i)) for i in (1, 2)])
            q = _matrix(batch.column(3), dim)
            kth = batch.column(4).to_pylist()
            cut = [0]
            for i in range(1, len(cell)):
                if i - cut[-1] >= CHUNK or own_cell and cell[i] != cell[i - 1]:
                    cut.append(i)
            out = []
            for a, b in zip(cut, [*cut[1:], len(cell)]):
                if a == b:
                    continue
                qq = (q[a:b] * q[a:b]).sum(1)
                reach = np.array([
                    np.inf if s is None else _reach(n, most, s)
                    for n, s in zip(qq, kth[a:b])])
                if own_cell:
                    to = [int(cell[a])]
                else:
                    d = _distances(np.hstack([q[a:b], np.zeros((b - a, 1))]),
                                   pivots)
                    to = [c for (p, _), (lo, hi, first, n) in rings.items()
                          if (np.maximum(d[:, p] - hi, lo - d[:, p])
                              <= reach).any()
                          for c in range(first, first + n)]
                vals = (int(ids[0, a]), ids[:, a:b].tobytes(),
                        q[a:b].astype(np.int64).tobytes(), reach.tobytes())
                out += [(c, *vals) for c in to]
                if len(out) >= 2000:
                    yield _chunk_batch(out)
                    out = []
            if out:
                yield _chunk_batch(out)

    return queries.select("cell", "rid", "vec_id", "v", "kth").mapInArrow(
        send, "cell int, chunk bigint, ids binary, qs binary, reach binary")


def _chunk_batch(rows):
    kinds = [pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), t) for c, t in zip(zip(*rows), kinds)],
        names=["cell", "chunk", "ids", "qs", "reach"])


class _Chunk:
    """The queries of a chunk with their best scores in this task."""

    def __init__(self, ids, qs, reach, dim, most, pivots):
        self.rids, self.ids = np.frombuffer(ids, np.int64).reshape(2, -1)
        self.q = np.frombuffer(qs, np.int64).reshape(len(self.ids), dim)
        self.reach = np.frombuffer(reach).copy()
        x = self.q.astype(np.float64)
        self.qq = (x * x).sum(1)
        self.d = _distances(np.hstack([x, np.zeros((len(x), 1))]), pivots)
        self.score = [np.zeros(0, np.int64)] * len(x)
        self.name = [np.zeros((2, 0), np.int64)] * len(x)    # rid, vec_id

    def search(self, pivot, lo, hi, names, x, xf, most, k):
        live = np.flatnonzero(np.maximum(self.d[:, pivot] - hi,
                                         lo - self.d[:, pivot]) <= self.reach)
        if not len(live):
            return
        # float64 sums of integers below 2**53 are exact
        s = self.q[live] @ x.T if xf is None else \
            (self.q[live].astype(np.float64) @ xf.T).astype(np.int64)
        for row, i in zip(s, live):
            sel = names[1] != self.ids[i]
            if len(self.score[i]) >= k:
                sel &= row >= self.score[i][-1]
            row, own = row[sel], names[:, sel]
            if len(row) > 4 * k:
                least = np.partition(row, len(row) - k)[len(row) - k]
                row, own = row[row >= least], own[:, row >= least]
            if not len(row):
                continue
            row = np.concatenate([self.score[i], row])
            own = np.concatenate([self.name[i], own], axis=1)
            top = np.lexsort((*own, -row))[:k]
            self.score[i], self.name[i] = row[top], own[:, top]
            if len(top) == k:
                self.reach[i] = min(self.reach[i],
                                    _reach(self.qq[i], most, row[top[-1]]))


def _search(index: Index, chunks: DataFrame, k: int) -> DataFrame:
    """query, query_id, rid, vec_id, score: the best k of each query row and
    task; query and rid are row numbers."""
    dim, most, pivots = index.dim, index.most, index.pivots
    exact = most < 2.0 ** 52

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Chunk] = {}
        cell, parts, block = None, [], None

        def results():
            cols = ([], [], [], [], [])
            for c in held.values():
                for i, score in enumerate(c.score):
                    cols[0].append(np.full(len(score), c.rids[i]))
                    cols[1].append(np.full(len(score), c.ids[i]))
                    cols[2].append(c.name[i][0])
                    cols[3].append(c.name[i][1])
                    cols[4].append(score)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(0, np.int64), *c])
                          .astype(np.int64)) for c in cols],
                names=["query", "query_id", "rid", "vec_id", "score"])

        for batch in batches:
            cells = np.asarray(batch.column(0))
            # within a cell the index rows come first
            is_row = np.asarray(batch.column(1)) == 0
            cut = np.flatnonzero((np.diff(cells) != 0)
                                 | (is_row[1:] != is_row[:-1])) + 1
            for a, b in zip([0, *cut], [*cut, len(cells)]):
                if a == b:
                    continue
                if cell != cells[a]:
                    cell, parts, block = cells[a], [], None
                if is_row[a]:
                    own = batch.slice(a, b - a)
                    parts.append((int(own.column(2)[0].as_py()),
                                  np.asarray(own.column(3)),
                                  np.stack([np.asarray(own.column(i))
                                            for i in (4, 5)]),
                                  _matrix(own.column(6), dim)))
                    continue
                if not parts:
                    continue
                if block is None:
                    dist = np.concatenate([p[1] for p in parts])
                    xf = np.concatenate([p[3] for p in parts])
                    block = (parts[0][0], dist.min(), dist.max(),
                             np.concatenate([p[2] for p in parts], axis=1),
                             xf.astype(np.int64), xf if exact else None)
                for j in range(a, b):
                    name = batch.column(7)[j].as_py()
                    if name not in held:
                        if len(held) >= HELD_CHUNKS:
                            yield results()
                        held[name] = _Chunk(
                            batch.column(8)[j].as_py(), batch.column(9)[j].as_py(),
                            batch.column(10)[j].as_py(), dim, most, pivots)
                    held[name].search(*block, most, k)
        yield results()

    rows = index.rows.select(
        "cell", F.lit(0).alias("kind"), "pivot", "dist", "rid", "vec_id", "v",
        F.lit(None).cast("bigint").alias("chunk"),
        *[F.lit(None).cast("binary").alias(c) for c in ("ids", "qs", "reach")])
    sent = chunks.select(
        "cell", F.lit(1).alias("kind"), F.lit(None).cast("int").alias("pivot"),
        F.lit(None).cast("double").alias("dist"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("rid", "vec_id")],
        F.lit(None).cast("array<bigint>").alias("v"), "chunk", "ids", "qs",
        "reach")
    return (rows.unionByName(sent).repartition("cell")
            .sortWithinPartitions("cell", "kind")
            .mapInArrow(run, "query bigint, query_id bigint, rid bigint, "
                             "vec_id bigint, score bigint"))


def top_k(index: Index, is_query, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score for the indexed rows where ``is_query``."""
    queries = stored(index.rows.where(is_query), "topk-queries")
    none = F.lit(None).cast("bigint").alias("kth")
    # unsorted rows would only make smaller chunks
    near = _chunks(queries.repartition("cell").sortWithinPartitions("cell")
                   .select("cell", "rid", "vec_id", "v", none), index, True)
    near = stored(_search(index, near, k), "topk-near")

    def ranked(found, by):
        by_score = Window.partitionBy(by).orderBy(F.col("score").desc(), "vec_id")
        once = found.groupBy("query", "query_id", "rid", "vec_id").agg(
            F.max("score").alias("score"))
        return once.withColumn("rank", F.row_number().over(by_score)) \
            .where(F.col("rank") <= k)
    kth = ranked(near, "query").where(F.col("rank") == k).select(
        F.col("query").alias("rid"), F.col("score").alias("kth"))
    known = queries.join(kth, "rid", "left").repartition("pivot", "ring") \
        .sortWithinPartitions("pivot", "ring", "dist")
    far = _search(index, _chunks(known, index, False), k)
    return ranked(far.unionByName(near), "query_id").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
