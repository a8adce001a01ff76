"""Approximate nearest neighbours: a hierarchical navigable small-world graph
per shard.

*Index.*  Every vector gets a place in one of ``ceil(rows / SHARD)`` shards,
dealt round robin, so equal rows spread.  A shard is one row of flat arrays: its
distinct vectors (*nodes*), the ids that carry each of them, a level per node
(geometric, from a hash of its place), and per level a table of neighbours,
``2 * LINKS`` wide at the bottom and ``LINKS`` above, -1 where a slot is free.
A node links to the nearest nodes that stand before it on its level, thinned so
that no kept neighbour is nearer to another kept one than to the node; these
links are then made mutual and thinned again.  The candidates are the
``WIDTH`` nearest of all earlier nodes of the shard, found exactly in blocks of
distances, where the usual construction finds them by a search.

*Search.*  Queries, in chunks of bounded size, visit every shard; the chunks are
sent to the shards in blocks of ``SENT_BYTES``, one after the other, so neither the
driver's share nor a shuffle grows with queries times shards.  All queries of a chunk go down the levels together, with one candidate each, and at the
bottom keep the ``ef`` best, expanding the nearest one not yet expanded until
none is left.  Distances are then taken again in double precision on the
original vectors, each node is expanded to its ids, and the k nearest of each
shard are merged by (distance, id).

The graph is approximate; the distances and the order of what is found are
exact.  Measured recall against brute force is in the README.

Results in odd cases: vectors that are null, empty or zero, or hold null or
non-finite components, take no part, neither do rows without an id as
neighbours or queries.  Vectors of different length are never neighbours (each
length has graphs of its own).  Every row is a candidate of its own, also where
ids or vectors repeat; a query leaves out only its own row.  Equal vectors are
one node; of its ids the k + 1 smallest are kept, which is exact, as only these
can be among the k nearest of a query once its own row is left out.
Ties go to the smaller id.  An empty table gives an empty result.  Columns other
than ``vec_id`` and ``embedding`` are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import stored, stored_parts

SHARD = 8192        # rows of a shard
LINKS = 16          # neighbours kept per node above the bottom level
WIDTH = 64          # candidates a node's neighbours are chosen from
EF = 96             # candidates a search keeps at the bottom level
CHUNK = 512         # queries of a chunk
BLOCK = 512         # rows of a block of distances
SENT_BYTES = 1 << 23    # vectors of the queries that are broadcast at once


@dataclass(frozen=True)
class Index:
    shards: DataFrame       # a row per shard and vector length
    vectors: DataFrame      # (row, vec_id, v): the usable vectors
    n_shards: int
    k: int                  # the most neighbours that can be asked for


# -- building a graph (numpy, one shard) ----------------------------------------

def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` and ``b``."""
    d = (a * a).sum(-1)[..., :, None] + (b * b).sum(-1)[..., None, :]
    d -= 2 * (a @ np.swapaxes(b, -1, -2))
    return np.maximum(d, 0, out=d)


def thinned(x: np.ndarray, owner: np.ndarray, cand: np.ndarray,
            dist: np.ndarray, keep: int) -> np.ndarray:
    """Of each owner's candidates (ascending by ``dist``, -1 if none) up to
    ``keep``: first those nearer to the owner than to any one kept before,
    then the nearest of the rest."""
    out = np.full((len(owner), keep), -1, np.int32)
    for lo in range(0, len(owner), BLOCK):
        c, d = cand[lo:lo + BLOCK], dist[lo:lo + BLOCK]
        v = x[np.maximum(c, 0)]
        apart = distances(v, v)
        apart[np.arange(len(c))[:, None], np.arange(c.shape[1]),
              np.arange(c.shape[1])] = np.inf
        kept = np.zeros(c.shape, bool)
        for r in range(c.shape[1]):
            blocked = (kept & (apart[:, r] <= d[:, r, None])).any(1)
            kept[:, r] = (c[:, r] >= 0) & ~blocked & (kept.sum(1) < keep)
        # kept ones first, then the nearest others
        order = np.argsort(np.where(kept, 0, 1) + 2 * (c < 0), axis=1,
                           kind="stable")[:, :keep]
        picked = np.take_along_axis(c, order, 1)
        out[lo:lo + len(c), :picked.shape[1]] = picked
    return out


def nearest_before(x: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For each row the ``width`` nearest of the rows before it."""
    n = len(x)
    cand = np.full((n, width), -1, np.int32)
    dist = np.full((n, width), np.inf, np.float32)
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        d = distances(x[lo:hi], x[:hi])
        d[np.arange(hi)[None, :] >= np.arange(lo, hi)[:, None]] = np.inf
        w = min(width, hi)
        at = np.argpartition(d, w - 1, axis=1)[:, :w]
        got = np.take_along_axis(d, at, 1)
        order = np.argsort(got, axis=1, kind="stable")
        at, got = (np.take_along_axis(z, order, 1) for z in (at, got))
        cand[lo:hi, :w] = np.where(np.isfinite(got), at, -1)
        dist[lo:hi, :w] = got
    return cand, dist


def layer(x: np.ndarray, links: int, width: int) -> np.ndarray:
    """Neighbours of every row of ``x`` within one level."""
    n = len(x)
    out = thinned(x, np.arange(n), *nearest_before(x, width), links)
    # mutual: every link both ways; each node's own ones, and of those that
    # lead back the nearest, up to ``width`` in all, are thinned again
    a = np.repeat(np.arange(n), links)
    b = out.ravel()
    a, b = a[b >= 0], b[b >= 0]
    own = np.repeat([0, 1], len(a))
    a, b = np.concatenate([a, b]), np.concatenate([b, a])
    d = np.empty(len(a), np.float32)
    for lo in range(0, len(a), 1 << 16):
        s = slice(lo, lo + (1 << 16))
        d[s] = ((x[a[s]] - x[b[s]]) ** 2).sum(1)
    order = np.lexsort((b, d, own, a))
    a, b, d = a[order], b[order], d[order]
    rank = np.arange(len(a)) - np.searchsorted(a, a)
    some = rank < width
    cand = np.full((n, width), -1, np.int32)
    dist = np.full((n, width), np.inf, np.float32)
    cand[a[some], rank[some]] = b[some]
    dist[a[some], rank[some]] = d[some]
    order = np.argsort(dist, axis=1, kind="stable")
    return thinned(x, np.arange(n), np.take_along_axis(cand, order, 1),
                   np.take_along_axis(dist, order, 1), links)


def levels(n: int, links: int) -> np.ndarray:
    """The level of each node: 0, and with probability 1/links one more each."""
    u = np.random.default_rng(n).random(n)
    return np.floor(-np.log(1 - u) / np.log(links)).astype(np.int32)


def build_graph(x: np.ndarray, links: int = LINKS, width: int = WIDTH) -> dict:
    """Flat arrays: level of each node, the nodes of each level (``members``,
    from the bottom up; ``sizes``), their neighbours on it (``neighbours``:
    node numbers, row by row) and the node that searches enter at."""
    level = levels(len(x), links)
    members, sizes, neighbours = [], [], []
    for h in range(int(level.max()) + 1):
        on = np.flatnonzero(level >= h).astype(np.int32)
        near = layer(x[on], 2 * links if h == 0 else links, width)
        members.append(on)
        sizes.append(len(on))
        neighbours.append(np.where(near >= 0, on[np.maximum(near, 0)], -1).ravel())
    return {"members": np.concatenate(members).astype(np.int32),
            "sizes": np.array(sizes, np.int32),
            "neighbours": np.concatenate(neighbours).astype(np.int32),
            "entry": int(np.argmax(level))}


# -- searching it (numpy, a chunk of queries at once) -------------------------------

def search_level(x, near, at, q, entry, entry_dist, ef):
    """The ``ef`` best nodes per query on one level and their distances,
    ascending.  ``near``: neighbour rows; ``at``: row of a node (-1: none)."""
    n_q = len(q)
    ids = np.full((n_q, ef), -1, np.int32)
    dist = np.full((n_q, ef), np.inf, np.float32)
    ids[:, :entry.shape[1]], dist[:, :entry.shape[1]] = entry, entry_dist
    done = ids < 0
    seen = np.zeros((n_q, len(x)), bool)
    rows = np.arange(n_q)
    for c in range(entry.shape[1]):
        seen[rows, np.maximum(entry[:, c], 0)] |= entry[:, c] >= 0
    while True:
        best = np.argmin(np.where(done, np.inf, dist), axis=1)
        live = np.flatnonzero(~done[rows, best])
        if not len(live):
            return ids, dist
        best = best[live]
        done[live, best] = True
        c = near[at[ids[live, best]]]
        new = c >= 0
        new &= ~seen[live[:, None], np.maximum(c, 0)]
        r, s = np.nonzero(new)
        node = c[r, s]
        seen[live[r], node] = True
        d = np.full(c.shape, np.inf, np.float32)
        d[r, s] = ((x[node] - q[live[r]]) ** 2).sum(1)
        all_d = np.concatenate([dist[live], d], 1)
        order = np.argsort(all_d, axis=1, kind="stable")[:, :ef]
        dist[live] = np.take_along_axis(all_d, order, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], c], 1), order, 1)
        done[live] = np.take_along_axis(np.concatenate(
            [done[live], ~new], 1), order, 1) | ~np.isfinite(dist[live])


def search_graph(graph: dict, x: np.ndarray, q: np.ndarray, ef: int) -> np.ndarray:
    """The ``ef`` nearest nodes found for each query, -1 where none."""
    sizes = graph["sizes"]
    ends = np.cumsum(sizes)
    width = len(graph["neighbours"]) // max(1, int(sizes[1:].sum() + 2 * sizes[0]))
    found = np.full((len(q), 1), graph["entry"], np.int32)
    dist = ((x[found[:, 0]] - q) ** 2).sum(1)[:, None]
    start = len(graph["neighbours"])
    for h in range(len(sizes) - 1, -1, -1):
        w = width if h else 2 * width
        start -= int(sizes[h]) * w
        near = graph["neighbours"][start:start + int(sizes[h]) * w].reshape(-1, w)
        at = np.full(len(x), -1, np.int32)
        at[graph["members"][ends[h] - sizes[h]:ends[h]]] = np.arange(sizes[h])
        found, dist = search_level(x, near, at, q, found, dist, ef if h == 0 else 1)
    return np.where(np.isfinite(dist), found, -1)


# -- Spark ------------------------------------------------------------------------

def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v: array<double>) of the rows that take part."""
    v = F.col("embedding").cast("array<double>")
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    zero = F.forall(v, lambda c: c == 0)
    return vectors.select("vec_id", v.alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & ~F.coalesce(bad, F.lit(True)) & ~F.coalesce(zero, F.lit(True)))


def build_index(vectors: DataFrame, k: int = 10, shard: int = SHARD) -> Index:
    """Index every usable row of ``vectors`` (vec_id integral, embedding an
    array of numbers).  The index is stored; ``k`` bounds later searches."""
    own = stored(usable(vectors).withColumn(
        "row", F.monotonically_increasing_id()), "ann-vectors")
    n = own.count()
    n_shards = max(1, -(-n // shard))

    def build(batches):
        by_size: dict[int, list] = {}
        for batch in batches:
            v = batch.column(1)
            for i, size in enumerate(np.diff(v.offsets.to_numpy())):
                by_size.setdefault(int(size), []).append(
                    (batch.column(0)[i].as_py(), v[i].values.to_numpy()))
        for size, rows in sorted(by_size.items()):
            ids = np.array([r[0] for r in rows], np.int64)
            data = np.stack([r[1] for r in rows])
            nodes, node = np.unique(data, axis=0, return_inverse=True)
            # nodes in an order that does not follow their values
            order = np.random.default_rng(len(nodes)).permutation(len(nodes))
            place = np.argsort(order)
            node = place[node.ravel()]
            by = np.lexsort((ids, node))
            rank = np.arange(len(by)) - np.searchsorted(node[by], node[by])
            by = by[rank <= k]
            graph = build_graph(nodes[order].astype(np.float32))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([TaskContext.get().partitionId()], pa.int32()),
                "dim": pa.array([size], pa.int32()),
                "nodes": pa.array([nodes[order].ravel()]),
                "ids": pa.array([ids[by]]),
                "id_ends": pa.array([np.cumsum(np.bincount(
                    node[by], minlength=len(nodes)))], pa.list_(pa.int32())),
                **{c: pa.array([graph[c]]) for c in ("members", "sizes",
                                                     "neighbours")},
                "entry": pa.array([graph["entry"]], pa.int32())})
    shards = own.select("vec_id", "v").repartition(n_shards).mapInArrow(
        build, "shard int, dim int, nodes array<double>, ids array<long>, "
        "id_ends array<int>, members array<int>, sizes array<int>, "
        "neighbours array<int>, entry int")
    return Index(stored(shards, "ann-index"), own, n_shards, k)


def _search(k: int, ef: int):
    """Shard rows joined to chunks of queries -> the k nearest per query."""
    def arrays(batch, name, i):
        return batch.column(name)[i].values.to_numpy(zero_copy_only=False)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                exact = arrays(batch, "nodes", i).reshape(-1, dim)
                x = exact.astype(np.float32)
                graph = {c: arrays(batch, c, i) for c in ("members", "sizes",
                                                          "neighbours")}
                graph["entry"] = batch.column("entry")[i].as_py()
                ids, ends = arrays(batch, "ids", i), arrays(batch, "id_ends", i)
                q = arrays(batch, "q", i).reshape(-1, dim)
                own, row = arrays(batch, "q_ids", i), arrays(batch, "q_rows", i)
                found = search_graph(graph, x, q.astype(np.float32), ef)
                out = []
                for j in range(len(q)):
                    node = found[j][found[j] >= 0]
                    d = np.sqrt(((exact[node] - q[j]) ** 2).sum(1))
                    n = np.diff(np.append(0, ends))[node]
                    at = np.repeat(ends[node] - n, n) + np.arange(n.sum()) \
                        - np.repeat(np.cumsum(n) - n, n)
                    c, d = ids[at], np.repeat(d, n)
                    order = np.lexsort((c, d))
                    c, d = c[order], d[order]
                    c, d = c[:k + 1], d[:k + 1]
                    mine = (c == own[j]) & (d == 0)
                    mine[np.argmax(mine) + 1:] = False
                    out.append((np.full(len(c), row[j]), np.full(len(c), own[j]),
                                c, d, mine))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(z)) for z in zip(*out)],
                    names=["row", "query_id", "vec_id", "score", "self"])
    return run


def nearest(index: Index, is_query: Column, k: int = 10, ef: int = EF) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found for every
    indexed row with ``is_query``, its own row left out."""
    if k > index.k:
        raise ValueError(f"the index keeps neighbours for k up to {index.k}")
    q = index.vectors.where(is_query)
    n, n_bytes = q.agg(F.count(F.lit(1)), F.sum(8 * F.size("v"))).first()
    # chunks of queries of one length, of about CHUNK rows each
    n_chunks = max(1, -(-n // CHUNK))
    chunk = F.pmod(F.xxhash64("row"), F.lit(n_chunks))
    chunks = stored(q.select("row", "vec_id", "v", F.size("v").alias("dim"),
                             chunk.alias("chunk")).groupBy("dim", "chunk").agg(
        F.collect_list(F.struct("row", "vec_id", "v")).alias("c")).select(
        "dim", "chunk", F.col("c.row").alias("q_rows"),
        F.col("c.vec_id").alias("q_ids"), F.flatten("c.v").alias("q")),
        "ann-queries")
    # every chunk visits every shard: the shards stay where they are read, some
    # chunks at a time go to all of them
    step = max(1, n_chunks * SENT_BYTES // max(1, n_bytes or 0))
    found = stored_parts((
        index.shards.join(F.broadcast(chunks.where(
            (F.col("chunk") >= lo) & (F.col("chunk") < lo + step))
            .drop("chunk")), "dim").mapInArrow(
            _search(k, ef), "row long, query_id long, vec_id long, score double, "
            "self boolean") for lo in range(0, n_chunks, step)), "ann-found")
    # the query's own row goes (once, where rows repeat)
    nearest_first = Window.partitionBy("row").orderBy("score", "vec_id")
    selves = F.sum(F.col("self").cast("int")).over(nearest_first.rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    rest = found.withColumn("selves", selves) \
        .where(~(F.col("self") & (F.col("selves") == 1)))
    return rest.withColumn("rank", F.row_number().over(nearest_first)) \
        .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
