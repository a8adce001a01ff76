"""Exact n-gram Jaccard join by vertical partitioning.

A document's set holds the distinct 4-word shingles of its whole text (A-Z
lower-cased, words split at white space; a shorter text is one shingle).  Two
sets link when ``100 * |A and B| >= 85 * |A or B|``.

Sets are 64-bit shingle hashes in one global order: rare shingles by hash,
then the frequent ones by frequency.  Equal sets are one *node*, named by the
hash of the set, so copies never meet as pairs.

1. One pass stores each document's set size, node and parity bitmap, and
   counts the shingles that repeat within a batch of documents; those counts
   add up to the table of frequent shingles, of at most ``HOT_ROWS`` entries by
   construction.  (Any fixed order is right; this one keeps prefixes rare.)
2. A second pass emits each set's prefix: sets that link share at least m
   shingles in the first ``n - ceil(0.85 n) + m`` of the global order, for m of
   2.5 % of the set (1 at least).  Prefix rows meet by shingle; a frequent
   shingle's rows are dealt over ``SALT`` tasks.
3. Each node is held against one centre, the least node it meets most often.
   The order is cut into ``FRAGMENTS`` ranges; overlaps are counted range by
   range and summed per pair.  Links found are contracted to components; for
   members with ``NEAR`` % or more in common with their centre the symmetric
   difference to it is kept.
4. Members of one centre: ``|x ^ y| = |dx| + |dy| - 2 |dx & dy|`` for their
   differences dx, dy to it.  A link needs so many common elements that the
   rarest few of the smaller difference meet the rarest of the larger (a prefix
   filter).  Members are first held against a few leaders each and linked ones
   contracted, in ``ROUNDS``; then all pairs still in different components are
   made and counted.  So a large group of copies that are too far from their
   centre, but link among themselves, is not expanded into pairs, and no set is
   read again.
5. All other pairs in different components come from common prefix shingles: m
   of them, in prefixes cut to the pair's two sizes, bounded by places; shingles
   with the same nodes count as one bundle, and a pair is made at the first
   bundle it shares.  What is left is counted as in 3.

No link that could join components is missed, and copies and near copies are
not expanded into all pairs.  Before sets travel, parity bitmaps rule pairs out
(bits that differ need differing shingles).

The node name is a 64-bit hash: among 10^9 different sets the chance that any
two get one name is about 3 %; nothing else is approximate.

Defined cases: null, empty and blank texts have no shingle and are linked with
nothing (component: their own id); repeated rows and ids are documents of
their own; ``component_id`` is the smallest id reachable, null ids aside (null
if there is no other).  Ids must be integers.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm import textkernel as tk
from pricelake.llm.common import (discard, hashed_set, is_in, stored,
                                  stored_at)
from pricelake.llm.graph import components
from pricelake.llm.streaming_groups import SharedGroups

N = 4
PERCENT = 85
HOT = 32              # documents from which on a shingle counts as frequent
HOT_ROWS = 1 << 20    # most frequent shingles that are kept
SALT = 64
SHARE = 40            # one shingle in so many of a set must meet in the prefix
FRAGMENTS = 8
NEAR = 60             # per cent: members whose difference to the centre is kept
LEADERS = 3           # leaders that a member is held against in a round
ROUNDS = 2            # of leader pairs, before all pairs that are left
MEMBERS = 4096        # sets that one copy of a centre is held against
FIRST = 32            # bundles of a node that its later ones know
PARITY_BITS = 512
NEED_BITS = 1 << 23   # size of the hashed set of documents read again

_U = np.uint64
_MULT = [_U(int(x) | 1) for x in tk.mix(np.arange(1, N + 2, dtype=np.uint64)
                                        * tk.BASE)]


def least_overlap(n: int) -> int:
    """Fewest common shingles of a set of n with any set it links to."""
    return -(-PERCENT * n // 100)


def least_met(n):
    """Prefix shingles that a set of n shares with any set it links to, if the
    other set's number is not less."""
    return max(1, n // SHARE)


def _least_met(n: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(n / SHARE))


def _least_for(n: Column) -> Column:
    """Prefix shingles that a set of n shares with the smallest it links to."""
    return _least_met(F.ceil(n * PERCENT / 100))


def doc_sets(data, off) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every document of a chunk."""
    starts, ends, doc = tk.words(data, off, tk.NONSPACE)
    h = tk.string_hashes(data, starts, ends)
    n = len(off) - 1
    cut = np.append(np.searchsorted(doc, np.arange(n)), len(doc))
    with np.errstate(over="ignore"):
        if len(h) >= N:
            m = len(h) - N + 1
            s = sum((h[j:j + m] * _MULT[j] for j in range(1, N)), h[:m] * _MULT[0])
            s = tk.mix(s)
        out = []
        for a, b in zip(cut[:-1], cut[1:]):
            if b - a >= N:
                x = np.sort(s[a:b - N + 1])
                keep = np.ones(len(x), bool)
                np.not_equal(x[1:], x[:-1], out=keep[1:])
                out.append(x[keep])
            elif b > a:
                one = _U(b - a) * _MULT[N]
                for j in range(a, b):
                    one = tk.mix(np.array([one + h[j] * _MULT[0]]))[0]
                out.append(np.array([one], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def _node(x: np.ndarray) -> np.uint64:
    with np.errstate(over="ignore"):
        return tk.mix(np.array([tk.mix(x ^ tk.BASE).sum(dtype=np.uint64)
                                + _U(len(x)) * _MULT[0]]))[0]


def _tag(ids: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Names a (document id, node); rows that are no representative differ."""
    with np.errstate(over="ignore"):
        return tk.mix(nodes ^ tk.mix(ids.view(np.uint64) * tk.BASE))


def _sets(batch) -> Iterator[tuple[int, np.ndarray]]:
    data, off = tk.buffers(batch.column(1))
    for a, b in tk.doc_chunks(off):
        for i, x in enumerate(doc_sets(data[off[a]:off[b]], off[a:b + 1] - off[a])):
            yield a + i, x


def _ids(batch) -> np.ndarray:
    import pyarrow.compute as pc
    return np.asarray(pc.fill_null(batch.column(0), -1)).astype(np.int64)


def _rows(kinds: dict, cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, kinds.values())], names=list(kinds))


def set_table(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, node, tag, bits; and, with the first row of a batch, the
    shingles that repeat within the batch (common) and how often (times)."""
    kinds = {"n": pa.int64(), "node": pa.int64(), "tag": pa.int64(),
             "bits": pa.binary(), "common": pa.list_(pa.int64()),
             "times": pa.list_(pa.int32())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, nodes, bits, every = [], [], [], []
            for _, x in _sets(batch):
                n.append(len(x))
                nodes.append(_node(x))
                odd = np.bincount((x & _U(PARITY_BITS - 1)).astype(np.int64),
                                  minlength=PARITY_BITS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).tobytes())
                every.append(x)
            if not n:
                continue
            keys, times = np.unique(np.concatenate(every), return_counts=True)
            many = times > 1
            none = [None] * (len(n) - 1)
            nodes = np.array(nodes, np.uint64)
            tags = _tag(_ids(batch), nodes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *_rows(
                    kinds, (n, nodes.view(np.int64), tags.view(np.int64), bits,
                            [keys[many].view(np.int64), *none],
                            [times[many].astype(np.int32), *none])).columns],
                names=["doc_id", *kinds])
    return docs.select(id_col, text_col).mapInArrow(
        run, "doc_id long, n long, node long, tag long, bits binary, "
        "common array<long>, times array<int>")


def frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles (sorted hashes) and their rank by frequency.

    Their bound rises with the input, so at most ``HOT_ROWS`` reach it."""
    total = sets.agg(F.sum(F.size("common"))).first()[0] or 0
    bound = max(HOT, -(-total // HOT_ROWS))
    found = (sets.where("common is not null")
             .select(F.explode(F.arrays_zip("common", "times")).alias("r"))
             .groupBy(F.col("r.common").alias("k"))
             .agg(F.sum("r.times").alias("c"))
             .where(F.col("c") >= bound).toArrow())
    keys = np.asarray(found.column(0)).view(np.uint64) if len(found) \
        else np.zeros(0, np.uint64)
    count = np.asarray(found.column(1)) if len(found) else np.zeros(0)
    order = np.argsort(keys)
    keys, count = keys[order], count[order]
    rank = np.empty(len(keys), np.int64)
    rank[np.lexsort((keys, count))] = np.arange(len(keys))
    return keys, rank


def prefix_rows(docs: DataFrame, id_col: str, text_col: str,
                hot: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """k (shingle), salt, node, n, pos (place in the global order)."""
    keys, rank = hot
    kinds = {"k": pa.int64(), "salt": pa.int32(), "node": pa.int64(),
             "n": pa.int32(), "pos": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols, held = [[], [], [], [], []], 0
            for _, x in _sets(batch):
                n = len(x)
                if not n:
                    continue
                p = n - least_overlap(n) + least_met(n)
                at = np.searchsorted(keys, x) if len(keys) else None
                is_hot = np.zeros(n, bool) if at is None else \
                    keys[np.minimum(at, len(keys) - 1)] == x
                first = x[~is_hot][:p]
                more = np.zeros(0, np.uint64)
                if len(first) < p:
                    common = np.flatnonzero(is_hot)
                    common = common[np.argsort(rank[at[common]])]
                    more = x[common[:p - len(first)]]
                node = _node(x)
                salt = int(node % _U(SALT)) + 1
                cols[0].append(np.concatenate([first, more]).view(np.int64))
                cols[1].append(np.repeat([0, salt], [len(first), len(more)]))
                p = len(first) + len(more)
                cols[2].append(np.full(p, node).view(np.int64))
                cols[3].append(np.full(p, n))
                cols[4].append(np.arange(p))
                held += p
                if held > 200_000:
                    yield _rows(kinds, [np.concatenate(c) for c in cols])
                    cols, held = [[], [], [], [], []], 0
            if held:
                yield _rows(kinds, [np.concatenate(c) for c in cols])
    return docs.select(id_col, text_col).mapInArrow(
        run, "k long, salt int, node long, n int, pos int")


def shared_rows(rows: DataFrame) -> DataFrame:
    """Prefix rows, once per node, of shingles with two nodes or more (all
    rows of salted shingles), with the least node of the group as leader."""
    names = ["k", "salt", "node", "n", "pos", "leader"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = SharedGroups()
        for batch in batches:
            if not batch.num_rows:
                continue
            k, salt, node = (np.asarray(batch.column(i)) for i in range(3))
            fresh, keep, lead, late = groups.feed(batch, [k, salt], node)
            if late is not None and late.column(1)[0].as_py() == 0:
                yield pa.RecordBatch.from_arrays(
                    [*late.columns, late.column(2)], names=names)
            keep = keep | (fresh & (salt > 0))
            yield pa.RecordBatch.from_arrays(
                [*[c.filter(pa.array(keep)) for c in batch.columns],
                 pa.array(lead[keep])], names=names)
    return (rows.repartition("k", "salt")
            .sortWithinPartitions("k", "salt", "node")
            .mapInArrow(run, "k long, salt int, node long, n int, pos int, "
                        "leader long"))


def _need(total: Column, percent: int) -> Column:
    """Overlap of two sets of ``total`` elements that reaches ``percent``."""
    return F.ceil(total * percent / (100 + percent)).cast("long")


def _parity_words(bits: str) -> list[Column]:
    """A parity bitmap as longs."""
    return [F.conv(F.hex(F.substring(bits, 8 * i + 1, 8)), 16, -10).cast("long")
            for i in range(PARITY_BITS // 64)]


def _differing(x: list[Column], y: list[Column]) -> Column:
    """Bits in which two parity bitmaps differ: two sets differ in as many
    elements or more."""
    return functools.reduce(operator.add, (
        F.bit_count(a.bitwiseXOR(b)) for a, b in zip(x, y)))


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that sizes and parity bitmaps do not rule out, and their
    set sizes (na, nb)."""
    side = lambda s: nodes.select(F.col("node").alias(s),
                                  F.col("n").alias(f"n{s}"),
                                  F.col("bits").alias(f"bits{s}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    total = F.col("na") + F.col("nb")
    need = _need(total, percent)
    differ = _differing(_parity_words("bitsa"), _parity_words("bitsb"))
    return (both.withColumn("need", need)
            .where(F.least("na", "nb") >= F.col("need"))
            .where(differ <= total - 2 * F.col("need"))
            .select("a", "b", "na", "nb"))


def _needed(docs: DataFrame, id_col: str, text_col: str, tags: DataFrame,
            ) -> DataFrame:
    """node, fragment, part (sorted hashes) of the documents whose tag is in
    a hashed set of fixed size; a few others may come along."""
    wanted = hashed_set(tags, NEED_BITS)
    kinds = {"node": pa.int64(), "fragment": pa.int32(), "part": pa.binary()}
    width = _U(64 - (FRAGMENTS.bit_length() - 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _ids(batch)
            out = ([], [], [])
            for i, x in _sets(batch):
                if not len(x):
                    continue
                node = np.array([_node(x)])
                if not is_in(wanted, _tag(ids[i:i + 1], node))[0]:
                    continue
                cut = np.searchsorted(x >> width, np.arange(FRAGMENTS + 1))
                for f in range(FRAGMENTS):
                    out[0].append(int(node.view(np.int64)[0]))
                    out[1].append(f)
                    out[2].append(x[cut[f]:cut[f + 1]].tobytes())
            if out[0]:
                yield _rows(kinds, out)
    return docs.select(id_col, text_col).mapInArrow(
        run, "node long, fragment int, part binary")


def _roles(pairs: DataFrame) -> DataFrame:
    """Where a node's set goes: to each centre it is paired with (kind 1), and
    as a centre to its own place (kind 0).  A centre with many members is
    dealt over several places."""
    members = pairs.groupBy("b").agg(
        F.ceil(F.count("*") / MEMBERS).cast("int").alias("places"))
    own = members.select(
        F.col("b").alias("node"), F.col("b").alias("centre"),
        F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"),
        F.lit(0).alias("kind"))
    return own.unionByName(pairs.join(members, "b").select(
        F.col("a").alias("node"), F.col("b").alias("centre"),
        F.pmod("a", F.col("places")).cast("int").alias("place"),
        F.lit(1).alias("kind")))


def _overlaps(docs, id_col, text_col, pairs: DataFrame, nodes: DataFrame,
              percent: int, differences: bool = False) -> DataFrame:
    """a, b, na, nb, both of the pairs (a, b) that reach ``percent``, and (on
    demand) diff, their symmetric difference."""
    roles = stored(_roles(stored(_bounded(pairs, nodes, percent),
                                 "ngram-pairs")), "ngram-roles")
    tags = nodes.join(roles.select("node").distinct(), "node",
                      "left_semi").select("tag")
    kinds = {"a": pa.int64(), "b": pa.int64(), "na": pa.int64(),
             "nb": pa.int64(), "both": pa.int64(),
             "diff": pa.list_(pa.int64())}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a centre's fragments come first, then member after member
        at, centre = None, {}
        member, partial, sizes, delta = None, {}, 0, []

        def summed():
            both, n = sum(partial.values()), sum(map(len, centre.values()))
            if member is None or both * (100 + percent) < (sizes + n) * percent:
                return None
            return (member, at[0], sizes, n, both,
                    np.concatenate(delta).view(np.int64) if differences else None)

        for batch in batches:
            out = []
            small = [c.to_pylist() for c in batch.columns[:5]]
            for i, (c, place, kind, node, f) in enumerate(zip(*small)):
                if (at, member) != ((c, place), node if kind else None):
                    if (row := summed()) is not None:
                        out.append(row)
                    if at != (c, place):
                        at, centre = (c, place), {}
                    member = node if kind else None
                    partial, sizes, delta = {}, 0, []
                x = np.frombuffer(batch.column(5)[i].as_buffer(), np.uint64)
                if not kind:
                    centre[f] = x.copy()
                elif f not in partial:      # else a repeated row of a document
                    y = centre.get(f, x[:0])
                    if differences:
                        d = np.setxor1d(x, y, assume_unique=True)
                        partial[f] = (len(x) + len(y) - len(d)) // 2
                        delta.append(d)
                    elif len(x) and len(y):
                        j = np.minimum(np.searchsorted(y, x), len(y) - 1)
                        partial[f] = int((y[j] == x).sum())
                    else:
                        partial[f] = 0
                    sizes += len(x)
            if out:
                yield _rows(kinds, list(zip(*out)))
        if (row := summed()) is not None:
            yield _rows(kinds, list(zip(*[row])))

    key = ["centre", "place"]
    return stored(
        _needed(docs, id_col, text_col, tags).join(roles, "node")
        .select(*key, "kind", "node", "fragment", "part")
        .repartition(*key)
        .sortWithinPartitions(*key, "kind", "node", "fragment")
        .mapInArrow(count, "a long, b long, na long, nb long, both long, "
                    "diff array<long>"), "ngram-overlaps")


def _linked(met: DataFrame) -> Column:
    return F.col("both") >= _need(F.col("na") + F.col("nb"), PERCENT)


def _difference_rows(met: DataFrame) -> DataFrame:
    """c, e, node, n, d, linked, pos, most: the rarest elements e of the
    differences of members to their centre c, where not all are linked to it.

    Two members differ in ``dx + dy - 2 * common`` elements, so with
    differences of dx <= dy elements a link needs ``t = (dx + dy - H) / 2``
    common ones, H being the most that linked sets differ in; t >= 1 unless
    both are linked to the centre.  So the first ``dx - t + 1`` elements of the
    smaller one must meet the first ``dy - t + 1`` of the larger one, in any
    common order; rare ones are first.  Partners are at most n / 0.85 large,
    which bounds H (``most``).
    """
    members = met.select(F.col("b").alias("c"), F.col("a").alias("node"),
                         F.col("na").alias("n"), F.size("diff").alias("d"),
                         _linked(met).alias("linked"), "diff")
    open_ = members.groupBy("c").agg(F.min("linked").alias("all")) \
        .where(~F.col("all")).select("c")
    rows = stored(members.join(open_, "c", "left_semi").select(
        "c", "node", "n", "d", "linked", F.explode("diff").alias("e")),
        "ngram-differences")
    often = rows.groupBy("c", "e").agg(F.count("*").alias("f"))
    by_rarity = Window.partitionBy("c", "node").orderBy("f", "e")
    most = F.floor((100 - PERCENT) * (F.col("n") + F.floor(F.col("n") * 100
                                                          / PERCENT))
                   / (100 + PERCENT))
    rows = rows.join(often, ["c", "e"]) \
        .withColumn("pos", F.row_number().over(by_rarity)) \
        .withColumn("most", most).where(F.col("pos") <= F.col("most") + 1)
    return stored(rows.select("c", "e", "node", "n", "d", "linked", "pos",
                              "most"), "ngram-differing")


def _grouped(rows: DataFrame, label: DataFrame) -> DataFrame:
    """The rows with their component so far (g), where those of one (c, e) lie
    in several."""
    rows = rows.join(label, "node", "left") \
        .withColumn("g", F.coalesce("component", "node")).drop("component")
    several = rows.groupBy("c", "e").agg(F.min("g").alias("lo"),
                                         F.max("g").alias("hi")) \
        .where("lo <> hi").select("c", "e")
    return rows.join(several, ["c", "e"], "left_semi")


def _leader_pairs(rows: DataFrame) -> DataFrame:
    """c, a, b: each member with the ``LEADERS`` leaders of another component
    that it meets most often.  An element's leader is its member least by the
    hash of component and node, so few nodes lead, of few components."""
    lead = rows.groupBy("c", "e").agg(F.min_by(
        F.struct(F.col("node").alias("b"), F.col("g").alias("gb")),
        F.struct(F.xxhash64("g"), F.xxhash64("node"))).alias("lead"))
    met = rows.join(lead, ["c", "e"]).where(F.col("g") != F.col("lead.gb")) \
        .groupBy("c", F.col("node").alias("a"), F.col("lead.b").alias("b")) \
        .count()
    often = Window.partitionBy("c", "a").orderBy(F.desc("count"), "b")
    return met.withColumn("place", F.row_number().over(often)) \
        .where(F.col("place") <= LEADERS).select("c", "a", "b")


def _difference_pairs(rows: DataFrame) -> DataFrame:
    """c, a, b: all pairs of members of one centre, in different components,
    that the bounds of ``_difference_rows`` leave."""
    # against a member that is not linked, a linked one needs about half of
    # its difference (sizes differ by d at most)
    half = F.least(F.floor(F.col("most") / 2) + 1, F.when(
        F.col("linked"), F.floor((F.col("d") * 1.09 + 1) / 2) + 1)
        .otherwise(F.col("most")))
    x = rows.where(F.col("pos") <= F.greatest(half, F.lit(1))).alias("x")
    y = rows.alias("y")
    col = lambda s, c: F.col(f"{s}.{c}")
    total = col("x", "n") + col("y", "n")
    differ = total - 2 * _need(total, PERCENT)
    common = F.least(col("x", "pos"), col("y", "pos")) + F.least(
        col("x", "d") - col("x", "pos"), col("y", "d") - col("y", "pos"))
    twice = col("x", "d") + col("y", "d") - differ        # 2 t
    # d - t + 1 >= pos: the element is in the pair's own prefixes
    ahead = lambda s: col(s, "d") - col(s, "pos") + 1
    ordered = (col("x", "d") < col("y", "d")) | (
        (col("x", "d") == col("y", "d")) & (col("x", "node") < col("y", "node")))
    return x.join(y, (col("x", "c") == col("y", "c"))
                  & (col("x", "e") == col("y", "e")) & ordered
                  & (col("x", "g") != col("y", "g"))
                  & (2 * common >= twice) & (2 * ahead("x") >= twice)
                  & (2 * ahead("y") >= twice)) \
        .select(col("x", "c").alias("c"), col("x", "node").alias("a"),
                col("y", "node").alias("b")).distinct()


def _by_differences(pairs: DataFrame, met: DataFrame) -> DataFrame:
    """The links (a, b) among pairs of members of one centre c, counted from
    their stored differences: no set travels again."""
    side = lambda s: met.select(
        F.col("b").alias("c"), F.col("a").alias(s), F.col("na").alias(f"n{s}"),
        F.col("diff").alias(f"diff{s}"))
    both = pairs.join(side("a"), ["c", "a"]).join(side("b"), ["c", "b"])
    differ = F.size("diffa") + F.size("diffb") \
        - 2 * F.size(F.array_intersect("diffa", "diffb"))
    total = F.col("na") + F.col("nb")
    return both.where(differ <= total - 2 * _need(total, PERCENT)) \
        .select("a", "b")


def _member_links(met: DataFrame, near: DataFrame,
                  ) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) that connect all members of a centre that any chain of
    links within the centre connects, and the components known on the way.

    Rounds of leader pairs, as many as members, contract most of a group;
    only pairs of members still in different components are then all made.
    """
    rows = _difference_rows(met)
    links, label = near, stored(components(near), "ngram-labels")
    for _ in range(ROUNDS):
        led = stored(_by_differences(_leader_pairs(_grouped(rows, label)), met),
                     "ngram-led")
        if led.isEmpty():
            break
        links = links.unionByName(led)
        label = stored(components(links), "ngram-labels")
    rest = stored(_by_differences(_difference_pairs(_grouped(rows, label)), met),
                  "ngram-members")
    return links.unionByName(rest), label


def _possible(x: str, y: str) -> Column:
    """Bound from the places of a common shingle in two sets."""
    n = lambda s, c: F.col(f"{s}.{c}")
    most = F.least(n(x, "pos"), n(y, "pos")) + F.least(
        n(x, "n") - n(x, "pos"), n(y, "n") - n(y, "pos"))
    total = n(x, "n") + n(y, "n")
    return (most * (100 + PERCENT) >= total * PERCENT) & (
        F.least(n(x, "n"), n(y, "n")) * 100
        >= F.greatest(n(x, "n"), n(y, "n")) * PERCENT)


def _bundles(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """k, node, n, c, centre, pos, left, before and the words of the parity
    bitmap: one row for each node of a bundle, the shingles that the same nodes
    hold.  A bundle is named by its first shingle k, at place pos; ``left``
    shingles of the node's rows are not before it, and ``before`` are those of
    the node's first ``FIRST`` bundles that are."""
    name = rows.groupBy("k").agg(
        F.bit_xor(F.xxhash64("node")).alias("s1"), F.min("node").alias("s2"),
        F.count("*").alias("s3")).where("s3 > 1")
    bundles = rows.join(name, "k") \
        .groupBy("s1", "s2", "s3", "node", "n", "c", "centre") \
        .agg(F.count("*").alias("w"), F.min_by("k", "pos").alias("k"),
             F.min("pos").alias("pos"))
    ordered = Window.partitionBy("node").orderBy("pos")
    whole = ordered.rowsBetween(Window.unboundedPreceding,
                                Window.unboundedFollowing)
    passed = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    place = F.col("place")
    bundles = bundles.withColumn("place", F.row_number().over(ordered)) \
        .withColumn("left", F.sum("w").over(whole) - F.sum("w").over(passed)
                    + F.col("w")) \
        .withColumn("first", F.collect_list(
            F.when(place <= FIRST, F.col("k"))).over(whole)) \
        .where(F.col("left") >= _least_for(F.col("n"))) \
        .select("k", "node", "n", "c", "centre", "pos", "left", F.slice(
            "first", F.lit(1), F.least(place - 1, F.lit(FIRST))).alias("before"))
    return bundles.join(nodes.select("node", *[
        word.alias(f"bits{i}") for i, word in enumerate(_parity_words("bits"))]),
        "node")


def _meeting(bundles: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components and of different centres, with
    their sizes (na, nb), at the first bundle they share.

    If any common bundle lies in both prefixes that the two sizes ask for, the
    first one does, with m shingles left from it on.  Where two rows know a
    common bundle before them, the pair met there.  The parity bitmaps rule out
    pairs as they meet, such as those of texts that only share a passage.
    """
    x, y = bundles.alias("x"), bundles.alias("y")
    col = lambda s, c: F.col(f"{s}.{c}")
    bits = [f"bits{i}" for i in range(PARITY_BITS // 64)]
    total = col("x", "n") + col("y", "n")
    need = _need(total, PERCENT)
    differ = _differing([col("x", c) for c in bits], [col("y", c) for c in bits])
    m = _least_met(F.least(col("x", "n"), col("y", "n")))
    ahead = lambda s: (
        col(s, "pos") < col(s, "n") - need + m) & (col(s, "left") >= m)
    return x.join(y, (col("x", "k") == col("y", "k"))
                  & (col("x", "c") < col("y", "c"))
                  & (col("x", "centre") != col("y", "centre"))
                  & (col("x", "centre") != col("y", "node"))
                  & (col("x", "node") != col("y", "centre"))
                  & ahead("x") & ahead("y") & _possible("x", "y")
                  & (differ <= total - 2 * need)
                  & ~F.arrays_overlap("x.before", "y.before")) \
        .select(col("x", "node").alias("a"), col("y", "node").alias("b"),
                col("x", "n").alias("na"), col("y", "n").alias("nb"))


def _meeting_often(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs (a, b) that share m of the rows' shingles in the prefixes that
    their two sizes (na, nb) ask for."""
    used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    held = stored(
        rows.join(used, "node", "left_semi").groupBy("node").agg(
            F.sort_array(F.collect_list(F.struct("pos", "k"))).alias("r"))
        .select("node", F.col("r.k").alias("ks"), F.col("r.pos").alias("places")),
        "ngram-held")
    side = lambda s: held.select(
        F.col("node").alias(s), F.col("ks").alias(f"ks{s}"),
        F.col("places").alias(f"places{s}"))
    need = _need(F.col("na") + F.col("nb"), PERCENT)
    m = _least_met(F.least("na", "nb"))

    def ahead(s: str) -> Column:
        end = F.col(f"n{s}") - need + m
        return F.slice(f"ks{s}", F.lit(1), F.size(
            F.filter(f"places{s}", lambda pos: pos < end)))
    return pairs.join(side("a"), "a").join(side("b"), "b") \
        .where(F.size(F.array_intersect(ahead("a"), ahead("b"))) >= m) \
        .select("a", "b")


def _prefix_pairs(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components and of different centres that
    share m shingles in the prefixes that their two sizes ask for.

    Linked sets share ``need`` shingles, so their first m common ones lie in
    the first ``n - need + m`` of each.  Pairs are made once, at the first
    bundle of shingles they share; what they share is counted afterwards.
    """
    shared = known.groupBy("k").agg(
        F.min("c").alias("c1"), F.max("c").alias("c2"),
        F.min("centre").alias("m1"), F.max("centre").alias("m2")) \
        .where("c1 <> c2 and m1 <> m2").select("k")
    rows = known.join(shared, "k", "left_semi")
    enough = rows.groupBy("node").agg(F.count("*").alias("met"),
                                      F.max("n").alias("n")) \
        .where(F.col("met") >= _least_for(F.col("n"))).select("node")
    rows = stored(rows.join(enough, "node", "left_semi"), "ngram-shared")
    bundles = stored(_bundles(rows, nodes), "ngram-bundles")
    pairs = stored(_meeting(bundles).distinct(), "ngram-meeting")
    return _meeting_often(pairs, rows)


def ngram_components(docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per document."""
    spark = docs.sparkSession
    counted, path = stored_at(set_table(docs, id_col, text_col), "ngram-counted")
    hot = frequent(counted)
    sets = stored(counted.drop("common", "times"), "ngram-sets")
    discard(spark, path)
    nodes = stored(
        sets.where("n > 0").groupBy("node").agg(
            F.min_by("tag", F.coalesce("doc_id", F.lit((1 << 63) - 1)))
            .alias("tag"), F.max("n").alias("n"), F.max("bits").alias("bits")),
        "ngram-nodes")
    rows, rows_path = stored_at(shared_rows(prefix_rows(
        docs, id_col, text_col, hot)), "ngram-prefix")

    # the places that a frequent shingle's rows are dealt over share one leader
    common = rows.where("salt > 0").groupBy("k").agg(F.min("leader").alias("least"))
    led = rows.join(common, "k", "left").withColumn(
        "leader", F.coalesce("least", "leader"))
    best = (led.where("node <> leader")
            .groupBy("node", "leader", "n").count()
            .where(F.col("count") >= _least_met(F.col("n"))).groupBy("node")
            .agg(F.max_by("leader", F.struct("count", "leader")).alias("b"))
            .select(F.col("node").alias("a"), "b"))
    met = _overlaps(docs, id_col, text_col, best, nodes, NEAR, differences=True)
    near = met.where(_linked(met)).select("a", "b")
    near, label = _member_links(met, near)
    centre = met.select(F.col("a").alias("node"), F.col("b").alias("centre"))
    known = rows.join(label, "node", "left").join(centre, "node", "left").select(
        "k", "node", "n", "pos", F.coalesce("component", "node").alias("c"),
        F.coalesce("centre", "node").alias("centre"))
    known = stored(known, "ngram-known")
    discard(spark, rows_path)
    cross = stored(_prefix_pairs(known, nodes), "ngram-cross")
    far = _overlaps(docs, id_col, text_col, cross, nodes, PERCENT) \
        .select("a", "b")
    label = stored(components(near.unionByName(far)), "ngram-labels")

    named = sets.select("doc_id", "n", "node").join(label, "node", "left")
    own = F.when(F.col("n") > 0, F.coalesce("component", "node"))
    named = named.select("doc_id", F.col("n").alias("n_shingles"), own.alias("c"))
    least = named.where("c is not null").groupBy("c").agg(
        F.min("doc_id").alias("component_id"))
    return named.join(least, "c", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("c").isNull(), F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i + 1 : i + 4], ' ') AS g
  FROM (SELECT doc_id, words,
               unnest(range(0, greatest(len(words) - 3, 1))) AS i
        FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
         FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
         GROUP BY x.doc_id, y.doc_id),
link AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
         WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w
          UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       min(reach.b) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = w.doc_id
GROUP BY w.doc_id, n.n"""
