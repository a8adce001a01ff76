"""Exact substring dedup by a distributed difference-cover suffix sort.

Every byte covered by a ``LENGTH``-byte string that also starts earlier
(smaller document, or same document and earlier start) is removed; strings are
judged on the input.

A global suffix array of all bytes would need several times the text in each
of its shuffles, so the sort is cut by content first, without losing a match:

1. *Cover.*  Every ``LENGTH``-byte window is assigned to its leftmost smallest
   hashed ``SEED``-byte string.  This choice depends on the window's bytes
   alone, so equal windows choose the same place: it is a difference cover
   chosen by content.  Consecutive windows with one chosen place make a
   *piece*; each window lies in exactly one piece, and a piece is named by
   (hash of its seed, hash of its bytes).
2. *Copies.*  Pieces meet by seed.  Of equal pieces all but the earliest are
   covered wholly; within an Arrow batch this is settled before the shuffle,
   so a passage that a third of all documents share sends one row per batch.
   A seed with only one distinct piece is done.
3. *Suffix sort.*  The earliest copies of the distinct pieces that share a
   seed are fetched in a second pass: a hashed bit table keeps most others
   back, an exact join on the piece's place the rest.  Those that agree with no other in the
   bytes around the seed which any common window must hold are alone; the rest
   are sorted together, in bounded batches, by the difference-cover (DC3)
   algorithm: sort the sampled triples, recurse on their names, sort and merge
   the remaining suffixes; then the ``LENGTH``-byte prefixes of adjacent
   suffixes are compared, and of equal ones all but the earliest start are
   covered.
   Seeds with more than ``GROUP`` distinct pieces are dealt by whole windows
   instead (each window its own piece, as in 2), so no group is unbounded.
4. Covered intervals meet their text, sorted by document, and stream through.

Pieces are compared by 128 bits of hash (seed and bytes), windows within a
batch byte by byte.

Defined cases: null texts are empty; ids that repeat or are null are documents
of their own, ordered by id (null last), then text hash.  A text shorter than
``LENGTH`` loses nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textkernel as tk
from pricelake.llm.common import (discard, hashed_set, is_in, stored,
                                  stored_at)
from pricelake.llm.streaming_groups import SharedGroups

LENGTH = 100
SEED = 24
GROUP = 4096          # distinct pieces of a seed that are sorted together
SEGMENT = 1 << 17     # bytes hashed at once
SORT_BYTES = 1 << 20  # bytes sorted at once
BITS = 1 << 24        # bits of a hashed table
MOST_BITS = 1 << 29   # of the table of wanted pieces, which grows up to this
PIECE_BITS = 8        # bits per wanted piece

_U = np.uint64
_POS = _U((1 << 20) - 1)
KINDS = {"seed": pa.int64(), "name": pa.int64(), "rid": pa.int64(),
         "start": pa.int64(), "n": pa.int16()}
SCHEMA = "seed long, name long, rid long, start long, n short"


# ---------------------------------------------------------------- pieces

def _segment_pieces(data, lo, hi):
    """Pieces of the windows of texts [lo, hi) laid out in ``data`` (at most
    2**20 bytes): text index, start in ``data``, windows, seed, name, and where
    the seed lies in the piece."""
    n = len(data)
    windows = np.maximum(hi - lo - LENGTH + 1, 0)
    total = int(windows.sum())
    if not total:
        z = np.zeros(0, np.int64)
        return z, z, z, z.view(np.uint64), z.view(np.uint64), z
    p, inv = tk.powers(n + 1)
    s = np.zeros(n + 1, np.uint64)
    np.cumsum(tk.EXACT[data] * p[:n], out=s[1:])
    h = tk.mix((s[SEED:] - s[:-SEED]) * inv[:n - SEED + 1])
    v = (h & ~_POS) | np.arange(len(h), dtype=np.uint64)
    width, size = LENGTH - SEED + 1, 1
    while size * 2 <= width:
        v = np.minimum(v[:-size], v[size:])
        size *= 2
    if size < width:
        v = np.minimum(v[:-(width - size)], v[width - size:])
    text = np.repeat(np.arange(len(lo)), windows)
    start = np.arange(total) + np.repeat(lo - np.cumsum(windows) + windows,
                                         windows)
    place = (v[start] & _POS).astype(np.int64)
    first = np.ones(total, bool)
    first[1:] = (place[1:] != place[:-1]) | (text[1:] != text[:-1])
    b = np.flatnonzero(first)
    count = np.diff(np.append(b, total))
    a = start[b]
    e = a + count - 1 + LENGTH
    name = tk.mix((s[e] - s[a]) * inv[a] + count.astype(np.uint64) * tk.BASE)
    return text[b], a, count, h[place[b]], name, place[b] - a


def pieces(data, off):
    """(document index, start, windows, seed, name, seed's place) of the pieces
    of a batch of texts."""
    out = []
    a, n = 0, len(off) - 1
    step = SEGMENT - LENGTH + 1
    with np.errstate(over="ignore"):
        while a < n:
            b = max(a + 1, int(np.searchsorted(off, off[a] + SEGMENT,
                                               "right")) - 1)
            b = min(b, n)
            if b == a + 1 and off[b] - off[a] > SEGMENT:
                # a long text: segments that overlap by LENGTH - 1 bytes
                for x in range(int(off[a]), int(off[b]) - LENGTH + 1, step):
                    y = min(int(off[b]), x + SEGMENT)
                    t, s, c, *more = _segment_pieces(
                        data[x:y], np.array([0]), np.array([y - x]))
                    out.append((t + a, s + x - off[a], c, *more))
            else:
                x = off[a]
                t, s, c, *more = _segment_pieces(
                    data[x:off[b]], off[a:b] - x, off[a + 1:b + 1] - x)
                out.append((t + a, s - (off[a:b] - x)[t], c, *more))
            a = b
    return [np.concatenate(c) for c in zip(*out)] if out else \
        [np.zeros(0, np.int64)] * 3 + [np.zeros(0, np.uint64)] * 2 \
        + [np.zeros(0, np.int64)]


def _batch(cols, kinds=None) -> pa.RecordBatch:
    kinds = kinds or KINDS
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(cols, kinds.values())],
        names=list(kinds))


def _settled(rid, start, n, seed, name) -> pa.RecordBatch:
    """Rows of a batch for the shuffle.  Of equal pieces all but the earliest
    become covered already: n < 0, under a seed that spreads them."""
    order = np.lexsort((start, rid))
    rid, start, n, seed, name = (x[order] for x in (rid, start, n, seed, name))
    o = np.argsort(seed ^ (name * tk.BASE), kind="stable")
    again = np.zeros(len(o), bool)
    again[1:] = (seed[o[1:]] == seed[o[:-1]]) & (name[o[1:]] == name[o[:-1]])
    later = np.zeros(len(o), bool)
    later[o] = again
    spread = tk.mix(rid.view(np.uint64) * tk.BASE + start.astype(np.uint64))
    return _batch((np.where(later, spread, seed).view(np.int64),
                   name.view(np.int64), rid, start,
                   np.where(later, -n, n).astype(np.int16)))


def piece_rows(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = np.asarray(batch.column(0)).astype(np.int64)
            data, off = tk.buffers(batch.column(1))
            # at most about 8 MB of text are settled together
            for a, b in tk.doc_chunks(off, 1 << 23):
                doc, start, n, seed, name, _ = pieces(
                    data[off[a]:off[b]], off[a:b + 1] - off[a])
                if len(doc):
                    with np.errstate(over="ignore"):
                        yield _settled(rid[a:b][doc], start, n, seed, name)
    return rows.select("rid", "text").mapInArrow(run, SCHEMA)


def first_copies(found: DataFrame) -> DataFrame:
    """Of piece rows: those that are covered (n < 0), and the earliest copies
    of pieces that share their seed with other pieces (n > 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = SharedGroups()
        for batch in batches:
            n = np.asarray(batch.column(4))
            done = n < 0
            if done.any():
                yield batch.filter(pa.array(done))
                batch = batch.filter(pa.array(~done))
            if not batch.num_rows:
                continue
            seed, name = np.asarray(batch.column(0)), np.asarray(batch.column(1))
            fresh, keep, _, late = groups.feed(batch, [seed], name)
            if late is not None:
                yield late
            n = np.asarray(batch.column(4))
            n = np.where(fresh, n, -n).astype(np.int16)
            out = pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(n)], names=list(KINDS))
            yield out.filter(pa.array(keep | ~fresh))
    return (found.repartition("seed")
            .sortWithinPartitions("seed", "name", "rid", "start")
            .mapInArrow(run, SCHEMA))


def piece_texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """seed, rid, start, at (the seed's place), body of the wanted pieces.

    The bit table only saves shuffling; pieces that pass it by chance (copies,
    or pieces with a seed of their own) end at the join, which deals by place,
    so that the copies of a common passage spread."""
    n = max(BITS, min(MOST_BITS, PIECE_BITS * wanted.count()))
    bits = hashed_set(wanted.select(_place_column().alias("p")),
                      1 << (n - 1).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"seed": pa.int64(), "rid": pa.int64(), "start": pa.int64(),
                 "at": pa.int16(), "body": pa.binary()}
        for batch in batches:
            rid = np.asarray(batch.column(0)).astype(np.int64)
            data, off = tk.buffers(batch.column(1))
            for a, b in tk.doc_chunks(off, 1 << 22):
                part = data[off[a]:off[b]]
                doc, start, n, seed, _, at = pieces(
                    part, off[a:b + 1] - off[a])
                own = rid[a:b][doc]
                hit = np.flatnonzero(is_in(bits, _place(own, start, seed)))
                if not len(hit):
                    continue
                x = off[a:b][doc[hit]] - off[a] + start[hit]
                y = x + n[hit] - 1 + LENGTH
                yield _batch((seed[hit].view(np.int64), own[hit], start[hit],
                              at[hit], [part[i:j].tobytes() for i, j in zip(x, y)]), kinds)
    return rows.select("rid", "text").mapInArrow(
        run, "seed long, rid long, start long, at short, body binary").join(
        wanted.select("seed", "rid", "start"), ["seed", "rid", "start"],
        "left_semi")


def _place(rid, start, seed):
    x = seed ^ (rid.view(np.uint64) << _U(17)) ^ start.astype(np.uint64)
    return x ^ (x >> _U(32))


def _place_column():
    x = F.col("seed").bitwiseXOR(F.shiftleft("rid", 17)) \
        .bitwiseXOR(F.col("start"))
    return x.bitwiseXOR(F.shiftrightunsigned(x, 32))


# ---------------------------------------------------------- suffix sort

def _pairs(a, b, k, third):
    """Codes in the order of the pairs (a, b) of values below ``k``; ranks where
    the code times ``third`` would not fit 64 bits."""
    code = a * k + b
    if k * k * third >= 1 << 63:
        code = np.unique(code, return_inverse=True)[1].astype(np.int64)
    return code


def suffix_array(s: np.ndarray) -> np.ndarray:
    """Difference cover modulo 3, vectorised; values of ``s`` are >= 1 and
    below 2**31."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    k = int(s.max()) + 1
    t = np.concatenate([s, np.zeros(3, np.int64)]).astype(np.int64)
    # sampled positions, with a dummy triple where n is 1 modulo 3
    one = np.arange(1, n + (n % 3 == 1), 3)
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    triple = _pairs(t[sample], t[sample + 1], k, k) * k + t[sample + 2]
    order = np.argsort(triple, kind="stable")
    change = np.diff(triple[order]) != 0
    name = np.empty(len(sample), np.int64)
    name[order] = np.concatenate([[1], 1 + np.cumsum(change)])
    if name[order[-1]] < len(sample):
        order = suffix_array(name)
    rank = np.zeros(n + 3, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    r = len(sample) + 2
    sampled = sample[order]
    sampled = sampled[sampled < n]
    # the rest: by first value and the rank of the sampled suffix behind it
    zero = np.arange(0, n, 3)
    key0 = t[zero] * r + rank[zero + 1]
    o = np.argsort(key0, kind="stable")
    zero, key0 = zero[o], key0[o]
    ones, twos = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    key1 = t[ones] * r + rank[ones + 1]
    pair = np.concatenate([twos, zero])     # ranked together
    pair = _pairs(t[pair], t[pair + 1], k, r)
    key2 = pair[:len(twos)] * r + rank[twos + 2]
    key02 = pair[len(twos):] * r + rank[zero + 2]
    at = np.arange(len(zero)) + np.searchsorted(key1, key0) \
        + np.searchsorted(key2, key02)
    out = np.empty(n, np.int64)
    rest = np.ones(n, bool)
    rest[at] = False
    out[at] = zero
    out[rest] = sampled
    return out


def covered_windows(bodies: list[bytes], rid, start):
    """(rid, start) of the windows in ``bodies`` (pieces at rid, start) that
    equal a window at an earlier place."""
    size = np.array([len(b) for b in bodies])
    off = np.concatenate([[0], np.cumsum(size + 1)])
    raw = np.zeros(off[-1] + 8, np.uint8)
    s = np.empty(off[-1], np.int64)
    for i, b in enumerate(bodies):
        raw[off[i]:off[i] + len(b)] = np.frombuffer(b, np.uint8)
    s[:] = raw[:off[-1]]
    s += 1
    s[off[1:] - 1] = 257 + np.arange(len(bodies))   # separators, all different
    count = size - LENGTH + 1
    ok = np.zeros(len(s), bool)
    piece = np.repeat(np.arange(len(bodies)), count)
    inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = off[piece] + inside
    ok[at] = True
    owner = np.zeros(len(s), np.int64)
    owner[at] = np.arange(len(at))
    order = suffix_array(s)
    order = order[ok[order]]
    if len(order) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    same = np.ones(len(order) - 1, bool)
    words = np.lib.stride_tricks.as_strided(
        raw, (len(raw) - 7, 8), (1, 1))
    for j in [*range(0, LENGTH - 7, 8), LENGTH - 8]:
        live = np.flatnonzero(same)
        x = words[order[live] + j].copy().view(np.uint64).ravel()
        y = words[order[live + 1] + j].copy().view(np.uint64).ravel()
        same[live] = x == y
    run = np.concatenate([[0], np.cumsum(~same)])
    who = owner[order]
    d, p = rid[piece[who]], start[piece[who]] + inside[who]
    o = np.lexsort((p, d, run))
    later = np.zeros(len(o), bool)
    later[1:] = run[o[1:]] == run[o[:-1]]
    # the earliest place itself may come in twice
    first = np.maximum.accumulate(np.where(later, 0, np.arange(len(o))))
    later &= (d[o] != d[o[first]]) | (p[o] != p[o[first]])
    return d[o][later], p[o][later]


def _runs(rid, start):
    """Windows (rid, start) as rows of consecutive windows."""
    o = np.lexsort((start, rid))
    rid, start = rid[o], start[o]
    new = np.ones(len(rid), bool)
    new[1:] = (rid[1:] != rid[:-1]) | (start[1:] > start[:-1] + 1)
    a = np.flatnonzero(new)
    last = start[np.append(a[1:], len(rid)) - 1]
    return rid[a], start[a], last + LENGTH


SPAN_KINDS = {"rid": pa.int64(), "s": pa.int64(), "e": pa.int64()}


def _alike(group, at, data, off) -> np.ndarray:
    """Pieces that may share a window with another piece of their group.

    A shared window reaches ``left`` bytes before the seed and
    LENGTH - SEED - left behind it.  Whatever ``left`` is, the two pieces agree
    in one of four stretches around the seed; pieces that agree in none with
    any other are alone.
    """
    keep = np.zeros(len(at), bool)
    cuts = np.linspace(0, LENGTH - SEED, 5).astype(np.int64)
    size = np.diff(off)
    with np.errstate(over="ignore"):
        salt = tk.mix(group.astype(np.uint64))
        for before, after in zip(cuts[:-1], cuts[1:]):
            a, b = at - before, at + LENGTH - after
            own = np.flatnonzero((a >= 0) & (b <= size))
            h = salt[own] ^ tk.string_hashes(data, (off[:-1] + a)[own],
                                             (off[:-1] + b)[own], tk.EXACT)
            o = np.argsort(h)
            same = h[o[1:]] == h[o[:-1]]
            keep[own[o[1:]][same]] = True
            keep[own[o[:-1]][same]] = True
    return keep


def sorted_spans(texts: DataFrame) -> DataFrame:
    """rid, s, e of the covered windows among pieces that meet by seed."""
    def settle(rows):
        seed, rid, start, at = (np.asarray(rows.column(i)) for i in range(4))
        data, off = tk.buffers(rows.column(4))
        group = np.cumsum(np.append(False, seed[1:] != seed[:-1]))
        own = np.flatnonzero(_alike(group, at.astype(np.int64), data, off))
        if not len(own):
            return
        # whole groups, about SORT_BYTES at a time
        load = np.cumsum(off[own + 1] - off[own]) // SORT_BYTES
        first = np.flatnonzero(np.append(True, group[own[1:]] != group[own[:-1]]))
        part = np.repeat(load[first], np.diff(np.append(first, len(own))))
        for x in np.split(own, np.flatnonzero(np.diff(part)) + 1):
            d, p = covered_windows(
                [data[i:j].tobytes() for i, j in zip(off[x], off[x + 1])],
                rid[x], start[x])
            if len(d):
                yield _batch(_runs(d, p), SPAN_KINDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if rest is None else pa.concat_batches([rest, batch])
            seed = np.asarray(rows.column(0))
            cut = len(seed) - int(np.argmax(seed[::-1] != seed[-1])) \
                if seed[0] != seed[-1] else 0
            rest = rows.slice(cut)
            if cut:
                yield from settle(rows.slice(0, cut))
        if rest is not None:
            yield from settle(rest)

    return (texts.repartition("seed").sortWithinPartitions("seed")
            .mapInArrow(run, "rid long, s long, e long"))


def window_rows(texts: DataFrame) -> DataFrame:
    """Piece rows of single windows, named by two hashes of their bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # a few thousand pieces at a time
            for x in range(0, batch.num_rows, 2000):
                part = batch.slice(x, 2000)
                data, off = tk.buffers(part.column(4))
                count = np.diff(off) - LENGTH + 1
                i = np.repeat(np.arange(len(count)), count)
                inside = np.arange(len(i)) - np.repeat(
                    np.cumsum(count) - count, count)
                a = off[i] + inside
                seed = tk.string_hashes(data, a, a + LENGTH, tk.EXACT)
                name = tk.string_hashes(data, a, a + LENGTH, tk.EXACT[::-1])
                rid = np.asarray(part.column(1))[i]
                start = np.asarray(part.column(2))[i] + inside
                with np.errstate(over="ignore"):
                    yield _settled(rid, start, np.ones(len(i), np.int64),
                                   seed, name)
    return texts.mapInArrow(run, SCHEMA)


# -------------------------------------------------------------- operator

def _numbered(docs: DataFrame, id_col: str, text_col: str):
    """rid (unique, in document order), id, text; whether rid is the id."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    twice = rows.groupBy("id").count().where("count > 1 or id is null")
    if twice.isEmpty():
        return rows.withColumn("rid", F.col("id").cast("long")), True
    # rows in global order get increasing numbers
    return stored(rows.sort(F.col("id").asc_nulls_last(), F.xxhash64("text"))
                  .withColumn("rid", F.monotonically_increasing_id()),
                  "suffix-docs"), False


def covered_spans(rows: DataFrame) -> DataFrame:
    """rid, s, e (may overlap): every covered byte of rows (rid, text)."""
    found, found_path = stored_at(first_copies(piece_rows(rows)),
                                  "suffix-pieces")
    whole = lambda df: df.where("n < 0").select(
        "rid", F.col("start").alias("s"),
        (F.col("start") - F.col("n") - 1 + LENGTH).alias("e"))
    mixed = found.where("n > 0")
    texts, texts_path = stored_at(piece_texts(rows, mixed), "suffix-texts")
    large = stored(mixed.groupBy("seed").count().where(F.col("count") > GROUP)
                   .select("seed"), "suffix-large")
    few = sorted_spans(texts.join(large, "seed", "left_anti"))
    many = first_copies(window_rows(texts.join(large, "seed", "left_semi")
                                    .select("seed", "rid", "start", "at", "body")))
    spans = stored(whole(found).unionByName(few).unionByName(whole(many)),
                   "suffix-spans")
    discard(rows.sparkSession, found_path)
    discard(rows.sparkSession, texts_path)
    return spans


DIGEST = {"rid": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(),
          "n_spans": pa.int64(), "kept_sha256": pa.string()}


def _digest(raw: bytes, spans) -> tuple:
    sha, at, removed = hashlib.sha256(), 0, 0
    for s, e in spans:
        sha.update(raw[at:s])
        at, removed = e, removed + e - s
    sha.update(raw[at:])
    return len(raw), removed, len(spans), sha.hexdigest()


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows, plain_ids = _numbered(docs, id_col, text_col)
    spans = covered_spans(rows)
    bits = hashed_set(spans.select("rid"), BITS)

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = np.asarray(batch.column(0)).astype(np.int64)
            batch = batch.filter(pa.array(~is_in(bits, rid)))
            data, off = tk.buffers(batch.column(1))
            out = [_digest(data[a:b].tobytes(), ())
                   for a, b in zip(off[:-1], off[1:])]
            if out:
                yield _batch((batch.column(0), *zip(*out)), DIGEST)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = np.asarray(batch.column(0)).astype(np.int64)
            yield batch.filter(pa.array(is_in(bits, rid)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # the spans of a document come before its text
        rid, own = None, []
        for batch in batches:
            r, s, e, text = batch.columns
            is_text = np.asarray(text.is_valid())
            out = []
            r, s, e = np.asarray(r), s.to_pylist(), e.to_pylist()
            for i in range(len(r)):
                if r[i] != rid:
                    rid, own = r[i], []
                if is_text[i]:
                    out.append((int(rid), *_digest(text[i].as_py(), own)))
                elif own and s[i] <= own[-1][1]:
                    own[-1][1] = max(own[-1][1], e[i])
                else:
                    own.append([s[i], e[i]])
            if out:
                yield _batch(list(zip(*out)), DIGEST)

    schema = ("rid long, n_bytes long, n_removed long, n_spans long, "
              "kept_sha256 string")
    text = F.coalesce("text", F.lit(""))
    plain = rows.select("rid", text.alias("text"))
    raw = F.encode(text, "UTF-8").alias("text")
    held = plain.mapInArrow(mark, "rid long, text string").select(
        "rid", F.lit(None).cast("long").alias("s"),
        F.lit(None).cast("long").alias("e"), raw)
    met = spans.select("rid", "s", "e", F.lit(None).cast("binary").alias("text")) \
        .unionByName(held).repartition("rid") \
        .sortWithinPartitions("rid", F.col("s").asc_nulls_last()) \
        .mapInArrow(cut, schema)
    result = plain.mapInArrow(clean, schema).unionByName(met)
    if plain_ids:
        result = result.withColumnRenamed("rid", "id")
    else:
        result = result.join(rows.select("rid", "id"), "rid")
    return result.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "n_bytes",
        "n_removed", "n_spans", "kept_sha256")
