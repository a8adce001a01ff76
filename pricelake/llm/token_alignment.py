"""Alignment of two tokenizers over the same bytes, by merge-path partitioning.

Every text, with a space before it, is encoded by tokenizer A (byte-level BPE,
a ``tokenizers`` JSON file) and by tokenizer B (a ``sentencepiece`` model, which
adds that space itself).  Byte offsets at which tokens of both end cut the two
sequences into groups; every A and every B token of a group are linked.

1. Texts are read in segments of about ``SEGMENT`` characters.  The token ends
   of all texts of a segment form two ascending lists, which *merge-path*
   divides: diagonals of the A x B merge grid at equal steps of ``PIECE`` ends,
   one binary search each, give pieces of equal work whatever the lengths of
   the texts.  A piece is merged on its own and puts out the common ends within
   it; a common end that lies across the border of two pieces is found there,
   and the groups are stitched from the common ends of consecutive pieces.
2. Documents are gathered in blocks of bounded size, each stored with its
   distinct id pairs and the number of its documents that link them.  Spark
   sums these per pair, and finds the highest count of each A id.
3. Each block fetches the counts of its own pairs (one row per block and pair,
   not per link) and adds them up per document.  No table of pairs is
   broadcast.

Each distinct chunk is encoded once as long as a worker remembers it, a chunk
running up to a space that follows something else.  Neither tokenizer makes a token across such
a place: A splits there before its merges, and no piece of B holds a space
behind another character (checked when the model is read; if either is not so,
texts are encoded whole).

Results in odd cases: null and empty texts, and texts that either tokenizer
does not give back byte for byte, have no tokens: zeros, and an empty string
for the hash.  Every row is a document of its own: rows that repeat an id or a
text are counted each, and null ids are kept.  Very long texts are cut into
segments at chunk ends, so memory does not grow with them (but with a text's
distinct links, and with a chunk without any space).  An empty table gives an
empty result.  Other columns of the input, whatever their names, are not read.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricelake.llm.common import stored

TOKENIZERS = "/opt/tokenizers"
A_FILE = "byte_bpe_50k.json"
B_FILE = "piece_bpe_32k.model"

SEGMENT = 1 << 20        # characters aligned at once
PIECE = 1 << 15          # ends in a piece of the merge
BLOCK_LINKS = 1 << 21    # distinct links of documents from which a block ends
BLOCK_DOCS = 1 << 14     # ... or documents
CACHE = 1 << 19          # encoded chunks that a worker keeps ...
CACHE_CHARS = 1 << 24    # ... and characters of them
TOGETHER = 256           # chunks encoded in one call's text
BIG_GROUP = 1 << 12      # links from which a group's ids are counted first

CHUNK = re.compile(r" \s*\S*(?:[^\S ]\s*\S*)*")
CUT = re.compile(r"(?<=\S) ")


class Tokenizers:
    """Both tokenizers of a worker, the bytes of their tokens, and the chunks
    encoded lately."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as fh:
            split = (json.load(fh).get("pre_tokenizer") or {})
        self.a_bytes = self._a_bytes()
        self.b_bytes = self._b_bytes()
        self.n_b = len(self.b_bytes)
        across = re.compile(r"[^\s▁]▁")
        self.chunked = split.get("type") == "ByteLevel" and \
            split.get("use_regex", True) and not any(
                across.search(self.b.id_to_piece(i)) for i in range(self.n_b))
        self.a_len = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], np.int64)
        self.digits = Digits(max(len(self.a_bytes), self.n_b))
        # a lone space; B encodes an empty text without the space it adds
        self.b_space = self.b.encode("a ")[len(self.b.encode("a")):]
        self.forget()

    def _a_bytes(self) -> list[bytes]:
        # byte-level alphabet: printable Latin-1 stands for itself, all other
        # bytes in order for the code points from 256 on
        shown = {chr(x): x for x in range(33, 256) if chr(x).isprintable()}
        rest = [x for x in range(256) if x not in shown.values()]
        shown |= {chr(256 + i): x for i, x in enumerate(rest)}
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        return [bytes(shown[c] for c in names[i])
                if i in names and all(c in shown for c in names[i])
                else names.get(i, "").encode()
                for i in range(max(names, default=-1) + 1)]

    def _b_bytes(self) -> list[bytes]:
        piece = self.b.id_to_piece
        return [bytes([int(piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                else piece(i).replace("▁", " ").encode()
                for i in range(self.b.get_piece_size())]

    def chunks(self, text: str) -> list[str]:
        return CHUNK.findall(text) if self.chunked else [text]

    def forget(self) -> None:
        """Start anew without encoded chunks."""
        self.known, self.chars = Codes(), 0
        # ids of all chunks one after another and how many each has, A and B
        self.ids = [np.zeros(0, np.int32)] * 2
        self.sizes = [np.zeros(0, np.int64)] * 2
        self.ok = np.zeros(0, bool)

    def codes(self, chunks: list[str]) -> np.ndarray:
        """Numbers of the chunks (each starts with a space), encoding new ones."""
        if len(self.known) > CACHE or self.chars > CACHE_CHARS:
            self.forget()
        code = np.fromiter(map(self.known.__getitem__, chunks), np.int64,
                           len(chunks))
        new, self.known.new = self.known.new, []
        if new:
            *sides, ok = (self._encode if self.chunked
                          else self._encode_each)(new)
            for side, (ids, sizes) in enumerate(sides):
                self.ids[side] = np.concatenate([self.ids[side], ids])
                self.sizes[side] = np.concatenate([self.sizes[side], sizes])
            self.ok = np.concatenate([self.ok, ok])
            self.chars += sum(map(len, new))
        return code

    def _encode(self, chunks: list[str]):
        """((A ids, their number per chunk), (B ...), whether both give back
        the chunk's bytes).  Chunks are encoded end to end, many in one text,
        and cut apart at their ends; those that end in white space, or in a
        text that does not come back, one by one."""
        out, at = [], 0
        runs = []                                   # (from, to, as one text)
        for i, c in enumerate(chunks):
            if c[-1].isspace():
                if i > at:
                    runs.append((at, i, True))
                runs.append((i, i + 1, False))
                at = i + 1
            elif i - at == TOGETHER:
                runs.append((at, i, True))
                at = i
        if at < len(chunks):
            runs.append((at, len(chunks), True))
        texts = ["".join(chunks[lo:hi]) for lo, hi, one in runs if one]
        both = iter(zip(*self._both(texts))) if texts else iter(())
        for lo, hi, one in runs:
            part = None
            if one:
                ends = np.cumsum([len(c.encode()) for c in chunks[lo:hi]])
                part = self._cut("".join(chunks[lo:hi]).encode(), ends, *next(both))
            out.append(part or self._encode_each(chunks[lo:hi]))
        return (*((np.concatenate([p[s][0] for p in out]),
                   np.concatenate([p[s][1] for p in out])) for s in (0, 1)),
                np.concatenate([p[2] for p in out]))

    def _both(self, texts: list[str]) -> tuple[list, list]:
        batch = getattr(self.a, "encode_batch_fast", self.a.encode_batch)
        return ([e.ids for e in batch(texts, add_special_tokens=False)],
                [y if t != " " else self.b_space for t, y in zip(
                    texts, self.b.encode([t[1:] for t in texts], num_threads=1))])

    def _cut(self, want: bytes, ends: np.ndarray, a: list[int], b: list[int]):
        out = []
        for ids, names, size in ((a, self.a_bytes, self.a_len),
                                 (b, self.b_bytes, self.b_len)):
            if b"".join([names[i] for i in ids]) != want:
                return None
            ids = np.array(ids, np.int32)
            at = np.cumsum(size[ids])
            cut = np.searchsorted(at, ends)
            if (at[cut] != ends).any():
                return None
            out.append((ids, np.diff(cut + 1, prepend=0)))
        return (*out, np.ones(len(ends), bool))

    def _encode_each(self, chunks: list[str]):
        a, b = self._both(chunks)
        ok = [b"".join([self.a_bytes[i] for i in x]) == c.encode()
              == b"".join([self.b_bytes[i] for i in y])
              for c, x, y in zip(chunks, a, b)]
        return (*((np.array([i for x in side for i in x], np.int32),
                   np.array([len(x) for x in side], np.int64))
                  for side in (a, b)), np.array(ok, bool))


class Codes(dict):
    """Numbers in order of appearance, and the keys not yet seen to."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self)
        self.new.append(key)
        return n


@functools.lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


class Digits:
    """Decimal digits of ids, lowest first."""

    def __init__(self, n: int):
        ids, self.digit, self.n = np.arange(n), [], np.ones(n, np.int64)
        while True:
            self.digit.append((48 + ids % 10).astype(np.uint8))
            ids = ids // 10
            if not ids.any():
                return
            self.n += ids > 0

    def write(self, ids: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each id with the mark behind it as ASCII, and where each ends."""
        n = self.n[ids]
        end = np.cumsum(n + 1)
        out = np.empty(int(end[-1]) if len(end) else 0, np.uint8)
        out[end - 1] = marks
        for k, digit in enumerate(self.digit):
            has = n > k
            out[end[has] - 2 - k] = digit[ids[has]]
        return out, end


# -- merge path --------------------------------------------------------------

def piece_borders(a: np.ndarray, b: np.ndarray,
                  piece: int) -> tuple[np.ndarray, np.ndarray]:
    """How many ends of ``a`` and of ``b`` come before each border, with a
    border after every ``piece`` ends of the merge (equal ends: ``a`` first).
    One binary search along each diagonal of the merge grid."""
    n, m = len(a), len(b)
    d = np.append(np.arange(0, n + m, piece), n + m)
    lo, hi = np.maximum(d - m, 0), np.minimum(d, n)
    while (open_ := lo < hi).any():
        mid = (lo + hi) >> 1
        first = a[np.minimum(mid, n - 1)] <= b[np.clip(d - 1 - mid, 0, m - 1)]
        lo = np.where(open_ & first, mid + 1, lo)
        hi = np.where(open_ & ~first, mid, hi)
    return lo, d - lo


def merge_piece(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Common ends within a piece: how many ends of each list are up to there."""
    at = np.searchsorted(b, a)
    same = at < len(b)
    same[same] = b[at[same]] == a[same]
    return np.flatnonzero(same) + 1, at[same] + 1


def groups(a: np.ndarray, b: np.ndarray,
           piece: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """Up to which token of A, and of B, each group runs (exclusive).  ``a``
    and ``b`` ascend and have the last end in common."""
    i, j = piece_borders(a, b, piece)
    ends_i, ends_j = [], []
    for k in range(len(i) - 1):
        x, y = merge_piece(a[i[k]:i[k + 1]], b[j[k]:j[k + 1]])
        ends_i.append(x + i[k])
        ends_j.append(y + j[k])
        # stitch: an end of A before the border that B reaches just behind it
        if i[k + 1] and j[k + 1] < len(b) and a[i[k + 1] - 1] == b[j[k + 1]]:
            ends_i.append(i[k + 1:k + 2])
            ends_j.append(j[k + 1:k + 2] + 1)
    if not ends_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(ends_i), np.concatenate(ends_j)


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of every range, one range after another."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(
        starts - (ends - lens), lens)


def links(owner: np.ndarray, a: np.ndarray, b: np.ndarray, gi: np.ndarray,
          gj: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, A id, B id) of all links as owner << 40 | pair, and how
    often each occurs; ``owner`` is that of each group."""
    i0, j0 = np.append(0, gi[:-1]), np.append(0, gj[:-1])
    na, nb = gi - i0, gj - j0
    big = na * nb > BIG_GROUP
    keys, times = [], []
    for g in np.flatnonzero(big):
        x, cx = np.unique(a[i0[g]:gi[g]], return_counts=True)
        y, cy = np.unique(b[j0[g]:gj[g]], return_counts=True)
        keys.append((owner[g] << 40) + (x.astype(np.int64)[:, None] * n_b + y).ravel())
        times.append((cx[:, None] * cy).ravel())
    i0, j0, na, nb, owner = (x[~big] for x in (i0, j0, na, nb, owner))
    # every A token of a group, as often as the group has B tokens
    reps = np.repeat(nb, na)
    x = np.repeat(a[spread(i0, na)], reps)
    y = b[spread(np.repeat(j0, na), reps)]
    k, t = np.unique((np.repeat(owner, na * nb) << 40)
                     + x.astype(np.int64) * n_b + y, return_counts=True)
    if not keys:
        return k, t
    return sums(np.concatenate([k, *keys]), np.concatenate([t, *times]))


def sums(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) \
        if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


# -- documents in blocks -----------------------------------------------------------

def pack(at: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending places and their counts as bytes (planes of differences)."""
    both = np.concatenate([np.diff(at, prepend=0), times]).astype("<u4")
    return zlib.compress(both.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zlib.decompress(data), np.uint8)
    both = np.ascontiguousarray(planes.reshape(4, -1).T).view("<u4").ravel() \
        .astype(np.int64)
    n = len(both) // 2
    return np.cumsum(both[:n]), both[n:]


class Block:
    """Documents aligned so far, until they make up a block."""

    def __init__(self, tok: Tokenizers):
        self.tok, self.ids, self.n_links = tok, [], 0
        self.counts: list[list[int]] = []      # n_a, n_b, n_groups, n_links
        self.hashes: list = []
        self.bad: set[int] = set()
        self.keys: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting: list[tuple[int, str]] = []
        self.chars = 0

    def add(self, doc_id, text: str | None) -> None:
        d = len(self.ids)
        self.ids.append(doc_id)
        self.counts.append([0, 0, 0, 0])
        self.hashes.append(None)
        if not text:
            return
        text, at = " " + text, 0
        while at < len(text):
            cut = CUT.search(text, at + SEGMENT) if self.tok.chunked \
                and len(text) - at > SEGMENT else None
            to = cut.start() if cut else len(text)
            self.waiting.append((d, text[at:to]))
            self.chars += to - at
            at = to
            if self.chars >= SEGMENT:
                self.align()

    def align(self) -> None:
        """Align the segments that wait."""
        waiting, self.waiting, self.chars = self.waiting, [], 0
        if not waiting:
            return
        chunks, per = [], []
        for _, text in waiting:
            found = self.tok.chunks(text)
            chunks += found
            per.append(len(found))
        doc = np.repeat(np.array([d for d, _ in waiting], np.int64), per)
        code = self.tok.codes(chunks)
        keep = self.tok.ok[code]
        self.bad.update(doc[~keep].tolist())
        doc, code = doc[keep], code[keep]
        if not len(code):
            return
        ids, owners, ends = [], [], []
        for side, size in ((0, self.tok.a_len), (1, self.tok.b_len)):
            lens = self.tok.sizes[side]
            starts = np.cumsum(lens) - lens
            x = self.tok.ids[side][spread(starts[code], lens[code])]
            ids.append(x)
            owners.append(np.repeat(doc, lens[code]))
            ends.append(np.cumsum(size[x]))
        gi, gj = groups(*ends)
        owner = owners[0][gi - 1]
        self.keys.append(links(owner, *ids, gi, gj, self.tok.n_b))
        self.n_links += len(self.keys[-1][0])
        i0, j0 = np.append(0, gi[:-1]), np.append(0, gj[:-1])
        docs = np.unique(owner)
        for c, x in enumerate((gi - i0, gj - j0, np.ones_like(gi),
                               (gi - i0) * (gj - j0))):
            total = np.bincount(owner - docs[0], x).astype(np.int64)
            for d in docs:
                self.counts[d][c] += int(total[d - docs[0]])
        self._hash(ids, gi, gj, i0, j0, owner, docs)

    def _hash(self, ids, gi, gj, i0, j0, owner, docs) -> None:
        # A ids of a group, then its B ids, group after group
        g = np.arange(len(gi))
        ga, gb = np.repeat(g, gi - i0), np.repeat(g, gj - j0)
        n = len(ga) + len(gb)
        order, marks = np.empty(n, np.int64), np.full(n, ord(","), np.uint8)
        order[np.arange(len(ga)) + j0[ga]] = ids[0]
        order[np.arange(len(gb)) + gi[gb]] = ids[1]
        marks[gi + j0 - 1] = ord("|")
        marks[gi + gj - 1] = ord(";")
        text, end = self.tok.digits.write(order, marks)
        last = np.searchsorted(owner, docs, "right") - 1
        to = end[gi[last] + gj[last] - 1]
        view, at = memoryview(text), 0
        for d, e in zip(docs.tolist(), to.tolist()):
            part = view[at:e - 1]                # without the last mark
            if self.hashes[d] is None:
                self.hashes[d] = hashlib.sha256(part)
            else:
                self.hashes[d].update(b";")
                self.hashes[d].update(part)
            at = e

    def full(self) -> bool:
        return self.n_links >= BLOCK_LINKS or len(self.ids) >= BLOCK_DOCS

    def rows(self, name: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """A row per document, and one with the pairs of the block."""
        self.align()
        none = np.zeros(0, np.int64)
        key, times = sums(*(np.concatenate(x) for x in zip(*self.keys))) \
            if self.keys else (none, none)
        if self.bad:
            good = ~np.isin(key >> 40, np.array(sorted(self.bad)))
            key, times = key[good], times[good]
        pairs, at, n = np.unique(key & ((1 << 40) - 1), return_inverse=True,
                                 return_counts=True)
        bounds = np.searchsorted(key >> 40, np.arange(len(self.ids) + 1))
        for d in self.bad:
            self.counts[d], self.hashes[d] = [0, 0, 0, 0], None
        step = 1024
        for lo in range(0, len(self.ids), step):
            some = range(lo, min(lo + step, len(self.ids)))
            cols = [[name] * len(some), [self.ids[d] for d in some],
                    *[[self.counts[d][c] for d in some] for c in range(4)],
                    [self.hashes[d].hexdigest() if self.hashes[d] else ""
                     for d in some],
                    [pack(at[bounds[d]:bounds[d + 1]],
                          times[bounds[d]:bounds[d + 1]]) for d in some],
                    [None] * len(some), [None] * len(some)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)
        if len(pairs):
            cols = [[name], *[[None]] * 7, [pairs], [n.astype(np.int32)]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)


def align_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """The stored blocks: a row per document (its counts, the hash of its
    groups, its links as places in the block's pairs), and a row per block
    (``pairs``, ascending, and in how many documents each is linked)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = pa.schema([("block", pa.int64()), ("doc_id", _arrow_type(docs)),
                        *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups",
                                                    "n_links")],
                        ("groups_sha256", pa.string()), ("links", pa.binary()),
                        ("pairs", pa.list_(pa.int64())),
                        ("in_docs", pa.list_(pa.int32()))])

    def run(batches):
        tok = tokenizers(a_path, b_path)
        name, block = TaskContext.get().partitionId() << 32, Block(tok)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(),
                                    batch.column(1)):
                block.add(doc_id, text.as_py())
                if block.full():
                    yield from block.rows(name, schema)
                    name, block = name + 1, Block(tok)
        if block.ids:
            yield from block.rows(name, schema)
    return stored(docs.select("doc_id", "text").mapInArrow(
        run, f"block long, doc_id {id_type}, n_a long, n_b long, n_groups long, "
        "n_links long, groups_sha256 string, links binary, pairs array<long>, "
        "in_docs array<int>"), "aligned")


def _arrow_type(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    return to_arrow_type(docs.schema["doc_id"].dataType)


def pair_counts(blocks: DataFrame, n_b: int) -> DataFrame:
    """(pair, n_docs, best): in how many documents each id pair (A id * ``n_b``
    + B id) is linked, and whether no pair of its A id is in more.  A window
    holds the B ids of one A id at most."""
    each = blocks.where("pairs is not null").select(
        F.explode(F.arrays_zip("pairs", "in_docs")).alias("p")).select(
        F.col("p.pairs").alias("pair"), F.col("p.in_docs").alias("n"))
    counts = each.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    a_id = F.floor(F.col("pair") / F.lit(n_b))
    return counts.withColumn("a_id", a_id).withColumn(
        "best", F.col("n_docs") == F.max("n_docs").over(
            Window.partitionBy("a_id"))).drop("a_id")


def token_alignment(docs: DataFrame, a_path: str = f"{TOKENIZERS}/{A_FILE}",
                    b_path: str = f"{TOKENIZERS}/{B_FILE}") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose count is the highest of their A id), count_sum (the links' counts
    added up), groups_sha256."""
    import sentencepiece
    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    blocks = align_documents(docs, a_path, b_path)
    counts = stored(pair_counts(blocks, n_b), "pair-counts")
    wanted = blocks.where("pairs is not null").select(
        "block", F.posexplode("pairs").alias("at", "pair"))
    found = wanted.join(counts, "pair").select(
        F.col("block").alias("of_block"), "at", "n_docs", "best")
    rows = blocks.where("pairs is null").drop("pairs", "in_docs")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = pa.schema([("doc_id", _arrow_type(docs)),
                     *[(c, pa.int64()) for c in ("n_a", "n_b", "n_groups",
                                                 "n_links", "n_best",
                                                 "count_sum")],
                     ("groups_sha256", pa.string())])

    def add_up(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        at = theirs.column("at").to_numpy()
        n, best = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
        n[at] = theirs.column("n_docs").to_numpy()
        best[at] = theirs.column("best").to_numpy(zero_copy_only=False)
        sums_, bests = [], []
        for data in mine.column("links"):
            p, times = unpack(data.as_py())
            sums_.append(int((n[p] * times).sum()))
            bests.append(int(times[best[p]].sum()))
        cols = {c: mine.column(c) for c in out.names if c in mine.column_names}
        cols |= {"n_best": pa.array(bests, pa.int64()),
                 "count_sum": pa.array(sums_, pa.int64())}
        return pa.table([cols[c] for c in out.names], schema=out)
    return rows.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(
        add_up, f"doc_id {id_type}, n_a long, n_b long, n_groups long, "
        "n_links long, n_best long, count_sum long, groups_sha256 string")
