"""Toxicity scores from a small convolutional text classifier in numpy.

Words (runs of digits, letters with A-Z lower-cased, and non-ASCII characters)
and their first bytes are hashed to rows of an embedding table and summed, so
that inflected and compound forms share their stem; filters of several widths
slide over the word sequence of the whole text, each gives its largest
rectified value, and a logistic layer turns these into a logit.

*Training* learns from every labelled document whose ``crc32(doc_id) mod 3`` is
not 1; rows alike in id and text count once.  They are joined with their labels
once and stored in shards of about ``SHARD_ROWS`` rows by hash; then

1. a quarter, chosen by hash, is kept aside; the words of all others are counted
   (documents they are in) to find those that are learned;
2. in each of ``ROUNDS`` rounds, every shard takes the present weights through
   all its rows, some times over, in its task; what each weight moved by is
   averaged over the shards that moved it, by an aggregation.  Only the weights,
   whose number is fixed, reach the driver;
3. all rows are scored, and one threshold for each language is set from counts of
   their logits (on a grid of 1 / ``GRID``) of the rows kept aside.  The language
   is guessed from common words of the text itself, and the logit is shifted so
   that the threshold of its language scores 0.7.

Neither labels nor lang, source or doc_id enter a score.

*Scoring* is one map over all rows without a shuffle.

Defined cases: null and empty texts have no word and get the score of the bias
alone; a null doc_id counts as the empty string for the hold-out; rows that
repeat an id share its label (toxic if any is); without labels of both classes
every score is 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.llm import textkernel as tk
from pricelake.llm.common import discard, stored, stored_at

SHARD_ROWS = 3000    # rows that one shard of the training rows aims at
BITS = 17            # 2**BITS rows of embeddings, row 0 stays zero
STEMS = (3, 4, 5, 6, 7)   # lengths of the hashed word starts, in bytes
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8          # of each width
ROUNDS = 3           # after each, the weights of all shards are averaged
EPOCHS = 6           # times that a row is learned from, in all rounds
STEPS = 600          # steps that a single shard makes at least
BATCH = 32
UNIT = 1 << 32       # moves are summed as whole numbers, in any order
GRID = 256           # steps of a logit that thresholds tell apart
TOP = 1 << 15        # of the grid
MIN_DOCS = 3         # documents a word must be in to be learned ...
MIN_SHARE = 0.002    # ... and the share of them
THRESHOLD = 0.7
MIN_CALIBRATION = 8  # positives a language needs for a threshold of its own

# Common words that tell a language.
COMMON_WORDS = {
    "en": ("the", "and", "of", "is", "that", "this", "was", "with"),
    "de": ("der", "die", "und", "das", "ist", "mit", "nicht", "eine"),
    "fr": ("le", "les", "et", "est", "des", "une", "pour", "dans"),
    "es": ("el", "los", "las", "y", "por", "del", "con", "una"),
}
LANGUAGES = ("other", *COMMON_WORDS)


def held_out(id_col: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))
                   .cast("binary")) % 3 == 1


def _word_ids(data, off):
    """Per word its embedding rows and document; per document its language."""
    starts, ends, doc = tk.words(data, off, tk.ALNUM)
    h = tk.string_hashes(data, starts, ends)
    n = len(off) - 1
    votes = np.zeros((len(LANGUAGES), n))
    votes[0] = 0.5
    for k, words in enumerate(COMMON_WORDS.values(), 1):
        keys = np.array([tk.hash_of(w) for w in words])
        votes[k] = np.bincount(doc[np.isin(h, keys)], minlength=n)
    ids = np.zeros((len(h), 1 + len(STEMS)), np.int32)
    ids[:, 0] = h >> np.uint64(64 - BITS)
    for j, size in enumerate(STEMS, 1):
        long = np.flatnonzero(ends - starts > size)
        ids[long, j] = tk.string_hashes(
            data, starts[long], starts[long] + size) >> np.uint64(64 - BITS)
    return ids, doc, votes.argmax(0)


class Model:
    def __init__(self, emb, filters, out, bias, shift):
        self.emb, self.filters, self.out = emb, filters, out
        self.bias, self.shift = bias, shift

    def logits(self, ids, doc, n: int) -> np.ndarray:
        """Uncalibrated logits of the ``n`` documents of a chunk."""
        first = np.searchsorted(doc, np.arange(n))
        has = np.diff(np.append(first, len(doc))) > 0
        pooled = np.zeros((n, len(WIDTHS) * FILTERS), np.float32)
        x = np.zeros((len(ids), DIM), np.float32)
        for j in range(ids.shape[1]):
            x += self.emb[ids[:, j]]
        for k, (w, own) in enumerate(zip(WIDTHS, self.filters)):
            m = len(ids) - w + 1
            if m <= 0:
                continue
            conv = np.zeros((len(ids), FILTERS), np.float32)
            for j in range(w):
                conv[:m] += x[j:j + m] @ own[j]
            conv[:m][doc[:m] != doc[w - 1:]] = 0
            np.maximum(conv, 0, out=conv)
            pooled[has, k * FILTERS:(k + 1) * FILTERS] = \
                np.maximum.reduceat(conv, first[has])
        return pooled @ self.out + self.bias

    def scores(self, col) -> np.ndarray:
        data, off = tk.buffers(col)
        out = np.zeros(len(off) - 1)
        for a, b in tk.doc_chunks(off, 1 << 21):
            ids, doc, lang = _word_ids(data[off[a]:off[b]], off[a:b + 1] - off[a])
            out[a:b] = self.logits(ids, doc, b - a) + self.shift[lang]
        return 1 / (1 + np.exp(-np.clip(out, -60, 60)))


class Constant:
    """The model without labels of both classes."""

    def scores(self, col) -> np.ndarray:
        return np.zeros(len(col))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic",
                  shard_rows: int = SHARD_ROWS) -> DataFrame:
    """shard, aside, label, text: all rows that may be learned from, stored in
    the order of their shards and, within one, of a hash."""
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
             .where(~held_out(id_col)).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(label_col).cast("int").alias("label")))
    known = stored(known, "toxic-labels")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")) \
        .join(known, "id").select("id", "label", "text")
    shards = max(1, -(-rows.count() // shard_rows))

    def by_hash(seed):
        return F.xxhash64(F.lit(seed), "id", "text")
    # repeated rows of an id: one of each text
    rows = rows.withColumn("shard", F.pmod(by_hash(0), F.lit(shards)).cast("int")) \
        .repartition(shards, "shard").distinct() \
        .sortWithinPartitions("shard", by_hash(2), "id", "text")
    return stored(rows.select("shard", (F.pmod(by_hash(1), F.lit(4)) == 3)
                              .alias("aside"), "label", "text"), "toxic-rows")


def _chunks(batch: pa.RecordBatch, col: int, limit: int = 1 << 20):
    """First and last row, embedding rows, document and language per chunk."""
    data, off = tk.buffers(batch.column(col))
    for a, b in tk.doc_chunks(off, limit):
        yield a, b, *_word_ids(data[off[a]:off[b]], off[a:b + 1] - off[a])


def word_documents(rows: DataFrame) -> np.ndarray:
    """In how many of the rows each embedding row occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << BITS, np.int64)
        for batch in batches:
            for _, _, ids, doc, _ in _chunks(batch, 0):
                own = np.unique((doc[:, None] << BITS) + ids)
                seen += np.bincount(own & ((1 << BITS) - 1), minlength=len(seen))
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])],
                                         names=["slot", "n"])
    counts, path = stored_at(
        rows.select("text").mapInArrow(run, "slot long, n long")
        .groupBy("slot").agg(F.sum("n").alias("n")), "toxic-words")
    got = counts.toArrow()                  # at most 2**BITS rows
    discard(rows.sparkSession, path)
    seen = np.zeros(1 << BITS, np.int64)
    seen[np.asarray(got.column(0))] = np.asarray(got.column(1))
    return seen


N_FILTERS = len(WIDTHS) * FILTERS
N_DENSE = sum(WIDTHS) * DIM * FILTERS + N_FILTERS + 1


def _views(weights: np.ndarray):
    """emb, filters, out, bias: parts of the one table of all weights."""
    dense = weights[1 << BITS:].reshape(-1)
    filters, at = [], 0
    for w in WIDTHS:
        filters.append([dense[at + j * DIM * FILTERS:at + (j + 1) * DIM * FILTERS]
                        .reshape(DIM, FILTERS) for j in range(w)])
        at += w * DIM * FILTERS
    return (weights[:1 << BITS], filters, dense[at:at + N_FILTERS],
            dense[at + N_FILTERS:at + N_FILTERS + 1])


def _first_weights(known: np.ndarray, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    weights = np.zeros(((1 << BITS) - (-N_DENSE // DIM), DIM), np.float32)
    emb, filters, out, _ = _views(weights)
    emb[:] = rng.normal(0, 0.3, emb.shape)
    emb[~known] = 0
    for w, own in zip(WIDTHS, filters):
        for f in own:
            f[:] = rng.normal(0, 0.5 / w, f.shape)
    out[:] = rng.normal(0, 0.3, out.shape)
    return weights


def _averaged(rows: DataFrame, weights: np.ndarray, known: np.ndarray,
              weight: tuple[float, float], passes: int, seed: int) -> np.ndarray:
    """The weights after one round: the mean move of each, over the shards that
    moved it."""
    names = [f"m{j}" for j in range(DIM)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = own = None

        def moved():
            move = np.rint((own.weights - weights).astype(np.float64)
                           * UNIT).astype(np.int64)
            at = np.flatnonzero(move.any(1))
            return pa.RecordBatch.from_arrays(
                [pa.array(at), *[pa.array(move[at, j]) for j in range(DIM)]],
                names=["slot", *names])
        for batch in batches:
            of = np.asarray(batch.column(0))
            cut = np.flatnonzero(np.diff(of, prepend=of[:1] - 1))
            for a, b in zip(cut, np.append(cut[1:], len(of))):
                if of[a] != shard:
                    if own is not None:
                        yield moved()
                    shard = of[a]
                    own = _Learner(weights, known, weight,
                                   [seed, int(shard)])
                part = batch.slice(a, b - a)
                label = np.asarray(part.column(1))
                for c, d, ids, doc, _ in _chunks(part, 2, 1 << 22):
                    own.learn(ids, doc, label[c:d], passes)
        if own is not None:
            yield moved()
    kinds = ", ".join(f"{x} long" for x in names)
    moves, path = stored_at(
        rows.select("shard", "label", "text")
        .mapInArrow(run, f"slot long, {kinds}").groupBy("slot")
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(x).alias(x) for x in names]),
        "toxic-moves")
    got = moves.toArrow()                   # a row per weight row at most
    discard(rows.sparkSession, path)
    at, n, *by = (np.asarray(c) for c in got.columns)
    weights = weights.copy()
    weights[at] += (np.stack(by, 1) / (n[:, None] * float(UNIT))).astype(np.float32)
    return weights


def _cuts(model: Model, rows: DataFrame) -> np.ndarray:
    """Per language the logit from which a text is toxic."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, ids, doc, lang in _chunks(batch, 2):
                at = np.floor(model.logits(ids, doc, b - a) * GRID)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(lang.astype(np.int32)),
                     pa.array(np.clip(at, -TOP, TOP).astype(np.int32))],
                    names=["aside", "label", "lang", "at"])
    # at most a row per place of the grid and language, kept aside or not
    counts, path = stored_at(
        rows.select("aside", "label", "text")
        .mapInArrow(run, "aside boolean, label int, lang int, at int")
        .groupBy("aside", "lang", "at").agg(
            F.count(F.lit(1)).alias("n"), F.sum("label").alias("hit")),
        "toxic-logits")
    got = counts.toArrow()
    discard(rows.sparkSession, path)
    aside, lang, at, n, hit = (np.asarray(c) for c in got.columns)
    if hit[aside].sum() < MIN_CALIBRATION:
        aside = np.ones(len(aside), bool)
    common = _threshold(at[aside], n[aside], hit[aside])
    cuts = np.full(len(LANGUAGES), common)
    for k in range(len(LANGUAGES)):
        sel = aside & (lang == k)
        if hit[sel].sum() >= MIN_CALIBRATION:
            cuts[k] = _threshold(at[sel], n[sel], hit[sel])
    return cuts


def _threshold(at: np.ndarray, n: np.ndarray, hit: np.ndarray) -> float:
    """Middle of the gap below the cut with the best F1, from the number of
    rows and of those of label 1 at places of the grid."""
    at, back = np.unique(at, return_inverse=True)
    n, hit = (np.bincount(back, x)[::-1] for x in (n, hit))
    at = at[::-1]
    f1 = 2 * np.cumsum(hit) / (np.cumsum(n) + max(1, hit.sum()))
    k = int(f1.argmax())
    below = at[k + 1] + 1 if k + 1 < len(at) else at[k] - GRID
    return float(at[k] + below) / 2 / GRID


class _Learner:
    """The weights of one shard while it learns."""

    def __init__(self, weights, known, weight, seed, rate=0.01):
        self.weights = weights.copy()
        self.emb, self.filters, self.out, self.bias = _views(self.weights)
        self.dense = [*[f for own in self.filters for f in own], self.out,
                      self.bias]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.dense]
        self.m, self.v = np.zeros_like(self.emb), np.zeros_like(self.emb)
        self.known = known.astype(np.float32)[:, None]
        self.weight = np.array(weight)
        self.rng, self.rate, self.step = np.random.default_rng(seed), rate, 0

    def learn(self, ids, doc, labels, passes: int) -> None:
        n = len(labels)
        cut = np.append(np.searchsorted(doc, np.arange(n)), len(doc))
        for _ in range(passes):
            for part in np.array_split(self.rng.permutation(n),
                                       max(1, n // BATCH)):
                self._step([ids[cut[i]:cut[i + 1]] for i in part], labels[part])

    def _step(self, texts, labels) -> None:
        self.step += 1
        n = len(texts)
        first = np.append(0, np.cumsum([len(t) for t in texts]))
        ids = np.concatenate(texts)
        x = self.emb[ids].sum(1)
        pooled = np.zeros((n, N_FILTERS), np.float32)
        where = np.zeros((n, N_FILTERS), np.int64)
        cols = np.arange(FILTERS)
        for k, own in enumerate(self.filters):
            m = len(x) - len(own) + 1
            if m <= 0:
                continue
            conv = sum(x[j:j + m] @ f for j, f in enumerate(own))
            s = slice(k * FILTERS, (k + 1) * FILTERS)
            for r in range(n):
                part = conv[first[r]:first[r + 1] - len(own) + 1]
                if len(part):
                    at = part.argmax(0)
                    where[r, s] = first[r] + at
                    pooled[r, s] = np.maximum(part[at, cols], 0)
        logit = pooled @ self.out + self.bias[0]
        err = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels)
               * self.weight[labels] / n).astype(np.float32)
        back = err[:, None] * self.out * (pooled > 0)
        grads, rows, vals = [], [], []
        for k, own in enumerate(self.filters):
            s = slice(k * FILTERS, (k + 1) * FILTERS)
            r, c = np.nonzero(back[:, s])
            d, at = back[:, s][r, c], where[:, s][r, c]
            for j, f in enumerate(own):
                g = np.zeros((FILTERS, DIM), np.float32)
                np.add.at(g, c, d[:, None] * x[at + j])
                grads.append(g.T + 1e-4 * f)
                rows.append(ids[at + j].ravel())
                vals.append(np.repeat(d[:, None] * f[:, c].T, ids.shape[1],
                                      axis=0))
        grads += [pooled.T @ err + 1e-3 * self.out, err.sum(keepdims=True)]
        at, back = np.unique(np.concatenate(rows), return_inverse=True)
        if len(at):
            total = np.zeros((len(at), DIM), np.float32)
            np.add.at(total, back, np.concatenate(vals))
            total = (total + 1e-5 * self.emb[at]) * self.known[at]
            # only the touched rows move
            self.m[at] = 0.9 * self.m[at] + 0.1 * total
            self.v[at] = 0.99 * self.v[at] + 0.01 * total ** 2
            self.emb[at] -= self.rate * self.m[at] / (np.sqrt(self.v[at]) + 1e-6)
        for p, d, (m, v) in zip(self.dense, grads, self.moments):
            m += 0.1 * (d - m)
            v += 0.01 * (d * d - v)
            p -= self.rate * (m / (1 - 0.9 ** self.step)) \
                / (np.sqrt(v / (1 - 0.99 ** self.step)) + 1e-6)


def fit(rows: DataFrame, seed: int = 7) -> Model | Constant:
    """The model of the stored ``training_rows``."""
    n = {(r["aside"], r["label"]): r["count"]
         for r in rows.groupBy("aside", "label").count().collect()}
    if len({label for _, label in n}) < 2:
        return Constant()
    n_learn = n.get((False, 0), 0) + n.get((False, 1), 0)
    learn = rows.where(~F.col("aside"))
    known = word_documents(learn) >= max(MIN_DOCS, MIN_SHARE * n_learn)
    known[0] = False
    weight = tuple(0.5 / max(1, n.get((False, k), 0)) * n_learn for k in (0, 1))
    passes = max(EPOCHS, -(-STEPS * BATCH // max(1, n_learn)))
    weights = _first_weights(known, seed)
    for i in range(ROUNDS):
        weights = _averaged(learn, weights, known, weight,
                            -(-passes // ROUNDS), seed + i)
    emb, filters, out, bias = _views(weights)
    model = Model(emb, filters, out, float(bias[0]), np.zeros(len(LANGUAGES)))
    model.shift = np.log(THRESHOLD / (1 - THRESHOLD)) - _cuts(model, rows)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
          text_col: str = "text") -> Model | Constant:
    return fit(training_rows(docs, labels, id_col, text_col))


def toxicity_scores(docs: DataFrame, model, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    kind = docs.schema[id_col].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(model.scores(batch.column(1)))],
                names=[id_col, "score"])
    scored = docs.select(id_col, text_col).mapInArrow(
        score, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int")
                         .alias("predicted"))


def drop_toxic(docs: DataFrame, model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` below the threshold, all columns as they are."""
    at = docs.columns.index(text_col)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(
                model.scores(batch.column(at)) < THRESHOLD))
    return docs.mapInArrow(keep, docs.schema)
