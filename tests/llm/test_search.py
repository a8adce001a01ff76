"""Vector and lexical search against plain Python versions."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import common, hnsw, lexical_search as lex
from pricelake.llm.queries import op11_hnsw
from tests.llm import brute_search as brute
from tests.llm.conftest import clash, doc_frame


# ------------------------------------------------------------------ op 11

def gauss(rng, n, dim):
    return [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(n)]


def recall(found, want):
    """Share of the wanted neighbours found, ties by distance."""
    hits = total = 0
    for key, best in want.items():
        got = found.get(key, [])
        limit = best[-1][0] if best else 0
        hits += sum(d <= limit + 1e-9 for d, _ in got)
        total += len(best)
    return hits / total


def run(index, mod, k=10):
    out = {}
    for q, r, i, d in hnsw.nearest(index, F.col("vec_id") % mod == 0, k) \
            .orderBy("query_id", "rank").collect():
        out.setdefault(q, []).append((d, i))
        assert len(out[q]) == r
    return out


@pytest.mark.parametrize("shard", [8192, 97])
def test_nearest(spark, arrow_rows, shard):
    rng = random.Random(4)
    v = gauss(rng, 700, 8)
    v = [v[0] if i % 3 == 0 else x for i, x in enumerate(v)]     # copies
    odd = [None, [], [0.0] * 8, [math.nan] + [1.0] * 7, [math.inf] * 8,
           [None] + [1.0] * 7, [1.0, 2.0], [1.0, 3.0]]
    data = [*enumerate(v), *((1000 + i, x) for i, x in enumerate(odd)),
            (None, v[1])]
    df = clash(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    got = run(hnsw.build_index(df, shard=shard), 10)
    want = {i: b for (_, i), b in brute.nearest(data, lambda i: i % 10 == 0).items()}
    assert set(got) <= set(want)
    for q, best in got.items():
        assert best == sorted(best) and all(i != q for _, i in best)
        for d, i in best:
            x, y = (data[j][1] for j in (q if q < 1000 else 700 + q - 1000,
                                         i if i < 1000 else 700 + i - 1000))
            assert d == pytest.approx(math.dist(x, y), rel=1e-12)
    assert recall(got, {q: b for q, b in want.items() if b}) >= 0.95
    # a third of all rows are one vector: ties by id, exactly
    assert [i for _, i in got[0]] == list(range(3, 33, 3))
    assert [i for _, i in got[30]] == list(range(0, 30, 3))


def test_nearest_repeated_rows(spark):
    """Rows that repeat id and vector are candidates of one another."""
    data = [(0, [1.0, 1.0])] * 3 + [(1, [1.0, 1.0]), (2, [5.0, 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    rows = hnsw.nearest(hnsw.build_index(df), F.col("vec_id") == 0).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows) == sorted(
        [(0, 1, 0, 0.0), (0, 2, 0, 0.0), (0, 3, 1, 0.0), (0, 4, 2, 4.0)] * 3)
    assert hnsw.nearest(hnsw.build_index(df.limit(0)), F.lit(True)).count() == 0
    with pytest.raises(ValueError):
        hnsw.nearest(hnsw.build_index(df, k=3), F.lit(True), k=4)


def test_queries_are_sent_in_bounded_blocks(spark, monkeypatch):
    """No more than a block of queries is broadcast at once, whatever the number
    of shards, and the results do not depend on the blocks."""
    rng = random.Random(9)
    df = spark.createDataFrame(list(enumerate(gauss(rng, 600, 8))),
                               "vec_id long, embedding array<double>")
    index = hnsw.build_index(df, shard=60)
    monkeypatch.setattr(hnsw, "CHUNK", 20)
    whole = run(index, 2)
    plans = []
    append = common._append

    def seen(df, path):
        if "ann-found" in path:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return append(df, path)
    monkeypatch.setattr(common, "_append", seen)
    monkeypatch.setattr(hnsw, "SENT_BYTES", 20 * 8 * 8 * 4)
    assert run(index, 2) == whole and len(whole) == 300
    assert len(plans) == 4          # 15 chunks, at most 4 at once
    assert all("Generate" not in p for p in plans)


def test_graph_levels_and_links():
    x = np.random.default_rng(0).normal(size=(1500, 12)).astype(np.float32)
    g = hnsw.build_graph(x)
    assert g["sizes"][0] == 1500 and len(g["sizes"]) > 1
    bottom = g["neighbours"][:1500 * 2 * hnsw.LINKS].reshape(1500, -1)
    assert (bottom != np.arange(1500)[:, None]).all()
    assert ((bottom >= 0).sum(1) > 0).all()
    d = hnsw.distances(x[:200], x)
    want = np.argsort(d, 1)[:, :10]
    got = hnsw.search_graph(g, x, x[:200], hnsw.EF)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(got, want)]) / 10 >= 0.95
    # far-apart groups stay connected through the upper levels
    centres = np.random.default_rng(1).normal(size=(50, 12)) * 50
    y = (centres[np.arange(2000) % 50]
         + np.random.default_rng(2).normal(size=(2000, 12))).astype(np.float32)
    got = hnsw.search_graph(hnsw.build_graph(y), y, y[:200], hnsw.EF)[:, :10]
    want = np.argsort(hnsw.distances(y[:200], y), 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(got, want)]) / 10 >= 0.9


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    data = [(r.vec_id, r.embedding) for r in
            spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {i: b for (_, i), b in brute.nearest(data, lambda i: i % 100 == 0).items()}
    got = {}
    for r in op11_hnsw(spark, sf).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert recall(got, want) >= 0.9


# ------------------------------------------------------------------ op 12

def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def item_frame(spark, items):
    return clash(spark.createDataFrame(items, "item_id long, text string"))


def item_rows(texts):
    rng = random.Random(6)
    words = sorted({w for _, t in texts for w in (t or "").split()})
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 25))))
             for i in range(30)]
    return items + [(90, None), (91, ""), (92, "... !"), (93, "nosuchword"),
                    (94, "A a B!"), (94, "A a B!"), (None, "mit license the")]


@pytest.mark.parametrize("block", [1 << 17, 40])
def test_ranked_search(spark, texts, arrow_rows, block):
    items = item_rows(texts)
    docs = texts + [(500, "a b a"), (500, "a b a"), (None, "a b a"), (501, "a b a")]
    got = lex.ranked_search(doc_frame(spark, docs), item_frame(spark, items),
                            query_terms=block)
    assert result(got) == sorted(brute.ranked(docs, items), key=str)


def test_ranked_search_empty(spark, texts):
    docs, items = doc_frame(spark, texts), item_frame(spark, [(1, "a b")])
    assert lex.ranked_search(docs.limit(0), items).count() == 0
    assert lex.ranked_search(docs, items.limit(0)).count() == 0
    assert lex.ranked_search(docs, items.where("item_id = 2")).count() == 0


def test_summaries_bound_and_skip():
    """Bounds hold for every member, some blocks are skipped, and the best are
    those of scoring every document."""
    rng = np.random.default_rng(5)
    topics = [rng.choice(300, 40, replace=False) for _ in range(12)]
    rows = [np.unique(rng.choice(topics[i % 12], 15)) for i in range(3000)]
    terms = np.concatenate(rows).astype(np.int32)
    ends = np.cumsum([len(r) for r in rows])
    values = rng.integers(1, 1000, len(terms))
    queries = [np.sort(rng.choice(topics[i], 8, replace=False)).astype(np.int32)
               for i in range(12)]
    ids = np.arange(3000)[::-1].copy()
    s = lex.build_shard(ids, np.zeros(3000, bool), ends, terms, values,
                        lex.partners(queries, 300), block=20)
    starts = ends - np.diff(ends, prepend=0)
    skipped = 0
    for q in queries:
        score = np.array([values[a:b][np.isin(terms[a:b], q)].sum()
                          for a, b in zip(starts, ends)])
        want = np.lexsort((ids, -score))[:10]
        docs, scores, n, done = lex.search_shard(s, q, 300, 10, 1)
        assert docs.tolist() == want.tolist()
        assert scores.tolist() == score[want].tolist()
        skipped += n - done
        some, _, _, one = lex.search_shard(s, q, 300, 10, None)
        assert one == 1 and len(some)
        for b in np.flatnonzero(np.isin(s["block_terms"], q)):
            t = s["block_terms"][b]
            t0 = s["top_ends"][b - 1] if b else 0
            top = s["tops"][t0:s["top_ends"][b]]
            bound = top[np.isin(s["top_terms"][t0:s["top_ends"][b]], q)].sum()
            m0 = s["block_ends"][b - 1] if b else 0
            # without the rarer terms of the item
            for d in s["members"][m0:s["block_ends"][b]]:
                own = terms[starts[d]:ends[d]]
                if not np.isin(own[own < t], q).any():
                    assert score[d] <= bound
    assert skipped > 500
