"""Operators against plain Python versions, with the cases that hurt: nulls,
empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelake.llm import (decontamination, graph, licenses, mixing, ngram_join,
                           pii, suffix_dedup, topk_search, toxicity, url_filter,
                           warc)
from tests.llm import brute
from tests.llm.conftest import DOCS, clash, doc_frame


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()),
                  key=lambda r: tuple((x is None, x if x is not None else 0)
                                      for x in r))


def ordered(xs):
    return sorted(xs, key=lambda r: tuple((x is None, x if x is not None else 0)
                                          for x in r))


# ---------------------------------------------------------------- op 1

def vectors(seed, n, dim, ties):
    rng = random.Random(seed)
    one = [rng.gauss(0, .2) for _ in range(dim)]
    out = {}
    for i in range(n):
        v = list(one) if ties and i % 3 == 0 else \
            [rng.gauss(0, .2) for _ in range(dim)]
        out[i] = v
    out[n] = None
    out[n + 1] = [None] * dim
    out[n + 2] = [float("nan")] * dim
    out[n + 3] = [math.inf] + [0.0] * (dim - 1)
    out[n + 4] = []
    out[n + 5] = [5.0] * dim
    out[n + 6] = [1.0]
    return out


@pytest.mark.parametrize("n,dim,ties", [(400, 8, True), (300, 3, False), (3, 4, True)])
def test_top_k(spark, arrow_rows, n, dim, ties):
    v = vectors(n, n, dim, ties)
    data = [*v.items(), (None, [1.0] * dim), (0, v[0])]
    df = clash(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    index = topk_search.build_index(df, pivots=5)
    got = topk_search.top_k(index, F.col("vec_id") % 10 == 0)
    assert rows(got, "query_id", "rank", "vec_id", "score") == \
        brute.top_k(data, lambda q: q % 10 == 0)


def test_top_k_small_cells(spark, monkeypatch):
    monkeypatch.setattr(topk_search, "CELL", 16)
    v = vectors(9, 500, 6, True)
    df = spark.createDataFrame(list(v.items()), "vec_id long, embedding array<float>")
    v32 = {i: x and [None if c is None else float(np.float32(c)) for c in x]
           for i, x in v.items()}
    got = topk_search.top_k(topk_search.build_index(df), F.col("vec_id") % 7 == 0)
    assert rows(got, "query_id", "rank", "vec_id", "score") == \
        brute.top_k(v32.items(), lambda q: q % 7 == 0)


def test_top_k_repeated_ids(spark, arrow_rows):
    """Every vector under a repeated id is a candidate, and a query."""
    rng = random.Random(8)
    data = [(i % 60, [rng.gauss(0, .2) for _ in range(4)]) for i in range(300)]
    data += [(7, [rng.gauss(0, .2) for _ in range(4)]) for _ in range(100)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk_search.top_k(topk_search.build_index(df, pivots=5),
                            F.col("vec_id") % 7 == 0)
    assert rows(got, "query_id", "rank", "vec_id", "score") == \
        brute.top_k(data, lambda q: q % 7 == 0)


def test_top_k_repeated_rows(spark):
    """Equal rows count as often as they occur, as the SQL counts them."""
    import duckdb
    import pandas as pd

    from pricelake.llm.queries import OP1_SQL
    data = [(100, [1.0, .5]), (100, [1.0, .5]), (4, [.5, .5]), (4, [.5, .5]),
            (4, [.5, .5]), (5, [-1.0, 0.0]), (200, [.25, .75])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = topk_search.top_k(topk_search.build_index(df), F.col("vec_id") % 100 == 0)
    cols = ("query_id", "rank", "vec_id", "score")
    con = duckdb.connect()
    con.register("embeddings", pd.DataFrame(data, columns=["vec_id", "embedding"]))
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({OP1_SQL})").fetchall()
    assert rows(got, *cols) == ordered(want) == \
        brute.top_k(data, lambda q: q % 100 == 0)


def test_top_k_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(topk_search.build_index(df),
                             F.col("vec_id") % 2 == 0).count() == 0


# ---------------------------------------------------------------- op 2

def test_contamination(spark, texts):
    items = [(i, " ".join(t.split()[2:40])) for i, t in texts[20:60]]
    items += [(100, None), (101, "..."), (102, "short one"), (None, texts[30][1]),
              (3, items[0][1]), (103, "a"), (104, "no such words anywhere here")]
    docs = [*texts, (7, texts[30][1]), (200, "so short ONE, a"), (None, "a")]
    bench = clash(spark.createDataFrame(items, "item_id long, text string"))
    got = decontamination.contamination(decontamination.build_index(
        doc_frame(spark, docs), bench))
    cols = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows(got, *cols) == ordered(brute.contamination(docs, items))


def test_contamination_empty(spark, texts):
    docs = doc_frame(spark, texts[:20])
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontamination.contamination(decontamination.build_index(docs, none))
    assert got.count() == 20 and got.where("contaminated").count() == 0
    got = decontamination.contamination(decontamination.build_index(
        docs.limit(0), spark.createDataFrame([(1, "a b")], none.schema)))
    assert got.count() == 0


def test_proximity(spark):
    docs = doc_frame(spark, [(1, "x one two NEW three y"), (2, "three two one"),
                             (3, "one z z z z two three"), (4, "one two three")])
    items = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    index = decontamination.build_index(docs, items, slop=1)
    got = decontamination.matches(index).join(index.docs, "rid")
    assert rows(got, "doc_id", "exact") == [(1, False), (2, False), (4, True)]


# ---------------------------------------------------------------- op 3

def test_suffix_array():
    rng = random.Random(3)
    for _ in range(400):
        a = np.array([rng.randint(1, 3) for _ in range(rng.randint(1, 40))])
        assert suffix_dedup.suffix_array(a).tolist() == \
            sorted(range(len(a)), key=lambda i: a[i:].tolist())


def test_suffix_array_large_values():
    """Values whose triples do not fit 64 bits."""
    rng = random.Random(4)
    top = (1 << 31) - 1
    for n in (*range(1, 40), 400):
        a = np.array([rng.choice([1, 2, top // 2, top - 1, top])
                      for _ in range(n)])
        assert suffix_dedup.suffix_array(a).tolist() == \
            sorted(range(n), key=lambda i: a[i:].tolist())


def test_suffix_dedup_full_bit_table(spark, monkeypatch):
    """Only first copies are sorted, also when every piece passes the table."""
    rng = random.Random(12)
    common = "".join(rng.choice("abcdefgh ") for _ in range(400))
    docs = [(i, "".join(rng.choice("xyz") for _ in range(40)) + common[i % 7:]
             + "".join(rng.choice("xyz") for _ in range(40))) for i in range(120)]
    seen = []

    def spy(texts, inner=suffix_dedup.sorted_spans):
        seen.append([tuple(r) for r in texts.select("seed", "body").collect()])
        return inner(texts)
    monkeypatch.setattr(suffix_dedup, "sorted_spans", spy)
    monkeypatch.setattr(suffix_dedup, "hashed_set",
                        lambda names, bits: np.full(bits >> 3, 255, np.uint8))
    got = suffix_dedup.suffix_dedup(doc_frame(spark, docs))
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == \
        brute.substring_dedup(docs)
    # no piece twice, and none alone with its seed
    (pairs,) = seen
    assert pairs and len(set(pairs)) == len(pairs)
    seeds = [s for s, _ in pairs]
    assert all(seeds.count(s) > 1 for s in set(seeds))


@pytest.mark.parametrize("group", [4096, 2])
def test_suffix_dedup(spark, arrow_rows, texts, group, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP", group)
    rng = random.Random(11)
    base = "".join(rng.choice("abcdefgh ") for _ in range(500))
    docs = [*texts, (900, "q" * 5000), (901, "ab" * 700), (902, base * 6),
            (903, base[7:] * 5), (904, "é" * 300)]
    docs += [(1000 + i, base[rng.randint(0, 400):] + "".join(
        rng.choice("xyz") for _ in range(rng.randint(0, 60)))
        + base[rng.randint(0, 499):]) for i in range(40)]
    got = suffix_dedup.suffix_dedup(doc_frame(spark, docs))
    want = brute.substring_dedup(docs)
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == want


def test_suffix_dedup_long_text(spark):
    rng = random.Random(2)
    body = "".join(rng.choice("abcdefghij ") for _ in range(200_000))
    docs = [(1, body), (2, "zz" + body[50_000:190_000] + "yy"), (3, body * 2)]
    got = suffix_dedup.suffix_dedup(doc_frame(spark, docs))
    want = {1: 0, 2: 140_000, 3: 400_000}
    assert {r.doc_id: r.n_removed for r in got.collect()} == want


def test_suffix_dedup_repeated_ids(spark):
    t = "".join(chr(97 + (i * i) % 26) + str(i) for i in range(60))
    docs = [(1, t), (1, t), (None, t), (2, "b" + t), (3, None)]
    got = rows(suffix_dedup.suffix_dedup(doc_frame(spark, docs)),
               "doc_id", "n_bytes", "n_removed")
    n = len(t)
    assert got == [(1, n, 0), (1, n, n), (2, n + 1, n), (3, 0, 0), (None, n, n)]
    empty = doc_frame(spark, docs).limit(0)
    assert suffix_dedup.suffix_dedup(empty).count() == 0


# ---------------------------------------------------------------- op 4

def test_url_filter(spark):
    urls = [None, "", "no scheme/x", "http://A.NET/x", "http://net/", "http://net",
            "https://x.example.net/en/1", "https://example.net/en", "a://b.org/fr/",
            "http://org.com/fr/", "http://example.com/de/?a=b#c", "x://h?q/de/",
            "http://myexample.com/de/1", "p://u:p@Ex.Org:80/fr/a://b", "http://é.org/ß",
            "http://x.net#/en/", "http://" + "a" * 5000 + "/" + "b" * 5000]
    pages = [(i, u, None) for i, u in enumerate(urls)] + [(3, urls[3], ""), (None, urls[9], "")]
    df = clash(spark.createDataFrame(pages, "page_id long, url string, html string"))
    weights = [math.sin(i) for i in range(url_filter.DIM)] + [-0.1]
    got = url_filter.url_filter(df, weights)

    def verdict(url):
        import xxhash
        host, path, rule, v = brute.url_rule(url)
        s = f"^{host}{path}$" if host or path else ""
        grams = [s[i:i + n] for n in url_filter.GRAMS for i in range(len(s) - n + 1)]
        w = sum(weights[xxhash.xxh64_intdigest(g.encode(), 42) % url_filter.DIM
                        if xxhash.xxh64_intdigest(g.encode(), 42) < 1 << 63 else
                        (xxhash.xxh64_intdigest(g.encode(), 42) - (1 << 64))
                        % url_filter.DIM] for g in grams)
        score = 1 / (1 + math.exp(-(w / math.sqrt(max(1, len(grams))) + weights[-1])))
        return host, path, rule, v or ("block" if score >= .5 else "allow")
    want = ordered((i, *verdict(u)) for i, u, _ in pages)
    assert rows(got, "page_id", "host", "path", "rule", "verdict") == want
    assert url_filter.url_filter(df.limit(0), weights).count() == 0


def test_url_training(spark):
    weights = url_filter.train(url_filter.labelled_table(spark))
    assert len(weights) == url_filter.DIM + 1
    test = [("https://spam-farm.example.com/x/1", 1), ("http://ads-track.example.org/a", 1),
            ("https://www.casino-win.example.com/en/3", 1),
            ("https://reading.example.org/en/7", 0), ("http://town.example.com/es/2", 0)]
    df = spark.createDataFrame(test, "url string, page_id long")
    got = url_filter.url_filter(df, weights)
    assert got.where("(verdict = 'block') <> (page_id = 1)").count() == 0


def test_url_training_hosts(spark):
    """No allowed host of the table occurs among the test pages."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")

    def names(df):
        host = F.regexp_replace(url_filter.url_parts(F.col("url"))[0],
                                r"\.example\.\w+$", "")
        name = F.element_at(F.split(host, r"\."), -1).alias("name")
        return {r.name for r in df.select(name).distinct().collect()} - {""}
    labelled = url_filter.labelled_table(spark)
    assert not names(pages) & names(labelled.where("label = 0"))


# ---------------------------------------------------------------- op 5

def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 8), (8, 7), (5, 5), (10, 4), (2, 1)]
    edges += [(i, i + 1) for i in range(20, 60)] + [(100, i) for i in range(101, 140)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = dict(rows(graph.components(df), "node", "component"))
    want = {**dict.fromkeys([1, 2, 3, 4, 10], 1), **dict.fromkeys([7, 8, 9], 7),
            **dict.fromkeys(range(20, 61), 20), **dict.fromkeys(range(100, 140), 100)}
    assert got == want
    assert graph.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("hot", [32, 2])
def test_ngram_components(spark, arrow_rows, texts, hot, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", hot)
    docs = [*texts, (None, texts[40][1]), (3, texts[41][1]), (3, texts[41][1]),
            (None, "only null ids here and there"), (500, "a  B\tc")]
    got = ngram_join.ngram_components(doc_frame(spark, docs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == \
        ordered(brute.ngram_components(docs))


def test_ngram_threshold(spark):
    rng = random.Random(1)
    docs = []
    for i in range(40):                  # pairs around the threshold
        w = [f"w{i}x{j}" for j in range(rng.randint(8, 60))]
        v = list(w)
        for _ in range(rng.randint(0, 3)):
            v[rng.randrange(len(v))] = "new"
        docs += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(v[rng.randint(0, 2):]))]
    got = ngram_join.ngram_components(doc_frame(spark, docs))
    want = brute.ngram_components(docs)
    assert 0 < sum(c != d for d, _, c in want) < 40
    assert rows(got, "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.ngram_components(doc_frame(spark, docs).limit(0)).count() == 0


def test_ngram_pairs_that_only_share_a_passage_never_meet(spark):
    """Sets with a long passage in common but differing bitmaps are ruled out in
    the join itself; equal bitmaps are not."""
    known = spark.createDataFrame(
        [(k, node, 400, k, node, node) for node in range(12) for k in range(30)],
        "k long, node long, n int, pos int, c long, centre long")
    rng = np.random.default_rng(3)
    own = [rng.bytes(ngram_join.PARITY_BITS // 8) for _ in range(11)]
    nodes = spark.createDataFrame(
        [(i, 400, bytearray(b)) for i, b in enumerate([*own, own[0]])],
        "node long, n long, bits binary")
    got = ngram_join._prefix_pairs(known, nodes)
    assert rows(got, "a", "b") == [(0, 11)]


def family_prefixes(seed=4):
    """Sets of three families, most pairs of which share many shingles, each in
    a bundle of its own, and the prefix rows of all of them."""
    rng = random.Random(seed)
    sets = []
    for family in range(3):
        base = rng.sample(range(family * 1000, family * 1000 + 1000), 200)
        sets += [set(rng.sample(base, 200 - off)) | set(rng.sample(range(3000), off))
                 for off in (3, 5, 8, 8, 12, 12, 15, 20, 25, 30)]
    prefixes = []
    for node, x in enumerate(sets):
        n = len(x)
        first = n - ngram_join.least_overlap(n) + ngram_join.least_met(n)
        prefixes += [(k, node, n, pos, node, node)
                     for pos, k in enumerate(sorted(x)[:first])]
    return sets, prefixes


@pytest.mark.parametrize("first", [1, 4, 32])
def test_ngram_pairs_are_made_once(spark, first, monkeypatch):
    """The join of bundles makes a pair about once, however many bundles it
    shares, and loses no link."""
    from pyspark.sql import Column
    monkeypatch.setattr(ngram_join, "FIRST", first, raising=False)
    sets, prefixes = family_prefixes()
    known = spark.createDataFrame(
        prefixes, "k long, node long, n int, pos int, c long, centre long")
    nodes = spark.createDataFrame(
        [(i, len(x), bytearray(ngram_join.PARITY_BITS // 8))
         for i, x in enumerate(sets)], "node long, n long, bits binary")
    made, join = [], type(known).join

    def counted(self, other, on=None, how=None):
        got = join(self, other, on, how)
        if isinstance(on, Column):
            made.append(got.count())
        return got
    monkeypatch.setattr(type(known), "join", counted)
    got = set(rows(ngram_join._prefix_pairs(known, nodes), "a", "b"))

    links, often = set(), set()
    for b, y in enumerate(sets):
        for a, x in enumerate(sets[:b]):
            both = len(x & y)
            if 100 * both >= 85 * (len(x) + len(y) - both):
                links.add((a, b))
            if both >= ngram_join.least_met(min(len(x), len(y))):
                often.add((a, b))
    assert len(links) > 20 and links <= got <= often
    assert len(made) == 1
    if first == 32:
        assert made[0] <= 1.1 * len(often)


# ---------------------------------------------------------------- op 6

@pytest.mark.parametrize("per_cell", [8192, 4])
def test_mix(spark, texts, per_cell, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_CELL", per_cell)
    df = doc_frame(spark, [*texts, (5, texts[5][1]), (None, "a b")])
    got = mixing.mix_sources(df).collect()
    want = brute.mix([(r.doc_id, r.source, r.text) for r in df.collect()])
    assert len(got) == len(texts) + 2
    taken = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        assert r.source_size == want[r.source][0]
        assert r.target == pytest.approx(want[r.source][1])
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert taken == {s: math.floor(t + 1e-9) for s, (_, t) in want.items()}
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(df).collect()))


def test_mix_empty(spark):
    df = doc_frame(spark, [(1, None), (2, "")])
    assert rows(mixing.mix_sources(df), "doc_id", "size", "target", "taken") == \
        [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_mix_of_one_id(spark, monkeypatch):
    """Rows of one id or without one are as good as others: the source gives
    exactly its budget, and the SQL agrees."""
    import duckdb
    import pandas as pd
    monkeypatch.setattr(mixing, "COPIES_PER_BLOCK", 7)
    rng = random.Random(3)
    docs = [(None if i % 2 else 5, rng.choice("ab"), "w " * rng.randint(0, 6))
            for i in range(400)] + [(i, "b", "x y z") for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    cols = ("doc_id", "source", "size", "source_size", "target", "taken")
    frame = pd.DataFrame(docs, columns=["doc_id", "source", "text"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", frame)
    got = rows(mixing.mix_sources(df), *cols)
    assert got == ordered(con.execute(
        f"SELECT {', '.join(cols)} FROM ({mixing.sql()})").fetchall())
    assert len(got) == len(docs)


# ---------------------------------------------------------------- op 7

def test_licenses(spark, arrow_rows, texts):
    docs = [*texts, (300, "Released under the MIT Licens."), (301, "MIT-license x mit\nlicense"),
            (302, "Licnsed under the Apache Lisence, Version 2.0"),
            (303, "GNU General   Public LICENSE"), (304, "submit license"),
            (305, "x " * 40_000 + "Licensed under CC BY-NC 4.0.")]
    got = licenses.license_scan(doc_frame(spark, docs))
    base = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    assert rows(got, *base) == ordered(
        (i, *brute.base_licenses(t)) for i, t in docs)
    by = {r.doc_id: r for r in got.where("doc_id >= 300").collect()}
    assert by[300].labels == "mit" and 0.9 < by[300].score < 1
    assert by[302].labels == "apache" and by[302].spans.startswith("apache:0:45:")
    assert by[303].labels == "gpl" and by[303].score == 1
    assert by[304].labels == "" and by[304].score == 0
    assert by[305].labels == "cc-by-nc" and by[305].spans == "cc-by-nc:80000:80027:0"
    assert licenses.license_scan(doc_frame(spark, docs).limit(0)).count() == 0


def test_notice_edits():
    """Every notice with up to its number of edits is found."""
    rng = random.Random(4)
    search = licenses.NoticeSearch()
    for notice, label, edits, _ in search.items:
        for _ in range(10):
            s = list(notice)
            for _ in range(rng.randint(0, edits)):
                j = rng.randrange(len(s))
                s[j] = rng.choice([s[j] + "q", "q", ""])
            found = search.find("zzz zzz " + "".join(s) + " zzz")
            assert found, (notice, "".join(s))


def test_notices_beside_a_better_copy():
    """An edited notice is found on either side of a better copy."""
    search = licenses.NoticeSearch()
    assert search.find("all rihts reserved. all rights reserved. all rights resrved") == [
        ("all-rights-reserved", 0, 18, 1), ("all-rights-reserved", 20, 39, 0),
        ("all-rights-reserved", 41, 59, 1)]
    text = ("al rights reserved\n" * 3 + "all rights reserved\n") * 5
    assert [x[3] for x in search.find(text)] == [1, 1, 1, 0] * 5


def test_notice_time_grows_with_the_text():
    """Windows stay short however many notices follow each other."""
    search, spent = licenses.NoticeSearch(), []
    for n in (250, 4000):
        text = "all rihts reserved\nreleased undr the mit license\n" * n
        start = time.perf_counter()
        found = search.find(text)
        spent.append(time.perf_counter() - start)
        assert [x[0] for x in found] == ["all-rights-reserved", "mit"] * n
    assert spent[1] < 6 * 16 * spent[0]


# ---------------------------------------------------------------- op 8

def test_pii_base():
    rng = random.Random(1)
    alphabet = "a1@.+- ()29é\n"
    for _ in range(5000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 45)))
        got = [x for x in pii.find_spans(t) if x[0] in pii.BASE_KINDS]
        assert got == brute.base_pii(t), t


def test_pii(spark, arrow_rows):
    docs = [(1, None), (2, ""), (3, "mail é a.b@c.de, 1.2.3.4 or 1.2.3.400"),
            (4, "4111 1111 1111 1111 and +49 (30) 123-4567"), (8, "x" * 100_000),
            (5, "IBAN: DE89 3704 0044 0532 0130 00; account number 12-3456"),
            (6, "ftp://bob:secret@host.example/x"), (7, "1" * 6000 + ".1.1.1")]
    df = doc_frame(spark, docs)
    got = {r.doc_id: r for r in pii.pii_spans(df).collect()}
    kinds = ("email", "ip", "card", "phone")
    for i, t in docs:
        # too slow on the long run of digits, which holds no base span
        want = brute.base_pii(t or "") if i != 7 else []
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == \
            [sum(x[0] == k for x in want) for k in kinds], i
        text = ",".join(f"{k}:{a}:{z}" for k, a, z in sorted(
            want, key=lambda x: (kinds.index(x[0]), x[1])))
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
    assert got[3].spans == "email:7:15,ip:17:24"
    assert got[3].base_sha256 == hashlib.sha256(b"email:7:15,ip:17:24").hexdigest()
    assert got[5].n_added == 2 and "iban:6:33" in got[5].spans
    assert "login_url:0:" in got[6].spans
    assert (got[1].n_email, got[1].spans) == (0, "")
    clean = {(r.doc_id, r.n_chars): r.text
             for r in pii.redact_documents(df).collect()}
    assert clean[(3, len("mail é [EMAIL], [IP] or 1.2.3.400"))] == \
        "mail é [EMAIL], [IP] or 1.2.3.400"
    assert clean[(1, 0)] is None
    assert pii.redact_documents(df).columns == df.columns
    assert pii.redact_documents(df.limit(0)).count() == 0


# ---------------------------------------------------------------- op 9

def test_toxicity(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(700):
        w = [rng.choice(vocab) for _ in range(rng.randint(3, 60))]
        bad = i % 5 == 0
        if bad:
            for _ in range(3):
                w[rng.randrange(len(w))] = rng.choice(["grim", "foul", f"nasti{rng.randint(0, 99)}"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs += [(800, None), (801, ""), (5, docs[5][1]), (None, "grim foul grim")]
    labels += [(None, 1), (0, 1), (9999, 0)]
    df = doc_frame(spark, docs)
    lab = clash(spark.createDataFrame(labels, "doc_id long, toxic int"))
    model = toxicity.train(df, lab)
    got = toxicity.toxicity_scores(df, model)
    held = got.where("held_out and doc_id < 700").join(
        lab.dropDuplicates(["doc_id"]), "doc_id")
    assert held.count() > 150
    assert held.where("predicted = toxic").count() >= 0.97 * held.count()
    assert got.count() == len(docs)
    assert got.where("doc_id is null and predicted = 1").count() == 1
    assert got.where("score < 0 or score > 1 or score is null").count() == 0
    kept = toxicity.drop_toxic(df, model)
    assert kept.columns == df.columns
    assert kept.count() == got.where("predicted = 0").count()
    # without labels of both classes nothing is toxic
    none = toxicity.train(df, lab.where("toxic = 0"))
    assert toxicity.toxicity_scores(df, none).where("predicted = 1").count() == 0
    assert toxicity.toxicity_scores(df.limit(0), model).count() == 0


def test_toxicity_learns_from_every_row(spark):
    """More rows of a class than any bounded sample held, in many shards."""
    docs = [(i, f"plain w{i % 50} t{i}" if i % 6 else f"grim w{i % 50} t{i}")
            for i in range(9000)]
    df = doc_frame(spark, docs + docs[:40])          # repeated rows count once
    lab = spark.createDataFrame([(i, int(i % 6 == 0)) for i, _ in docs],
                                "doc_id long, toxic int")
    rows = toxicity.training_rows(df, lab, shard_rows=500)
    learned = lab.where(~toxicity.held_out()).count()
    assert learned > 2 * 2000 and rows.count() == learned
    assert rows.select("shard").distinct().count() > 10
    plain = lab.where(~toxicity.held_out()).where("toxic = 0").count()
    slot = toxicity.tk.hash_of("plain") >> (64 - toxicity.BITS)
    assert toxicity.word_documents(rows)[int(slot)] >= plain
    got = toxicity.toxicity_scores(df, toxicity.fit(rows)).join(lab, "doc_id")
    assert got.where("predicted <> toxic").count() == 0


def test_toxicity_threshold_counts_every_row():
    at, n, hit = np.array([9, 5, -3, 5]), np.array([4, 1, 90, 2]), \
        np.array([4, 1, 0, 1])
    # 9 and 5 are taken: the middle of the gap between 5 and the end of -3
    assert toxicity._threshold(at, n, hit) == (5 - 2) / 2 / toxicity.GRID


# ---------------------------------------------------------------- op 10

def test_warc(spark, arrow_rows):
    rng = random.Random(6)
    big = "".join(rng.choice("abcdefghij<>é \r\n") for _ in range(60_000))
    htmls = ["<a>", None, "", "<a>", big, "WARC/1.1\r\n\r\n", "<a>", big, "\r\n\r\n"]
    pages = [(i * 3 % 23, f"http://h/{i}" if i % 4 else None, h)
             for i, h in enumerate(htmls * 2)]
    pages += [(None, "http://n/ \r\nX: y", "<a>"), (None, None, "alone"), (99, "u", "z"),
              (99, "u", "z")]
    df = clash(spark.createDataFrame(pages, "page_id long, url string, html string"))
    folder, manifest = warc.write_warc(df, shard_bytes=50_000, roll_bytes=9_000)
    got = warc.read_warc(folder, manifest)
    import base64
    top = {}
    for i, _, h in pages:
        top[h or ""] = max(top.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in pages:
        raw = (h or "").encode()
        first = top[h or ""]
        first = None if first == -1 else first
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                     "response" if i == first else "revisit",
                     None if i == first else first))
    cols = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert rows(got, *cols) == ordered(want)
    assert manifest.count() > 4
    # the same rows give the same files
    again = warc.write_warc(df.repartition(5), shard_bytes=50_000, roll_bytes=9_000)[1]
    assert rows(manifest, *manifest.columns) == rows(again, *manifest.columns)


@pytest.mark.parametrize("ids", ["dense", "outlier", "outliers", "hot", "null"])
def test_warc_shards_are_even(spark, ids):
    """No distribution of ids puts most bytes in one shard."""
    n = 1000
    page = {"dense": range(n), "outlier": [*range(n - 1), 1 << 62],
            "outliers": [*range(n - 2), 1 << 40, 1 << 62],
            "hot": [7 if i % 3 else i for i in range(n)], "null": [None] * n}[ids]
    df = spark.createDataFrame(
        [(p, f"http://h/{i}", f"{i:5d}" * 20) for i, p in enumerate(page)],
        "page_id long, url string, html string").repartition(4)
    folder, manifest = warc.write_warc(df, shard_bytes=10_000)
    size = {r[0]: r[1] for r in manifest.groupBy("shard").sum("records").collect()}
    assert len(size) >= 8 and max(size.values()) <= 350, size
    got = warc.read_warc(folder, manifest)
    assert ordered((r.page_id, r.payload_bytes) for r in got.collect()) == \
        ordered((p, 100) for p in page)
    if ids in ("dense", "outlier"):      # shards follow each other by id
        seen = [r.page_id for r in got.orderBy("page_id").collect()]
        assert max(size.values()) <= 210 and seen == sorted(page)


def test_warc_writer_runs_twice(spark):
    """A second attempt of a task leaves the same files and no other."""
    import pyarrow as pa
    from pyarrow.fs import FileSelector

    from pricelake.session import scratch_path
    folder = scratch_path(spark, "warc-twice")
    fs, root = warc._filesystem(folder)
    fs.create_dir(root, recursive=True)
    batch = pa.RecordBatch.from_pydict({
        "shard": pa.array([0] * 50, pa.int32()), "page": list(range(50)),
        "url": [f"u{i}" for i in range(50)],
        "payload": [random.Random(i).randbytes(400) for i in range(50)],
        "response": pa.array([None] * 50, pa.int64()), "revisit": [False] * 50})

    def run():
        out = [b.to_pydict() for b in warc._writer(folder, 5000)(iter([batch]))]
        files = fs.get_file_info(FileSelector(root))
        return out, sorted((f.base_name, f.size) for f in files)
    first = run()
    assert len(first[1]) > 2 and run() == first


def test_warc_min_bytes_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "yyyy"),
                                (4, "d", "yyyy")], "page_id long, url string, html string")
    got = warc.read_warc(*warc.write_warc(df, min_bytes=4))
    assert rows(got, "page_id", "refers_to") == [(1, None), (2, None), (3, 4), (4, None)]
    assert warc.read_warc(*warc.write_warc(df.limit(0))).count() == 0


@pytest.mark.parametrize("seed,hot", [(1, 32), (2, 2), (3, 32)])
def test_ngram_group_of_distant_copies(spark, seed, hot, monkeypatch):
    """Copies of one text, many of them too far apart to link: components
    inside the group come from the differences to its centre."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    monkeypatch.setattr(ngram_join, "MEMBERS", 7)
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 500)}" for _ in range(150)]
    docs, edits = [], []
    for i in range(150):
        w = list(base)
        if i and rng.random() < .4:              # some share earlier edits
            for j, v in rng.choice(edits):
                w[j] = v
        own = [(rng.randrange(150), f"x{rng.randint(0, 60)}")
               for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 11]))]
        for j, v in own:
            w[j] = v
        edits.append(own)
        docs.append((i, " ".join(w[rng.randint(0, 4):150 - rng.randint(0, 6)])))
    want = brute.ngram_components(docs)
    assert len({c for _, _, c in want}) > 20
    got = ngram_join.ngram_components(doc_frame(spark, docs))
    assert rows(got, "doc_id", "n_shingles", "component_id") == want
