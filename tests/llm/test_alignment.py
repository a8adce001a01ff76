"""Token alignment against texts encoded whole and merged token by token."""

import random

import numpy as np
import pytest

from pricelake.llm import token_alignment as ta
from tests.llm import brute_search as brute
from tests.llm.conftest import doc_frame

COLS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
        "groups_sha256")
ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", "a▁b c", "tab\there\r\n  two",
       "  lead and  trail  ", " ", "\n", "naïve café — “x”　日本語 テスト 😀👩‍👩‍👧",
       "it's we'll 'tis 1234567890 !!!???", "x" * 5000, "\x1c \x1f a\x85 b",
       "a b   c", "é ﻿ ​ z", "for (;;) {\r\n\t}\r\n"]


@pytest.fixture(scope="module")
def tok():
    return ta.tokenizers(f"{ta.TOKENIZERS}/{ta.A_FILE}", f"{ta.TOKENIZERS}/{ta.B_FILE}")


def want(tok, docs):
    return brute.aligned(docs, tok.a, tok.b, tok.a_bytes, tok.b_bytes)


def got(spark, df):
    return sorted((tuple(r) for r in ta.token_alignment(df).select(*COLS).collect()),
                  key=str)


def test_merge_path_pieces():
    rng = random.Random(3)
    for n in (1, 2, 7, 60, 300):
        last = rng.randint(n, 4 * n)
        a, b = (np.array(sorted({*rng.sample(range(1, last + 1), min(n, last)), last}))
                for _ in range(2))
        both = sorted(set(a.tolist()) & set(b.tolist()))
        for piece in (1, 2, 3, 5, 16, 1000):
            i, j = ta.piece_borders(a, b, piece)
            assert set(np.diff(i + j)[:-1].tolist()) <= {piece}
            assert (np.diff(i) >= 0).all() and (np.diff(j) >= 0).all()
            gi, gj = ta.groups(a, b, piece)
            assert a[gi - 1].tolist() == b[gj - 1].tolist() == both


def test_links_of_big_groups(monkeypatch):
    a, b = np.array([1, 2, 1, 3, 1]), np.array([4, 4, 5])
    args = (np.array([6]), a, b, np.array([5]), np.array([3]), 10)
    whole = ta.links(*args)
    monkeypatch.setattr(ta, "BIG_GROUP", 2)
    for x, y in zip(whole, ta.links(*args)):
        assert x.tolist() == y.tolist()
    assert whole[1].sum() == 15


def test_digits():
    text, end = ta.Digits(12_000).write(np.array([0, 7, 10, 11_999]),
                                        np.frombuffer(b",|;.", np.uint8))
    assert text.tobytes() == b"0,7|10;11999." and end.tolist() == [2, 4, 7, 13]


def test_alignment(spark, texts, tok, arrow_rows):
    docs = texts + [(1000 + i, t) for i, t in enumerate(ODD)]
    docs += [(1000, ODD[2]), (None, "null id here"), (None, None)]
    assert got(spark, doc_frame(spark, docs)) == sorted(want(tok, docs), key=str)


def test_small_units(tok):
    """Segments, blocks and pieces of a few tokens give the same documents."""
    text = " ".join(ODD) * 3
    import pyarrow as pa
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()),
                        *[(c, pa.int64()) for c in COLS[1:5]],
                        ("groups_sha256", pa.string()), ("links", pa.binary()),
                        ("pairs", pa.list_(pa.int64())),
                        ("in_docs", pa.list_(pa.int32()))])
    out = []
    old = ta.SEGMENT, ta.CACHE, ta.TOGETHER
    for ta.SEGMENT, ta.CACHE, ta.TOGETHER in ((1 << 20, 1 << 17, 256), (8, 20, 3),
                                              (100, 2, 1)):
        block = ta.Block(tok)
        for d, t in enumerate([text.replace("▁", ""), None, "a▁b", "plain words"]):
            block.add(d, t)
        out.append([r for b in block.rows(0, schema) for r in b.to_pylist()])
    ta.SEGMENT, ta.CACHE, ta.TOGETHER = old
    assert out[0] == out[1] == out[2]
    assert out[0][2]["n_a"] == 0 and out[0][0]["n_groups"] > 100


def test_empty(spark):
    empty = doc_frame(spark, [(1, "a")]).limit(0)
    assert ta.token_alignment(empty).count() == 0
    df = doc_frame(spark, [(1, None), (2, "")])
    assert [r[1:] for r in got(spark, df)] == [(0, 0, 0, 0, 0, 0, "")] * 2
