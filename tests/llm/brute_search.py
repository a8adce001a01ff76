"""Plain Python versions of vector search, lexical search and alignment."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def nearest(vectors, is_query, k=10):
    """{(row, vec_id): [(distance, vec_id)]} of [(vec_id, [float])] by row."""
    v = [(r, i, x) for r, (i, x) in enumerate(vectors)
         if x and all(c is not None and math.isfinite(c) for c in x) and any(x)]
    out = {}
    for r, i, x in v:
        if i is not None and is_query(i):
            d = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), j)
                       for s, j, y in v
                       if s != r and len(y) == len(x) and j is not None)
            out[r, i] = d[:k]
    return out


def ranked(docs, items, k=10):
    """[(item_id, rank, doc_id, score)] of [(id, text)] lists."""
    def terms(text):
        return TERM.findall((text or "").translate(LOWER))
    d = [(i, Counter(w), len(w)) for i, w in ((i, terms(t)) for i, t in docs) if w]
    n_docs, total = len(d), sum(n for _, _, n in d)
    df = Counter(t for _, c, _ in d for t in c)
    out = []
    for item, text in items:
        q = set(terms(text))
        scores = []
        for i, c, n in d:
            m = 10 + 90 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in q & c.keys())
            if s > 0:
                scores.append((-s, (i is None, i or 0), i))
        for r, (s, _, i) in enumerate(sorted(scores)[:k], 1):
            out.append((item, r, i, -s))
    return out


def aligned(docs, a_tok, b_tok, a_bytes, b_bytes):
    """The rows of the alignment of [(doc_id, text)], texts encoded whole."""
    found = []
    for doc, text in docs:
        blocks = []
        if text:
            a = a_tok.encode(" " + text, add_special_tokens=False).ids
            b = b_tok.encode(text)
            want = (" " + text).encode()
            if b"".join(a_bytes[i] for i in a) == want == \
                    b"".join(b_bytes[i] for i in b):
                i = j = x = y = 0
                ga, gb = [], []
                while i < len(a) or j < len(b):
                    if x <= y:
                        x += len(a_bytes[a[i]])
                        ga.append(a[i])
                        i += 1
                    else:
                        y += len(b_bytes[b[j]])
                        gb.append(b[j])
                        j += 1
                    if x == y:
                        blocks.append((ga, gb))
                        ga, gb = [], []
        found.append((doc, blocks))
    count = Counter()
    for _, blocks in found:
        count.update({(p, q) for ga, gb in blocks for p in ga for q in gb})
    best = defaultdict(int)
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    out = []
    for doc, blocks in found:
        links = [(p, q) for ga, gb in blocks for p in ga for q in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb))
                        for ga, gb in blocks)
        out.append((doc, sum(len(g) for g, _ in blocks),
                    sum(len(g) for _, g in blocks), len(blocks), len(links),
                    sum(count[x] == best[x[0]] for x in links),
                    sum(count[x] for x in links),
                    hashlib.sha256(text.encode()).hexdigest() if blocks else ""))
    return out
