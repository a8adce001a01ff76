"""Plain Python versions of the operators."""

from __future__ import annotations

import hashlib
import re

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
NONSPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(text, pattern):
    return pattern.findall((text or "").translate(LOWER))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def top_k(vectors, is_query, k=10):
    """[(query_id, rank, vec_id, score)] of rows (vec_id, [float])."""
    import math
    v = [(i, [math.floor(1024 * x) for x in xs]) for i, xs in vectors
         if i is not None and xs is not None
         and all(x is not None and math.isfinite(x) for x in xs)]
    out = []
    for q in sorted({i for i, _ in v if is_query(i)}):
        s = sorted((-sum(a * b for a, b in zip(x, y)), j)
                   for i, x in v if i == q for j, y in v if j != q)[:k]
        out += [(q, r, i, -m) for r, (m, i) in enumerate(s, 1)]
    return out


def contamination(docs, items, n=10):
    """Rows (doc_id, n_words, n_hit, n_items, sha, flag) per document."""
    windows: dict[tuple, set] = {}
    for item, text in items:
        w = words(text, ALNUM)
        size = min(n, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + size]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text, ALNUM), set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                own = windows.get(tuple(w[i:i + size]))
                if own is not None:
                    hit |= set(range(i, i + size))
                    found |= own
        ids = sorted(str(x) for x in found if x is not None)
        out.append((doc, len(w), len(hit), len(ids), sha(",".join(ids)), bool(hit)))
    return out


def substring_dedup(docs, length=100):
    """{doc_id: (n_bytes, n_removed, n_spans, sha256)} of (doc_id, text)."""
    seen, out = set(), {}
    for doc_id, text in sorted(docs, key=lambda d: d[0]):
        raw = (text or "").encode()
        drop = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            if w in seen:
                drop[i:i + length] = b"\1" * length
            else:
                seen.add(w)
        kept = bytes(b for b, d in zip(raw, drop) if not d)
        spans = sum(d and not p for p, d in zip(b"\0" + drop, drop))
        out[doc_id] = (len(raw), sum(drop), spans,
                       hashlib.sha256(kept).hexdigest())
    return out


def ngram_components(docs, n=4, percent=85):
    """[(doc_id, n_shingles, component_id)] of [(doc_id, text)]."""
    sets = []
    for _, text in docs:
        w = words(text, NONSPACE)
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))}
                    if w else set())
    up = list(range(len(docs)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    least: dict[int, int] = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(sets[i]), least.get(root(i)) if sets[i] else doc)
            for i, (doc, _) in enumerate(docs)]


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_pii(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text)
                  if 8 <= len(digits(m)) <= 15]


PHRASES = {"mit license": "mit", "apache license": "apache",
           "general public license": "gpl"}


def base_licenses(text):
    """(n_words, n_base, first_word, last_word, base_labels)."""
    w = words(text, ALNUM)
    found = []
    for phrase, label in PHRASES.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    at = [i for i, _ in found]
    return (len(w), len(found), min(at, default=None), max(at, default=None),
            ",".join(sorted({x for _, x in found})))


def mix(docs):
    """{source: (source_size, target)} by sharing the excess step by step."""
    sizes: dict = {}
    for _, source, text in docs:
        sizes[source] = sizes.get(source, 0) + len(NONSPACE.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    free, rest, target = set(order), 1.5 * sum(sizes.values()), {}
    while free:
        share = rest / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 2 * sizes[s]]
        if not over:
            target |= {s: share * weight[s] for s in free}
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            rest -= target[s]
            free.discard(s)
    return {s: (sizes[s], target[s]) for s in order}


def url_rule(url):
    """host, path, rule, verdict (None without a rule)."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        path = re.match(r"[^?#]*", rest[len(host):]).group()
        host = host.translate(LOWER)
    rules = (("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
    fits = [(len(h + p), h + p, v) for v, h, p in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fits)[1:] if fits else (None, None)))
