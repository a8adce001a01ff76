"""License scan: exact base phrases plus fuzzy short notices.

Base phrases are sequences of whole words (A-Z lower-cased, words are runs of
digits, letters and non-ASCII characters); every place counts.

Fuzzy search adds labels.  A notice of m characters that may hold e edits is
split into e + 1 seeds; by the pigeonhole principle every occurrence with at
most e edits holds one seed unchanged.  One Aho-Corasick pass finds the seeds,
each seed gives a window where its notice could lie, and the bounded-error
matching of the ``regex`` library verifies the window and reports span and
edits; the rest of the window, on both sides of its best match, is searched
again.  Windows of neighbouring seeds are searched one by one, so the time is
proportional to the text and its seeds, however often a notice repeats.
``score`` is 1 for a base phrase, else 1 - edits / length of the best fuzzy
match, else 0.

Null and empty texts have no words, no labels and score 0.  Very long texts
are searched whole, within one task.  One map over the rows, no shuffle;
repeated rows each get their own result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pricelake.llm import textkernel as tk

# Phrases whose consecutive words give a label.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"),
                ("general public license", "gpl"))
# Short notices searched with edits (lower case).
NOTICES = (
    ("permission is hereby granted, free of charge, to any person", "mit"),
    ("released under the mit license", "mit"),
    ("licensed under the apache license, version 2.0", "apache"),
    ("licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license, version 2.0", "mpl"),
    ("licensed under cc by-nc 4.0", "cc-by-nc"),
    ("licensed under cc by-sa 4.0", "cc-by-sa"),
    ("creative commons attribution 4.0 international", "cc-by"),
    ("released into the public domain", "public-domain"),
    ("spdx-license-identifier:", "spdx"),
    ("all rights reserved", "all-rights-reserved"),
)
CHARS_PER_EDIT = 10

_SEARCH = None


def _matches(pattern, low: str, lo: int, hi: int, least: int):
    """Matches in low[lo:hi], of at least ``least`` characters: the best one,
    then those on either side of it."""
    todo = [(lo, hi)]
    while todo:
        lo, hi = todo.pop()
        m = pattern.search(low, lo, hi) if hi - lo >= least else None
        if m is not None and m.end() > m.start():
            yield m
            todo += [(m.end(), hi), (lo, m.start())]


class NoticeSearch:
    """Compiled seeds and patterns of a list of (notice, label)."""

    def __init__(self, notices=NOTICES, chars_per_edit: int = CHARS_PER_EDIT):
        import ahocorasick
        import regex
        self.items = []
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, label) in enumerate(notices):
            edits = len(notice) // chars_per_edit
            self.items.append((notice, label, edits, regex.compile(
                f"(?b)(?:{regex.escape(notice)}){{e<={edits}}}")))
            cuts = [len(notice) * i // (edits + 1) for i in range(edits + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(notice[a:b], []).append((k, a))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def find(self, low: str) -> list[tuple[str, int, int, int]]:
        """(label, start, end, edits) of the notices in a lower-cased text, by
        start; of overlapping matches the one with the fewest edits (then the
        longest, the first) stays."""
        windows = set()
        for last, (size, uses) in self.automaton.iter(low):
            for k, shift in uses:
                notice, _, edits, _ = self.items[k]
                start = last + 1 - size - shift
                windows.add((k, max(0, start - edits),
                             min(len(low), start + len(notice) + edits)))
        found = set()
        for k, lo, hi in windows:
            notice, label, edits, pattern = self.items[k]
            for m in _matches(pattern, low, lo, hi, len(notice) - edits):
                found.add((label, m.start(), m.end(), sum(m.fuzzy_counts)))
        kept: list[tuple[str, int, int, int]] = []
        taken = bytearray(len(low)) if found else b""
        for x in sorted(found, key=lambda x: (x[3], x[1] - x[2], x[1], x[0])):
            if taken.find(1, x[1], x[2]) < 0:
                taken[x[1]:x[2]] = b"\1" * (x[2] - x[1])
                kept.append(x)
        return sorted(kept, key=lambda x: x[1:3])


def _search() -> NoticeSearch:
    global _SEARCH
    if _SEARCH is None:
        _SEARCH = NoticeSearch()
    return _SEARCH


def _phrase_places(data, off):
    """Per phrase: document index and word index of every place."""
    starts, ends, doc = tk.words(data, off, tk.ALNUM)
    h = tk.string_hashes(data, starts, ends)
    first = np.searchsorted(doc, np.arange(len(off) - 1))
    counts = np.bincount(doc, minlength=len(off) - 1)
    places = []
    for phrase, label in BASE_PHRASES:
        keys = [tk.hash_of(w) for w in phrase.split()]
        n = len(h) - len(keys) + 1
        if n <= 0:
            continue
        at = np.flatnonzero(h[:n] == keys[0])
        for j, key in enumerate(keys[1:], 1):
            at = at[(h[at + j] == key) & (doc[at + j] == doc[at])]
        places.append((label, doc[at], at - first[doc[at]]))
    return counts, places


def license_scan(docs: DataFrame, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per document: base places, labels, score and fuzzy spans
    (``label:start:end:edits``, code points of the text)."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, n_words long, n_base long, "
              "first_word long, last_word long, base_labels string, "
              "labels string, score double, spans string")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = _search()
        for batch in batches:
            data, off = tk.buffers(batch.column(1))
            n = len(off) - 1
            n_words = np.zeros(n, np.int64)
            base: dict[int, list[tuple[str, int]]] = {}
            for a, b in tk.doc_chunks(off):
                counts, places = _phrase_places(data[off[a]:off[b]],
                                                off[a:b + 1] - off[a])
                n_words[a:b] = counts
                for label, docs_at, words_at in places:
                    for d, w in zip(docs_at.tolist(), words_at.tolist()):
                        base.setdefault(a + d, []).append((label, w))
            rows = []
            for i in range(n):
                raw = data[off[i]:off[i + 1]].tobytes()
                spans = search.find(raw.lower().decode("utf-8", "replace"))
                own = base.get(i, [])
                base_labels = {x[0] for x in own}
                score = 1.0 if own else max(
                    (1 - x[3] / max(1, x[2] - x[1]) for x in spans), default=0.0)
                rows.append((
                    len(own), min((x[1] for x in own), default=None),
                    max((x[1] for x in own), default=None),
                    ",".join(sorted(base_labels)),
                    ",".join(sorted(base_labels | {x[0] for x in spans})),
                    max(0.0, score),
                    ",".join(f"{x[0]}:{x[1]}:{x[2]}:{x[3]}" for x in spans)))
            cols = list(zip(*rows)) if rows else [()] * 7
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.float64(),
                                                           pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words),
                 *(pa.array(list(c), t) for c, t in zip(cols, kinds))],
                names=[id_col, "n_words", "n_base", "first_word", "last_word",
                       "base_labels", "labels", "score", "spans"])

    return docs.select(id_col, text_col).mapInArrow(scan, schema)
