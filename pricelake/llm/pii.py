"""Personal-data spans by anchor expansion.

An Aho-Corasick automaton finds the anchors of a text in one pass: at-signs,
digits, plus signs, ``://`` and identifier cue words.  At each anchor a
deterministic local parser expands to the boundaries of an address or number
and validates it:

* ``email``, ``ip``, ``card`` (16-19 digits, Luhn) and ``phone`` (8-15 digits)
  are the base kinds.  Per kind the spans are the leftmost non-overlapping
  ones; a span that fails its check is dropped and its text not tried again.
* ``iban`` (cue ``iban``, mod-97 check), ``account`` (an account, passport or
  social-security cue followed by an identifier with four or more digits) and
  ``login_url`` (``scheme://user:password@host``) are added by the method.

Positions are code points, end exclusive.  Null and empty texts have no span;
repeated rows each get their own result; columns are neither renamed nor lost.
The work is one map over the rows, with no shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

BASE_KINDS = ("email", "ip", "card", "phone")
# Cue words that introduce an identifier.
CUES = ("iban", "account no", "account number", "acct", "passport no",
        "passport number", "ssn", "social security number")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
                         "0123456789._%+-")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"[\s:#.]{0,4}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8})")
_ACCOUNT = re.compile(r"[\s:#.]{0,4}([A-Z0-9][A-Z0-9-]{4,24})")
_LOGIN = re.compile(r"://([^\s/@:]+):([^\s/@]+)@[A-Za-z0-9.-]+")

_AUTOMATON = None


def _automaton():
    global _AUTOMATON
    if _AUTOMATON is None:
        import ahocorasick
        a = ahocorasick.Automaton()
        for ch in "0123456789":
            a.add_word(ch, ("digit", 1))
        a.add_word("@", ("at", 1))
        a.add_word("+", ("plus", 1))
        a.add_word("://", ("scheme", 3))
        for cue in CUES:
            for form in {cue, cue.upper(), cue.title()}:
                a.add_word(form, ("iban" if cue == "iban" else "cue",
                                  len(form)))
        a.make_automaton()
        _AUTOMATON = a
    return _AUTOMATON


def luhn(digits: str) -> bool:
    total = 0
    for i, ch in enumerate(reversed(digits)):
        d = ord(ch) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in s)) % 97 == 1


def find_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of one text, ordered by kind (base kinds first), then start."""
    found: dict[str, list[tuple[int, int]]] = {}
    done = dict.fromkeys((*BASE_KINDS, "iban", "account", "login_url"), 0)

    def add(kind, start, end):
        found.setdefault(kind, []).append((start, end))

    for last, (anchor, size) in _automaton().iter(text):
        at = last - size + 1
        if anchor == "digit":
            if at >= done["ip"]:
                m = _IP.match(text, at)
                if m:
                    done["ip"] = m.end()
                    if all(len(p.lstrip("0")) <= 3 and int(p) <= 255
                           for p in m.group().split(".")):
                        add("ip", at, m.end())
                else:
                    # no later start inside this digit run can match either
                    run = at + 1
                    while run < len(text) and "0" <= text[run] <= "9":
                        run += 1
                    done["ip"] = run
            if at >= done["card"]:
                m = _CARD.match(text, at)
                done["card"] = m.end() if m else at + 1
                if m:
                    digits = re.sub("[^0-9]", "", m.group())
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        add("card", at, m.end())
        elif anchor == "at":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < at:
                m = _DOMAIN.match(text, at + 1)
                if m:
                    done["email"] = m.end()
                    add("email", start, m.end())
        elif anchor == "plus":
            if at >= done["phone"]:
                m = _PHONE.match(text, at)
                if m:
                    done["phone"] = m.end()
                    if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
                        add("phone", at, m.end())
        elif anchor == "iban":
            m = _IBAN.match(text, last + 1)
            if m and m.start(1) >= done["iban"]:
                compact = m.group(1).replace(" ", "")
                if 15 <= len(compact) <= 34 and mod97(compact):
                    done["iban"] = m.end()
                    add("iban", m.start(1), m.end())
        elif anchor == "cue":
            m = _ACCOUNT.match(text, last + 1)
            if m and m.start(1) >= done["account"] and \
                    sum(c.isdigit() for c in m.group(1)) >= 4:
                done["account"] = m.end()
                add("account", m.start(1), m.end())
        elif anchor == "scheme" and at >= done["login_url"]:
            m = _LOGIN.match(text, at)
            if m:
                start = at
                while start and text[start - 1].isalpha():
                    start -= 1
                done["login_url"] = m.end()
                add("login_url", start, m.end())
    order = [*BASE_KINDS, *sorted(k for k in found if k not in BASE_KINDS)]
    return [(k, s, e) for k in order for s, e in found.get(k, ())]


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def redact(text: str, spans) -> str:
    """The text with every span replaced by its kind in brackets.  Of
    overlapping spans the one that starts first (then the longest) names the
    whole covered stretch."""
    out, at = [], 0
    cover: list[list] = []
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
        if cover and s < cover[-1][2]:
            cover[-1][2] = max(cover[-1][2], e)
        else:
            cover.append([k, s, e])
    for k, s, e in cover:
        out += [text[at:s], f"[{k.upper()}]"]
        at = e
    return "".join([*out, text[at:]])


SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType())]))


def pii_spans(docs: DataFrame, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """One row per document: id, per-kind counts, digests and the spans."""
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = (f"`{id_col}` {id_type}, n_email long, n_ip long, n_card long, "
              "n_phone long, base_sha256 string, spans string, n_added long")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [[] for _ in range(7)]
            for text in batch.column(1):
                spans = find_spans(text.as_py() or "")
                base = [x for x in spans if x[0] in BASE_KINDS]
                for i, kind in enumerate(BASE_KINDS):
                    cols[i].append(sum(x[0] == kind for x in base))
                cols[4].append(hashlib.sha256(joined(base).encode()).hexdigest())
                cols[5].append(joined(spans))
                cols[6].append(len(spans) - len(base))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                names=[id_col, "n_email", "n_ip", "n_card", "n_phone",
                       "base_sha256", "spans", "n_added"])

    return docs.select(id_col, text_col).mapInArrow(scan, schema)


def redact_documents(docs: DataFrame, text_col: str = "text",
                     length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every found span replaced by ``[KIND]``.

    All columns are kept; ``length_col`` (if present) becomes the new length of
    changed texts.  Null texts stay null.
    """
    schema = docs.schema
    names = docs.columns
    at = names.index(text_col)
    size_at = names.index(length_col) if length_col in names else None

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)
            texts = cols[at].to_pylist()
            sizes = cols[size_at].to_pylist() if size_at is not None else None
            for i, text in enumerate(texts):
                spans = find_spans(text) if text else ()
                if spans:
                    texts[i] = redact(text, spans)
                    if sizes is not None:
                        sizes[i] = len(texts[i])
            cols[at] = pa.array(texts, cols[at].type)
            if sizes is not None:
                cols[size_at] = pa.array(sizes, cols[size_at].type)
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    return docs.mapInArrow(clean, schema)
