"""String expression helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.isspace() accepts, which is what
# str.strip() removes (Spark's one-argument trim() removes spaces only).
PY_WHITESPACE = "\u0020\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Strip leading and trailing whitespace the way ``str.strip()`` does.

    ``trim(str, chars)`` treats ``chars`` as a set, so this is a plain scan
    from both ends (no regular expression).  It still costs several times a
    comparison, so a text that begins and ends with a visible ASCII character
    is passed as it is.
    """
    x = _c(x)
    ends = (x, F.substring(x, -1, 1))
    bare = [(c >= F.lit("!")) & (c < F.lit("\x7f")) for c in ends]
    return F.when(bare[0] & bare[1], x).otherwise(
        F.trim(x, F.lit(PY_WHITESPACE)))


def clean_ticker(x) -> Column:
    """Stripped, upper-cased ticker symbol."""
    return F.upper(py_strip(x))


def title_label(x) -> Column:
    """``'mutual_fund'`` -> ``'Mutual Fund'`` (replace underscores, title-case)."""
    return F.initcap(F.regexp_replace(_c(x), "_", " "))


def first_chars(x, n: int) -> Column:
    return F.substring(_c(x).cast("string"), 1, n)
