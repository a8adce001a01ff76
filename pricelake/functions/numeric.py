"""Numeric expression helpers.

Two rounding rules appear in the reference:

* SQL ``ROUND(x, n)`` evaluated by an embedded SQL engine, which scales the
  binary double and rounds half away from zero.  Spark's ``F.round`` instead
  rounds the decimal text of the double, so the two disagree on ties such as
  ``round(1.005, 2)``.  ``round_half_away`` reproduces the scaled-binary rule
  with built-in functions.
* pandas ``Series.round(n)``: scale, then round half to even.
  ``round_half_even`` reproduces it.

Both stay JVM-side (no UDF) and inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def round_half_away(x, n: int) -> Column:
    """Round the scaled binary value half away from zero (SQL ROUND)."""
    x = _c(x)
    p = float(10 ** n)
    return F.signum(x) * F.floor(F.abs(x) * F.lit(p) + F.lit(0.5)) / F.lit(p)


def round_half_even(x, n: int) -> Column:
    """Round the scaled binary value half to even (pandas ``round``)."""
    x = _c(x)
    p = float(10 ** n)
    y = x * F.lit(p)
    fl = F.floor(y).cast("double")
    frac = y - fl
    up = fl + F.lit(1.0)
    even_pick = F.when(F.pmod(fl, F.lit(2.0)) == 0, fl).otherwise(up)
    r = (F.when(frac > 0.5, up).when(frac < 0.5, fl).otherwise(even_pick))
    return r / F.lit(p)


def safe_div(num, den) -> Column:
    """Division that yields null for a zero or null denominator."""
    return F.try_divide(_c(num), F.nullif(_c(den), F.lit(0)))


def pct_change(new, old) -> Column:
    """(new - old) / old * 100, null when old is 0 or null (unguarded form)."""
    return safe_div(_c(new) - _c(old), _c(old)) * F.lit(100.0)


def pct_change_or_zero(new, old) -> Column:
    """(new - old) / old * 100, or 0 when old is 0 (guarded KPI form)."""
    old = _c(old)
    return F.when(old != 0, (_c(new) - old) / old * F.lit(100.0)).otherwise(
        F.lit(0.0))


def exact_sum(x, scale: int) -> Column:
    """Sum of values that carry ``scale`` decimals, without float drift.

    Summing doubles depends on the order rows arrive in, which differs
    between tasks and runs.  Values already rounded to ``scale`` decimals are
    summed exactly as decimals and converted back once.
    """
    return F.sum(_c(x).cast(f"decimal(28,{scale})")).cast("double")


def exact_sum_over(x, scale: int, window) -> Column:
    """``exact_sum`` as a window function."""
    return F.sum(_c(x).cast(f"decimal(28,{scale})")).over(window).cast("double")


def exact_avg(x, scale: int) -> Column:
    """Order-independent mean of values carrying ``scale`` decimals."""
    x = _c(x)
    return F.try_divide(exact_sum(x, scale), F.count(x).cast("double"))
