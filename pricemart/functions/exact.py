"""Exact arithmetic helpers.

``round`` of a floating mean depends on summation order (partial aggregates
arrive in any order), so means are summed as decimals and rounding goes
through a decimal cast (HALF_UP), which is reproducible on any engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricemart.config import Bounds


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """Round a double to ``scale`` places, HALF_UP, in one step (its decimal text is cut at ``scale``)."""
    return _c(c).try_cast(f"decimal(38,{scale})").cast("double")


def exact_mean(c) -> Column:
    """Mean of the finite values, in any order the same (NULL, NaN and infinities ignored, empty -> NULL).

    Values from 1e-10 to 1e20 are summed exactly in two decimals: one rounded to 8 places, and what that leaves (if it isn't
    the same double), to 27 places (a double's 17 digits end before).  Values beyond join as a sum of doubles, whose last digits may depend on the order."""
    x = _c(c).cast("double")
    size = F.abs(x)
    finite = size < float("inf")                                   # NaN is greater
    usual = (size >= 1e-10) & (size < 1e20)
    coarse = x.try_cast("decimal(28,8)")
    fine = F.when((size < 1e10) & (coarse.cast("double") != x), x.try_cast("decimal(37,27)") - x.try_cast("decimal(18,8)").cast("decimal(37,27)"))
    parts = [F.sum(F.when(usual, coarse)), F.sum(F.when(usual, fine)), F.sum(F.when(finite & ~usual, x))]
    total = sum((F.coalesce(p.cast("double"), F.lit(0.0)) for p in parts[1:]), F.coalesce(parts[0].cast("double"), F.lit(0.0)))
    return total / F.nullif(F.count(F.when(finite, x)), F.lit(0))


def safe_div(num, den) -> Column:
    """Division with a zero guard (ANSI mode raises on /0 even for doubles)."""
    return _c(num) / F.nullif(_c(den), F.lit(0))


def in_bounds(c, b: Bounds) -> Column:
    """Predicate ``lo <(=) c <(=) hi``; NaN and infinities are never in bounds (Q5)."""
    col = _c(c)
    lo = (col >= b.lo) if b.lo_inclusive else (col > b.lo)
    hi = (col <= b.hi) if b.hi_inclusive else (col < b.hi)
    return lo & hi & ~F.isnan(col)
