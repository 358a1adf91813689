"""Previous value per series and period-over-period change.

``previous_value`` is ``LAG(col) OVER (PARTITION BY by ORDER BY order)`` computed
over ordered range buckets: inside a bucket a local ``lag``; the first row of a
bucket takes the value of the last row of the previous non-empty bucket of the
same series (a small per-bucket summary).  A category holding a third of all
rows is thereby spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricemart.functions.exact import round_half_up, safe_div
from pricemart.operators.buckets import BUCKET, TIE_BREAK, ranged


def _neighbour(df: DataFrame, col: str, order: Sequence[str], by: Sequence[str], name: str, buckets: int | None,
               step: int) -> DataFrame:
    order, by = list(order), list(by)
    x = ranged(df, [*by, *order], buckets)
    order = [*order, TIE_BREAK]
    if by:
        x = x.withColumn("_s", F.struct(*by))
    skey = ["_s"] if by else []
    edge = (F.max_by if step < 0 else F.min_by)(col, F.struct(*order))
    summary = x.groupBy(*skey, BUCKET).agg(edge.alias("_edge"))
    carry = summary.select(*skey, BUCKET, F.lag("_edge", -step).over(Window.partitionBy(*skey).orderBy(BUCKET)).alias("_carry"))
    joined = x.join(carry, on=[*skey, BUCKET], how="left")
    local = Window.partitionBy(*skey, BUCKET).orderBy(*order)
    inside = F.lag(F.struct(F.col(col).alias("v")), -step).over(local)      # a struct: a NULL value is not a missing row
    return joined.withColumn("_in", inside).select(
        *df.columns, F.when(F.col("_in").isNull(), F.col("_carry")).otherwise(F.col("_in.v")).alias(name))


def previous_value(df: DataFrame, col: str, order: Sequence[str], by: Sequence[str] = (),
                   name: str | None = None, buckets: int | None = None) -> DataFrame:
    """Add ``name`` (default ``prev_<col>``) = value of ``col`` in the previous row of the series; rows that
    tie on ``order`` follow a row hash.  ``buckets``: number of ordered range buckets (default: by size);
    the result does not depend on it."""
    return _neighbour(df, col, order, by, name or f"prev_{col}", buckets, -1)


def next_value(df: DataFrame, col: str, order: Sequence[str], by: Sequence[str] = (),
               name: str | None = None, buckets: int | None = None) -> DataFrame:
    """Like ``previous_value`` for the next row of the series."""
    return _neighbour(df, col, order, by, name or f"next_{col}", buckets, 1)


def pct_change(cur, prev, scale: int = 2) -> Column:
    """``ROUND((cur - prev) / NULLIF(prev, 0) * 100, scale)`` (HALF_UP)."""
    c = F.col(cur) if isinstance(cur, str) else cur
    p = F.col(prev) if isinstance(prev, str) else prev
    return round_half_up(safe_div(c - p, p) * 100, scale)


def calendar_previous(df: DataFrame, col: str, period: str, by: Sequence[str] = (),
                      name: str | None = None) -> DataFrame:
    """Value of the previous *calendar* month (``add_months(period, -1)``) of the same series,
    NULL when that month has no row (Q7 variant).  A month with several rows gives its smallest value, so
    rows are never multiplied; a NULL series is a series.  One equi-join, no window."""
    by = list(by)
    name = name or f"prev_{col}"
    prev = df.groupBy(F.struct(*by, F.add_months(F.col(period), 1).alias(period)).alias("_k")).agg(F.min(col).alias("_prev"))
    return (df.withColumn("_k", F.struct(*by, F.col(period))).join(prev, on="_k", how="left")
              .select(*df.columns, F.col("_prev").alias(name)))
