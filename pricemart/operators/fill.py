"""Forward fill (last non-null value so far) without a single-partition window.

Three phases over ordered range buckets (see ``buckets.py``):
  1. per (series, bucket): the last non-null value of each column
     (``max_by(value, order)`` over non-null rows; a partial aggregate);
  2. the carry-in of a bucket = last non-null of those summaries over the
     earlier buckets of the same series (a window over the small summary);
  3. a local window per (series, bucket) fills inside the bucket and the
     carry-in fills what is still NULL at the bucket's start.
Buckets are ranges of (series, order), so the carry table has about #series +
#buckets rows; it is joined on (series, bucket), the same keys the local window
is clustered by.  AQE broadcasts it when its runtime size is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemart.operators.buckets import BUCKET, TIE_BREAK, ranged, with_tie_break


def _filled(x: DataFrame, cols: Sequence[str], order: Sequence[str], by: Sequence[str], names: Sequence[str],
            ahead: tuple[str, str] | None = None) -> DataFrame:
    """Fill over a ranged frame.  ``ahead``: (column, name): also add the column's value in the next row of the series, from
    the same ranges, summary and window."""
    order = [*order, TIE_BREAK]
    x = x.withColumn("_s", F.struct(*by)) if by else x
    skey = ["_s"] if by else []
    sums = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))).alias(f"_last_{i}") for i, c in enumerate(cols)]
    if ahead:
        sums.append(F.min_by(ahead[0], F.struct(*order)).alias("_first"))
    summary = x.groupBy(*skey, BUCKET).agg(*sums)
    ranges = Window.partitionBy(*skey).orderBy(BUCKET)
    before = ranges.rowsBetween(Window.unboundedPreceding, -1)
    carries = [F.last(f"_last_{i}", ignorenulls=True).over(before).alias(f"_carry_{i}") for i in range(len(cols))]
    if ahead:
        carries.append(F.lead("_first").over(ranges).alias("_then"))
    joined = x.join(summary.select(*skey, BUCKET, *carries), on=[*skey, BUCKET], how="left")
    inside = Window.partitionBy(*skey, BUCKET).orderBy(*order)
    local = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    more = []
    if ahead:       # a struct: a NULL value is not a missing row
        following = F.lead(F.struct(F.col(ahead[0]).alias("v"))).over(inside)
        joined = joined.withColumn("_next_row", following)
        more = [F.when(F.col("_next_row").isNull(), F.col("_then")).otherwise(F.col("_next_row.v")).alias(ahead[1])]
    return joined.select(*[
        F.coalesce(F.last(c, ignorenulls=True).over(local), F.col(f"_carry_{cols.index(c)}")).alias(c) if c in cols else F.col(c)
        for c in names], *more)


def forward_fill(df: DataFrame, cols: Sequence[str], order: Sequence[str], by: Sequence[str] = (),
                 frame: str = "rows", buckets: int | None = None) -> DataFrame:
    """Replace NULLs in ``cols`` by the last non-null value of the same series (``by``)
    in ``order``.  ``frame='rows'`` is ROWS UNBOUNDED PRECEDING..CURRENT ROW; ``'range'``
    is the default window frame, where rows with equal order values (peers) share
    the value: the last non-null one among them, in the order of a row hash.
    ``buckets``: number of ordered range buckets (default: by size); the result does not
    depend on it."""
    cols, order, by = list(cols), list(order), list(by)
    if frame == "rows":
        return _filled(ranged(df, [*by, *order], buckets), cols, order, by, df.columns)
    if frame != "range":
        raise ValueError("frame must be 'rows' or 'range'")
    # one row per peer group (a partial aggregate splits a large group), filled, then joined back
    keys = [*by, *order]
    tb = with_tie_break(df)
    last = tb.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col(TIE_BREAK))).alias(f"_f{i}") for i, c in enumerate(cols)])
    names = [f"_f{i}" for i in range(len(cols))]
    filled = _filled(ranged(last, keys, buckets), names, order, by, [*keys, *names])
    filled = filled.select(F.struct(*keys).alias("_k"), *names)
    return df.withColumn("_k", F.struct(*keys)).join(filled, "_k").select(
        *[F.col(f"_f{cols.index(c)}").alias(c) if c in cols else F.col(c) for c in df.columns])


def calendar_fill(df: DataFrame, period: str, cols: Sequence[str], by: Sequence[str] = (),
                  buckets: int | None = None) -> DataFrame:
    """Densify monthly ``period`` (a first-of-month DATE) between each series' first and
    last month, then forward fill ``cols``: a missing month gets the last known value,
    other columns are NULL in it.  Rows with a NULL period are left out; a NULL series is a series.

    Each row generates the missing months up to the next row of its series, so there is
    no join with a month grid and the input is read once; values and next months come from one range shuffle and
    one table of ranges."""
    cols, by = list(cols), list(by)
    x = ranged(df.where(F.col(period).isNotNull()), [*by, period], buckets)
    x = _filled(x, cols, [period], by, df.columns, ahead=(period, "_next"))
    month = F.expr("INTERVAL 1 MONTH")
    months = F.when(F.col("_next") > F.col(period), F.sequence(F.col(period), F.add_months("_next", -1), month)).otherwise(F.array(period))
    x = x.select("*", F.posexplode(months).alias("_gap", "_month"))
    own = [c for c in df.columns if c != period and c not in cols and c not in by]
    return x.select(*[F.col("_month").alias(c) if c == period else F.when(F.col("_gap") == 0, F.col(c)).alias(c) if c in own else F.col(c)
                      for c in df.columns])
