"""Surrogate keys: unique ascending ids in a global order, without one-partition windows.

Rows are cut into ordered range buckets; a partial aggregate counts rows per bucket
and a running sum over those (one row per bucket) gives each bucket's offset; inside each bucket
``row_number`` adds the local position.  The ids equal ``ROW_NUMBER() OVER (ORDER BY
order, row hash)`` shifted by ``start - 1``, whatever the number of buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pricemart.operators.buckets import BUCKET, TIE_BREAK, ranged


def with_surrogate_key(df: DataFrame, order: Sequence[str], name: str = "fact_id", start: int = 1,
                       buckets: int | None = None, range_name: str | None = None) -> DataFrame:
    """``df`` with its id first; ``range_name``: also the number of the row's range as the last column (ids rise from range
    to range), so that later ordered work over the same order needs no ranges of its own."""
    order = list(order)
    x = ranged(df, order, buckets)
    counts = x.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        BUCKET, F.coalesce(F.sum("_n").over(Window.orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)),
                           F.lit(0)).alias("_off"))
    rn = F.row_number().over(Window.partitionBy(BUCKET).orderBy(*order, TIE_BREAK))
    key = (F.lit(start - 1) + F.col("_off") + rn).cast("long")
    more = [F.col(BUCKET).alias(range_name)] if range_name else []
    return x.join(offsets, on=BUCKET, how="inner").select(key.alias(name), *df.columns, *more)
