"""Ordered range buckets: the device that keeps ordered scans off a single task.

An ordered operator (forward fill, lag, numbering) over one long series would
put the whole series in one window partition.  Instead the rows are dealt into
contiguous ranges of their order by Spark's range shuffle and written once, with
the range number as a column, to the shared scratch folder.  Every later step
(summaries, local windows) reads that table, so all of them see the same ranges
and the input is not computed again.

The order is total: the order key, then a hash of the row.  It is the same for
any number of buckets, so buckets only change parallelism, never results, and
one order value that a third of all rows share is split like any other range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.session import default_parallelism, staged

TARGET_BYTES = 128 << 20
TIE_BREAK = "_tb"
BUCKET = "_b"


def estimated_bytes(df: DataFrame) -> int | None:
    """Size estimate of ``df`` from Catalyst statistics (no job runs); None when unavailable.

    Without CBO a join's estimate is the product of its inputs, so the estimate is
    capped by the total size of the plan's leaves (the bytes it reads)."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        top = int(str(plan.stats().sizeInBytes()))
        leaves = plan.collectLeaves()
        read = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
        size = min(top, read) if read > 0 else top
        return None if max(size, read) >= 1 << 60 else size        # a leaf of unknown size counts as 2^63 - 1
    except Exception:  # noqa: BLE001  (e.g. a Spark Connect session)
        return None


def bucket_count(df: DataFrame, target_bytes: int = TARGET_BYTES) -> int:
    """One bucket per ``target_bytes`` of estimated input, and at least the session's shuffle width."""
    est = estimated_bytes(df)
    return max(default_parallelism(df.sparkSession), -(-(est or 0) // target_bytes))


def with_tie_break(df: DataFrame, name: str = TIE_BREAK) -> DataFrame:
    """Add a deterministic per-row hash used as the last ordering key.

    Rows that tie on the order key have no defined order among themselves (as in
    SQL); breaking the tie by a hash of the row keeps results reproducible (rows that
    are equal in every column are interchangeable)."""
    atomic = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    return df.withColumn(name, F.xxhash64(*atomic))


def ranged(df: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``df`` with the tie-break and the number of its range of (``keys``, tie-break), written once."""
    n = bucket_count(df) if buckets is None else max(1, buckets)
    x = with_tie_break(df).repartitionByRange(n, *keys, TIE_BREAK).sortWithinPartitions(*keys, TIE_BREAK)
    x = x.withColumn(BUCKET, F.spark_partition_id())
    return staged(df.sparkSession, x, "ranges")
