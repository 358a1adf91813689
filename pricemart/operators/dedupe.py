"""Deterministic de-duplication: one row per key, chosen by an explicit order.

``dropDuplicates`` keeps an arbitrary row (Q2).  Here the winner is the row with
the smallest ordering tuple, computed as ``min(struct(order..., payload...))``
per key.  That aggregate is combined map-side (partial aggregation), so a key
holding a third of all rows is reduced inside every map task before the
shuffle, and the shuffle carries at most one row per key per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OrderSpec = Sequence[tuple[str, bool]]   # (column, ascending)

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _sort_key(df: DataFrame, col: str, ascending: bool) -> Column:
    c = F.col(col)
    if ascending:
        return c
    dt = df.schema[col].dataType
    if isinstance(dt, _NUMERIC):
        return F.negative(c)
    if isinstance(dt, T.DateType):
        return F.negative(F.unix_date(c))
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.negative(F.unix_micros(c.cast("timestamp")))
    if isinstance(dt, T.BooleanType):
        return F.not_(c)
    raise ValueError(f"descending order on {dt.simpleString()} column {col!r} is not supported")


def keep_first(df: DataFrame, keys: Sequence[str], order: OrderSpec = ()) -> DataFrame:
    """One row per ``keys``: the first by ``order`` (NULLS LAST in both directions),
    remaining ties broken by the other columns, so the result is deterministic."""
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    sort_fields = []
    for i, (col, asc) in enumerate(order):
        sort_fields.append(F.col(col).isNull().alias(f"_n{i}"))
        sort_fields.append(_sort_key(df, col, asc).alias(f"_k{i}"))
    winner = F.min(F.struct(*sort_fields, *[F.col(c) for c in payload])).alias("_w")
    agg = df.groupBy(*keys).agg(winner)
    return agg.select(*[F.col(c) if c in keys else F.col("_w")[c].alias(c) for c in df.columns])


def drop_duplicates_like(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` made deterministic: ties broken by all other columns."""
    return keep_first(df, keys, ())
