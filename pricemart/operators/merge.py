"""Priority merges and source cascades."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.operators.dedupe import keep_first


def tag_source(df: DataFrame, priority: int, source: str | None = None, pos_col: str | None = None) -> DataFrame:
    """Add ``_priority`` (lower wins), optional constant ``source`` and a ``_pos`` column."""
    out = df.withColumn("_priority", F.lit(priority))
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    if pos_col is not None and pos_col != "_pos":
        out = out.withColumn("_pos", F.col(pos_col))
    elif pos_col is None and "_pos" not in out.columns:
        out = out.withColumn("_pos", F.lit(0).cast("long"))
    return out


def priority_merge(feeds: Sequence[DataFrame], keys: Sequence[str], extra_order: Sequence[tuple[str, bool]] = ()) -> DataFrame:
    """Concatenate tagged feeds (``unionByName``) and keep, per key, the row of the
    highest-priority feed, earliest position first (first-seen wins)."""
    u = feeds[0]
    for f in feeds[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return keep_first(u, keys, [("_priority", True), *extra_order, ("_pos", True)])


def source_cascade(feeds: Sequence, probe: bool = True) -> DataFrame:
    """First non-empty feed of an ordered list (A, then B, then C).

    ``probe=True``: the feeds are tried in order with ``isEmpty()`` (a job that
    stops at the first row) and later feeds are never built or read once one
    has rows - the common case, where the primary source works.  A feed may be
    given as a zero-argument callable so that its inputs are only produced when
    it is reached.  ``probe=False``: one lazy plan - the feeds are unioned with
    their rank and an equi-join on the smallest rank that has rows (a one-row
    aggregate, broadcast) keeps that feed; every feed is read."""
    if probe:
        chosen = None
        for f in feeds:
            chosen = f() if callable(f) else f
            if not chosen.isEmpty():
                return chosen
        return chosen
    tagged = [(f() if callable(f) else f).withColumn("_rank", F.lit(i)) for i, f in enumerate(feeds)]
    u = tagged[0]
    for t in tagged[1:]:
        u = u.unionByName(t, allowMissingColumns=True)
    first = u.agg(F.min("_rank").alias("_rank"))
    return u.join(F.broadcast(first), on="_rank", how="inner").drop("_rank")
