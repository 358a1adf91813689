"""Data-quality predicates: null drops, range filters, record validation, counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.config import Bounds
from pricemart.functions.exact import in_bounds


def drop_nulls(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(subset))


def range_filter(df: DataFrame, col: str, bounds: Bounds) -> DataFrame:
    return df.where(in_bounds(col, bounds))


def non_empty(*cols) -> Column:
    """All given text columns are non-NULL and non-empty."""
    cond = F.lit(True)
    for c in cols:
        cc = F.col(c) if isinstance(c, str) else c
        cond = cond & cc.isNotNull() & (F.length(cc) > 0)
    return cond


def period_shape_ok(period) -> Column:
    """``YYYY-MM`` shape only: length 7 and a dash at position 5 (digits unchecked)."""
    p = F.col(period) if isinstance(period, str) else period
    return (F.length(p) == 7) & (F.substring(p, 5, 1) == "-")


def record_is_valid(period: str = "period", value: str = "value",
                    bounds: Bounds = Bounds(0.0, 300.0)) -> Column:
    """Benchmark record check: period shape and a value strictly inside ``bounds``."""
    return F.coalesce(period_shape_ok(period) & F.col(value).isNotNull() & in_bounds(value, bounds), F.lit(False))


def split_valid(df: DataFrame, flag: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows) by one flag column, evaluated once per row."""
    x = df.withColumn("_valid", F.coalesce(flag, F.lit(False)))
    return x.where("_valid").drop("_valid"), x.where("NOT _valid").drop("_valid")


def quality_counts(df: DataFrame, flag: Column) -> DataFrame:
    """One row: how many records pass (``kept``) and fail (``removed``) the flag."""
    f = F.coalesce(flag, F.lit(False))
    return df.agg(F.count_if(f).alias("kept"), F.count_if(~f).alias("removed"))


def parse_then_filter(df: DataFrame, parsed: dict, keep: Sequence[str] | None = None,
                      require: Sequence[str] | None = None) -> DataFrame:
    """Add ``parsed`` columns (name -> Column), each computed once per row, and drop rows
    where a ``require``d one (default: all) is NULL.

    The parsed struct is computed in a projection (where codegen eliminates common
    subexpressions) and passed through a generator (``inline`` of a one-element
    array), so the NULL filter stays above it.  A filter on computed columns is
    otherwise pushed below the projection by alias substitution, and an expensive
    parse (regexes, date patterns) would run twice: in the filter and again in the
    projection."""
    keep = list(df.columns if keep is None else keep)
    require = list(parsed if require is None else require)
    st = F.struct(*[c.alias(n) for n, c in parsed.items()])
    g = df.select(*keep, st.alias("_parsed")).select(*keep, F.inline(F.array("_parsed")))
    cond = F.lit(True)
    for n in require:
        cond = cond & F.col(n).isNotNull()
    return g.where(cond)
