"""Source-side period predicates: the last N days before an explicit ``as_of`` date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.config import LOOKBACK_DAYS


def lookback_filter(df: DataFrame, date_col: str, as_of: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows with ``as_of - days <= date <= as_of`` (both ends inclusive).  Written as a
    plain range predicate on the column, so it is pushed into the Parquet scan."""
    end = F.to_date(F.lit(as_of))
    start = F.date_sub(end, days)
    d = F.col(date_col)
    # Constant bounds (folded by Catalyst) on the bare column: pushed to the scan.
    return df.where((d >= start) & (d < F.date_add(end, 1)))


def month_window(df: DataFrame, period_col: str, as_of: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows whose ``YYYY-MM`` period lies between the month of ``as_of - days`` and the month of ``as_of``."""
    end = F.to_date(F.lit(as_of))
    lo = F.date_format(F.date_sub(end, days), "yyyy-MM")
    hi = F.date_format(end, "yyyy-MM")
    return df.where(F.col(period_col).between(lo, hi))
