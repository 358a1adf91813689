"""Daily -> monthly resampling of a rate series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.functions.exact import exact_mean, round_half_up


def resample_monthly(daily: DataFrame, date_col: str = "date", value_col: str = "usd_lkr",
                     period_col: str = "period", mean_col: str = "usd_lkr_avg",
                     count_col: str = "sample_count", scale: int = 4, sort: bool = True) -> DataFrame:
    """Monthly mean and sample count of a daily series keyed by ``YYYY-MM``.

    Rows are skipped when the date text is shorter than 7 characters or the value
    is NULL, zero or NaN; the month is the first 7 characters of the date text;
    the mean is exact and rounded HALF_UP to ``scale``; output sorted by month.
    One partial + final aggregate (map-side combine), then a sort of the small result.
    """
    date_txt = F.col(date_col).cast("string")
    v = F.col(value_col)
    kept = daily.where((F.length(date_txt) >= 7) & v.isNotNull() & (v != 0) & ~F.isnan(v))
    monthly = kept.groupBy(F.substring(date_txt, 1, 7).alias(period_col)).agg(
        round_half_up(exact_mean(v), scale).alias(mean_col),
        F.count(v).alias(count_col))
    return monthly.orderBy(period_col) if sort else monthly
