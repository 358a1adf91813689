"""Ingest jobs: sources -> cascade/merge -> checks -> landed snapshot.

Each job is a lazy Spark plan; the eager steps are the source probes of the
cascade (``isEmpty``: stop at the first row), the write, and the check that
something was landed (Q15: a job with no output raises instead of landing
nothing).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from pricemart.config import Bounds
from pricemart.operators.merge import priority_merge, source_cascade, tag_source
from pricemart.operators.quality import record_is_valid
from pricemart.operators.resample import resample_monthly
from pricemart.sources import envelope as env


def land(records: DataFrame, path: str, run_date: str, fetched_at: str = "fetched_at") -> DataFrame:
    """Write ``records`` as the snapshot of ``run_date`` (native layout: Parquet, one row per
    record, partitioned by ``fetched_at``; a re-run of the same day replaces only that
    day) and return the landed snapshot read back.  Raises when this run landed nothing
    (Q15): the rows are counted on the write itself, so what an earlier run of the day left doesn't hide it."""
    spark = records.sparkSession
    obs = Observation("landed")
    counted = records.withColumn(fetched_at, F.lit(run_date)).observe(obs, F.count(F.lit(1)).alias("rows"))
    env.write_snapshot(counted, path, fetched_at)
    if not obs.get["rows"]:
        raise RuntimeError(f"{path}: 0 records; check that ingestion ran")
    return env.read_snapshots(spark, path).where(F.col(fetched_at) == F.lit(run_date).cast("date"))


def _cols(feed, *cols):
    if callable(feed):
        return lambda: feed().select(*cols)
    return feed.select(*cols)


def ingest_benchmark(api_records, csv_records, path: str, run_date: str,
                     bounds: Bounds = Bounds(0.0, 300.0)) -> tuple[DataFrame, DataFrame, dict]:
    """API records, else the backup CSV -> validation -> landed snapshot.

    Returns (landed records, quarantined records, counts).  The kept/removed counts
    come from an ``Observation`` placed before the split, so the landing write
    itself measures them (no extra pass).  Feeds may be callables (built only when
    the cascade reaches them)."""
    chosen = source_cascade([_cols(api_records, "period", "value", "source"),
                             _cols(csv_records, "period", "value", "source")])
    flag = F.coalesce(record_is_valid("period", "value", bounds), F.lit(False))
    obs = Observation("benchmark_validation")
    flagged = chosen.withColumn("_valid", flag).observe(
        obs, F.count_if(F.col("_valid")).alias("kept"), F.count_if(~F.col("_valid")).alias("removed"))
    landed = land(flagged.where("_valid").drop("_valid"), path, run_date)
    removed = chosen.where(~flag)
    return landed, removed, dict(obs.get)


def ingest_rates(daily_sources: Sequence, path: str, run_date: str) -> DataFrame:
    """First non-empty daily source (scrape A, scrape B, CSV) -> monthly means -> landed."""
    def daily_text(d):
        if callable(d):
            return lambda: daily_text(d())
        return d.select(F.date_format("date", "yyyy-MM-dd").alias("date"), "usd_lkr")
    daily = source_cascade([daily_text(d) for d in daily_sources])
    monthly = resample_monthly(daily, sort=False)
    return land(monthly, path, run_date)


def ingest_prices(scraped: DataFrame, historical: DataFrame, path: str, run_date: str) -> DataFrame:
    """Scrape and history are both loaded; per (period, fuel_type) the scrape wins, and
    within a source the first listed row wins (positions in ``_pos``)."""
    a = tag_source(scraped.select("period", "fuel_type", "price_lkr", "source", "_pos"), 0)
    b = tag_source(historical.select("period", "fuel_type", "price_lkr", "source", "_pos"), 1)
    merged = priority_merge([a, b], ["period", "fuel_type"])
    return land(merged.select("period", "fuel_type", "price_lkr", "source", "_pos"), path, run_date)
