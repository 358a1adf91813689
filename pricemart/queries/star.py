"""Driver queries over the analog star (transform, summary, dims, view, keys)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.functions.exact import safe_div
from pricemart.operators.change import calendar_previous, pct_change, previous_value
from pricemart.operators.dedupe import keep_first
from pricemart.operators.fill import calendar_fill, forward_fill
from pricemart.operators.keys import with_surrogate_key
from pricemart.operators.merge import priority_merge, tag_source
from pricemart.operators.quality import quality_counts, record_is_valid, split_valid
from pricemart.operators.resample import resample_monthly
from pricemart.plans import mart
from pricemart.plans.transform import assemble, cost_share, monthly_summary, normalise_currency, prepare, transform
from pricemart.queries.inputs import (
    ANALOG_CATEGORY_ROWS, ANALOG_SPEC, benchmark_feed, daily_rates, price_feed, table,
)
from pricemart.session import staged
from pricemart.sinks.warehouse import SUMMARY_SCHEMA, conform

ANALOG_DATE_START = "1995-01-01"
ANALOG_DATE_MONTHS = 84


def _rates(spark, sf):
    monthly = resample_monthly(daily_rates(spark, sf), sort=False)
    return monthly.select("period", F.col("usd_lkr_avg").alias("usd_lkr_rate"))


def _prepared(spark, sf):
    return prepare(benchmark_feed(spark, sf), _rates(spark, sf), price_feed(spark, sf), ANALOG_SPEC)


def _star(spark, sf):
    return transform(benchmark_feed(spark, sf), _rates(spark, sf), price_feed(spark, sf), ANALOG_SPEC)


def _loaded(spark, sf):
    """(benchmark, rates, fact) written once, so that queries over several of them read each feed once."""
    b, r, p, _ = _prepared(spark, sf)
    b, r, p = (staged(spark, x, n) for x, n in ((b, "benchmark"), (r, "rates"), (p, "prices")))
    return b, r, staged(spark, assemble(b, r, p, ANALOG_SPEC), "fact")


def _dims(spark):
    dates = mart.dim_date(spark, ANALOG_DATE_START, ANALOG_DATE_MONTHS, spec=ANALOG_SPEC)
    cats = mart.dim_category(spark, ANALOG_CATEGORY_ROWS)
    return dates, cats


def fact_prices(spark: SparkSession, sf: str) -> DataFrame:
    return _star(spark, sf).fact


def q_monthly_summary(spark, sf):
    return _star(spark, sf).summary


def dim_benchmark(spark, sf):
    return _star(spark, sf).dim_benchmark


def dim_rates(spark, sf):
    return _star(spark, sf).dim_rates


def q_normalise_currency(spark, sf):
    b, r, p, _ = _prepared(spark, sf)
    return normalise_currency(p, r).select("period", "fuel_type", "price_lkr", "usd_lkr_rate", "price_usd")


def cost_share_pct(spark, sf):
    b, r, p, _ = _prepared(spark, sf)
    j = cost_share(normalise_currency(p, r).join(b, on="period", how="left"))
    return j.select("period", "fuel_type", "price_usd", "brent_usd_per_barrel", "crude_cost_pct")


def inner_three_way(spark, sf):
    b, r, p, _ = _prepared(spark, sf)
    j = b.join(r, on="period").join(p, on="period")
    return j.withColumn("price_usd", safe_div("price_lkr", "usd_lkr_rate")).select(
        "period", "brent_usd_per_barrel", "usd_lkr_rate", "fuel_type", "price_lkr", "price_usd")


def dedupe_single_key(spark, sf):
    feed = benchmark_feed(spark, sf)
    return keep_first(feed, ["period"], [("fetched_at", False), ("_pos", True)]).select(
        "period", "brent_usd_per_barrel", "fetched_at")


def dedupe_composite_key(spark, sf):
    feed = price_feed(spark, sf)
    return keep_first(feed, ["period", "fuel_type"], [("fetched_at", False), ("_pos", True)]).select(
        "period", "fuel_type", "price_lkr", "source", "fetched_at")


def q_resample_monthly(spark, sf):
    return resample_monthly(daily_rates(spark, sf))


def lag_previous(spark, sf):
    fact = _star(spark, sf).fact
    out = previous_value(fact, "price_lkr", ["period"], by=["fuel_type"], name="prev_month_price_lkr")
    return out.select("period", "fuel_type", "price_lkr", "prev_month_price_lkr")


def mom_change_pct(spark, sf):
    out = lag_previous(spark, sf)
    return out.withColumn("mom_price_change_pct", pct_change("price_lkr", "prev_month_price_lkr"))


def calendar_mom(spark, sf):
    fact = _loaded(spark, sf)[2]
    out = calendar_previous(fact, "price_lkr", "period", by=["fuel_type"], name="prev_month_price_lkr")
    return out.select("period", "fuel_type", "price_lkr", "prev_month_price_lkr",
                      pct_change("price_lkr", "prev_month_price_lkr").alias("mom_price_change_pct"))


def view_price_vs_benchmark(spark, sf):
    dates, cats = _dims(spark)
    return mart.price_vs_benchmark_view(_star(spark, sf).fact, dates, cats)


def latest_top20(spark, sf):
    return mart.latest_top(view_price_vs_benchmark(spark, sf), 20)


def q_dim_date(spark, sf):
    """Date dimension spanning the months of the price feed (range read from ``orders``)."""
    o = table(spark, sf, "orders")
    span = o.agg(F.min(F.trunc(F.to_date("o_orderdate"), "month")).alias("lo"),
                 F.max(F.trunc(F.to_date("o_orderdate"), "month")).alias("hi"))
    dates = span.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("date_key"))
    return mart.dim_date_from(dates, ANALOG_SPEC.crisis_start, ANALOG_SPEC.crisis_end)


def surrogate_key(spark, sf):
    return with_surrogate_key(_star(spark, sf).fact, ["period", "fuel_type"], name="fact_id")


def conform_schema(spark, sf):
    ok, _bad = conform(_star(spark, sf).summary, SUMMARY_SCHEMA, key=["year", "month", "fuel_type"])
    return ok


def row_counts(spark, sf):
    b, r, fact = _loaded(spark, sf)
    return mart.row_counts([("dim_benchmark", b), ("dim_rates", r), ("fact_prices", fact),
                            ("monthly_summary", monthly_summary(fact))])


def unmatched_keys(spark, sf):
    cats = mart.dim_category(spark, ANALOG_CATEGORY_ROWS[:-1])
    return mart.unmatched_keys(_star(spark, sf).fact, cats)


def range_filter(spark, sf):
    from pricemart.operators.quality import range_filter as rf
    return rf(price_feed(spark, sf), "price_lkr", ANALOG_SPEC.price_bounds)


def _as_records(spark, sf):
    return price_feed(spark, sf).select("period", F.col("price_lkr").alias("value"), "_pos")


def validate_records(spark, sf):
    valid, _removed = split_valid(_as_records(spark, sf), record_is_valid("period", "value"))
    return valid


def q_quality_counts(spark, sf):
    return quality_counts(_as_records(spark, sf), record_is_valid("period", "value"))


def q_priority_merge(spark, sf):
    feed = price_feed(spark, sf)
    scraped = tag_source(feed.where(F.col("source") == "F").drop("source"), 0, "scrape", "_pos")
    history = tag_source(feed.where(F.col("source") != "F").drop("source"), 1, "history_csv", "_pos")
    merged = priority_merge([scraped, history], ["period", "fuel_type"])
    return merged.select("period", "fuel_type", "price_lkr", "source")


def _events_with_gaps(spark, sf):
    ev = table(spark, sf, "events")
    return ev.select("event_id", "user_id", "ts",
                     F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"))


def q_forward_fill(spark, sf):
    return forward_fill(_events_with_gaps(spark, sf), ["value"], ["ts", "event_id"], by=["user_id"])


def forward_fill_global(spark, sf):
    """One global series through the two-phase (bucketed) path, one bucket per shuffle partition."""
    from pricemart.session import default_parallelism
    return forward_fill(_events_with_gaps(spark, sf), ["value"], ["ts", "event_id"],
                        buckets=max(2, default_parallelism(spark)))


def forward_fill_range(spark, sf):
    return forward_fill(_events_with_gaps(spark, sf), ["value"], ["ts"], by=["user_id"], frame="range")


def q_calendar_fill(spark, sf):
    _b, _r, p, _ = _prepared(spark, sf)
    return calendar_fill(p, "period", ["price_lkr"], by=["fuel_type"])


QUERIES = {
    "fact_prices": fact_prices,
    "monthly_summary": q_monthly_summary,
    "dim_benchmark": dim_benchmark,
    "dim_rates": dim_rates,
    "normalise_currency": q_normalise_currency,
    "cost_share_pct": cost_share_pct,
    "inner_three_way": inner_three_way,
    "dedupe_single_key": dedupe_single_key,
    "dedupe_composite_key": dedupe_composite_key,
    "resample_monthly": q_resample_monthly,
    "lag_previous": lag_previous,
    "mom_change_pct": mom_change_pct,
    "calendar_mom": calendar_mom,
    "view_price_vs_benchmark": view_price_vs_benchmark,
    "latest_top20": latest_top20,
    "dim_date": q_dim_date,
    "surrogate_key": surrogate_key,
    "conform_schema": conform_schema,
    "row_counts": row_counts,
    "unmatched_keys": unmatched_keys,
    "range_filter": range_filter,
    "validate_records": validate_records,
    "quality_counts": q_quality_counts,
    "priority_merge": q_priority_merge,
    "forward_fill": q_forward_fill,
    "forward_fill_global": forward_fill_global,
    "forward_fill_range": forward_fill_range,
    "calendar_fill": q_calendar_fill,
}
