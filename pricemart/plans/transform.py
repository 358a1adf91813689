"""The seven-step transform: raw feeds -> fact, monthly summary and two dimensions.

Inputs (one row per landed record; extra columns allowed):
  benchmark: period STRING, brent_usd_per_barrel DOUBLE
  rates:     period STRING, usd_lkr_rate DOUBLE
  prices:    period STRING, fuel_type STRING, price_lkr DOUBLE
Each may carry ordering metadata used by the de-duplication (newest
``fetched_at`` first, then lower ``_priority``, then lower ``_pos``).

Scale notes: the only steps that touch raw volume are the three
de-duplications (partial aggregates, one shuffle each) and the scans.  After
them every frame has at most one row per key (period, or period x category),
so the joins are keyed on ``period`` and AQE turns them into broadcast joins
when the runtime size of the rates/benchmark side is small.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.config import DEFAULT_SPEC, Bounds, MartSpec
from pricemart.functions.exact import exact_mean, in_bounds, round_half_up, safe_div
from pricemart.functions.labels import standardise_label
from pricemart.functions.periods import period_to_date
from pricemart.operators.dedupe import keep_first
from pricemart.operators.fill import calendar_fill

FACT_COLUMNS = ["period", "fuel_type", "price_lkr", "price_usd", "usd_lkr_rate", "brent_usd_per_barrel",
                "crude_cost_pct"]


@dataclass
class TransformResult:
    fact: DataFrame
    summary: DataFrame
    dim_rates: DataFrame
    dim_benchmark: DataFrame
    quarantine: DataFrame


def _order_for(df: DataFrame) -> list[tuple[str, bool]]:
    order = []
    if "fetched_at" in df.columns:
        order.append(("fetched_at", False))
    if "_priority" in df.columns:
        order.append(("_priority", True))
    if "_pos" in df.columns:
        order.append(("_pos", True))
    return order


def _to_date_col(df: DataFrame, col: str) -> DataFrame:
    if col in df.columns and dict(df.dtypes)[col] == "string":
        df = df.withColumn(col, F.try_to_date(col, "yyyy-MM-dd"))
    return df


def dedupe_step(benchmark: DataFrame, rates: DataFrame, prices: DataFrame, spec: MartSpec = DEFAULT_SPEC):
    """Step 1: one row per period (benchmark, rates) and per (period, fuel_type) (prices)."""
    benchmark, rates, prices = (_to_date_col(d, "fetched_at") for d in (benchmark, rates, prices))
    if spec.standardise_first:
        prices = prices.withColumn("fuel_type", standardise_label("fuel_type"))
    # Only the needed columns enter the dedupe: fields inside the aggregated struct
    # cannot be pruned by Catalyst afterwards.
    def first(df, keys, value):
        order = _order_for(df)
        return keep_first(df.select(*keys, value, *[c for c, _ in order]), keys, order)
    return (first(benchmark, ["period"], "brent_usd_per_barrel"), first(rates, ["period"], "usd_lkr_rate"),
            first(prices, ["period", "fuel_type"], "price_lkr"))


def monthly_summary(fact: DataFrame) -> DataFrame:
    """Per (year, month, fuel_type): exact means rounded 2/2/4 and the row count.
    ``year``/``month`` are the formatted texts ``yyyy``/``MM`` (Q12)."""
    return fact.groupBy(
        F.date_format("period", "yyyy").alias("year"),
        F.date_format("period", "MM").alias("month"),
        "fuel_type",
    ).agg(
        round_half_up(exact_mean("price_lkr"), 2).alias("avg_price_lkr"),
        round_half_up(exact_mean("brent_usd_per_barrel"), 2).alias("avg_brent_usd"),
        round_half_up(exact_mean("usd_lkr_rate"), 4).alias("avg_usd_lkr"),
        F.count(F.lit(1)).alias("record_count"),
    )


def normalise_currency(prices: DataFrame, rates: DataFrame) -> DataFrame:
    """Left join prices x monthly rate on period; ``price_usd = round(price / rate, 4)``."""
    j = prices.join(rates, on="period", how="left")
    return j.withColumn("price_usd", round_half_up(safe_div("price_lkr", "usd_lkr_rate"), 4))


def cost_share(df: DataFrame, litres_per_barrel: float = 159.0) -> DataFrame:
    """``crude_cost_pct = round((benchmark / litres) / nullif(price_usd, 0) * 100, 2)``."""
    share = safe_div(F.col("brent_usd_per_barrel") / F.lit(litres_per_barrel), "price_usd") * 100
    return df.withColumn("crude_cost_pct", round_half_up(share, 2))


QUARANTINE_COLUMNS = ["feed", "period_text", "label", "fuel_type", "value", "fetched_at", "position", "reason"]


def _checked(df: DataFrame, feed: str, value: str, bounds: Bounds | None, label: str | None = None) -> DataFrame:
    """Steps 2 to 5 for one feed: every row with its parsed month, standard label and, when it can't be
    loaded, the reason (NULL: a good row).  The texts and the place it came from stay with it."""
    text = df.withColumn("period_text", F.col("period")).withColumn("period", period_to_date("period"))
    text = text.withColumn("label", F.col(label) if label else F.lit(None).cast("string"))
    if label:
        text = text.withColumn(label, standardise_label(label))
    missing = F.col("period_text").isNull() | F.col(value).isNull() | (F.col("label").isNull() if label else F.lit(False))
    reason = F.when(missing, "missing value")
    if bounds is not None:
        reason = reason.when(~F.coalesce(in_bounds(value, bounds), F.lit(False)), "out of range")
    out = text.withColumn("reason", reason.when(F.col("period").isNull(), "impossible month")).withColumn("feed", F.lit(feed))
    place = F.col("_pos").cast("string") if "_pos" in df.columns else F.lit(None).cast("string")
    when = F.col("fetched_at") if "fetched_at" in df.columns else F.lit(None).cast("date")
    fuel = F.col(label) if label else F.lit(None).cast("string")
    return out.select("feed", "period", "period_text", "label", fuel.alias("fuel_type"), F.col(value).cast("double").alias("value"),
                      when.cast("string").alias("fetched_at"), place.alias("position"), "reason")


def check_feeds(benchmark: DataFrame, rates: DataFrame, prices: DataFrame, spec: MartSpec = DEFAULT_SPEC) -> tuple:
    """Steps 1-5 without dropping a row: (benchmark, rates, prices), one row per key after the dedupe, good or
    with a reason.

    Rows without a value are not filled: a forward fill by row has nothing left to fill once they are out
    (Q3); ``calendar_fill`` fills the months that have no row."""
    b, r, p = dedupe_step(benchmark, rates, prices, spec)
    return (_checked(b, "benchmark", "brent_usd_per_barrel", spec.benchmark_bounds), _checked(r, "rates", "usd_lkr_rate", None),
            _checked(p, "prices", "price_lkr", spec.price_bounds, "fuel_type"))


def good_rows(checked: tuple, spec: MartSpec = DEFAULT_SPEC) -> tuple:
    """The good rows of ``check_feeds`` as (benchmark, rates, prices)."""
    b, r, p = (x.where("reason is null") for x in checked)
    r = r.select("period", F.col("value").alias("usd_lkr_rate"))
    if spec.calendar_fill:
        r = calendar_fill(r, "period", ["usd_lkr_rate"])
    return b.select("period", F.col("value").alias("brent_usd_per_barrel")), r, p.select("period", "fuel_type", F.col("value").alias("price_lkr"))


def quarantined(checked: tuple) -> DataFrame:
    """The rows of all feeds that can't be loaded, with their original texts, place and reason."""
    bad = [x.where("reason is not null").select(*QUARANTINE_COLUMNS) for x in checked]
    return bad[0].unionByName(bad[1]).unionByName(bad[2])


def prepare(benchmark: DataFrame, rates: DataFrame, prices: DataFrame, spec: MartSpec = DEFAULT_SPEC):
    """Steps 1-5: returns cleaned (benchmark, rates, prices) and the quarantine of all three feeds."""
    checked = check_feeds(benchmark, rates, prices, spec)
    return *good_rows(checked, spec), quarantined(checked)


def assemble(b: DataFrame, r: DataFrame, p: DataFrame, spec: MartSpec = DEFAULT_SPEC) -> DataFrame:
    """Steps 6-7: currency normalisation and the two left joins -> the fact columns."""
    fact = cost_share(normalise_currency(p, r).join(b, on="period", how="left"), spec.litres_per_barrel)
    return fact.select(*FACT_COLUMNS)


def transform(benchmark: DataFrame, rates: DataFrame, prices: DataFrame,
              spec: MartSpec = DEFAULT_SPEC) -> TransformResult:
    b, r, p, quarantine = prepare(benchmark, rates, prices, spec)
    fact = assemble(b, r, p, spec)
    return TransformResult(fact=fact, summary=monthly_summary(fact), dim_rates=r, dim_benchmark=b,
                           quarantine=quarantine)
