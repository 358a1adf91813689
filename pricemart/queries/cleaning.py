"""Driver queries for the cleaning expressions, over dirty text rendered from the tables.

The renderers only format existing values (integer arithmetic, so both engines
produce identical strings) in the shapes the reference's feeds show; the
expressions under test do all of the parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricemart.functions import (
    clean_price, map_category, parse_period, parse_rate, parse_rate_date, period_to_date, standardise_label,
)
from pricemart.operators.quality import drop_nulls as _drop_nulls, parse_then_filter
from pricemart.queries.inputs import table

# Rendering expressions shared with the oracle SQL (plain SQL understood by both engines).
ORDER_CENTS = "CAST(ROUND(o_totalprice * 100) AS BIGINT)"
_W = f"CAST(floor({ORDER_CENTS} / 10000) AS BIGINT)"
_F = f"lpad(CAST(CAST(floor({ORDER_CENTS} / 100) AS BIGINT) % 100 AS STRING), 2, '0')"
_TH = f"CAST(CAST(floor({_W} / 1000) AS BIGINT) AS STRING)"
_LO = f"lpad(CAST({_W} % 1000 AS STRING), 3, '0')"
PRICE_TEXT = f"""CASE o_orderkey % 10
  WHEN 0 THEN concat(CAST({_W} AS STRING), '.', {_F})
  WHEN 1 THEN concat(CAST({_W} AS STRING), ',', {_F})
  WHEN 2 THEN concat('Rs. ', CAST({_W} AS STRING), '.', {_F})
  WHEN 3 THEN concat('Rs ', CAST({_W} AS STRING))
  WHEN 4 THEN concat({_TH}, ',', {_LO}, '.', {_F})
  WHEN 5 THEN '-'
  WHEN 6 THEN 'N/A'
  WHEN 7 THEN concat('  ', CAST({_W} AS STRING), '.', {_F}, '.00 ')
  WHEN 8 THEN concat({_TH}, ',', {_LO})
  ELSE concat('-', CAST({_W} AS STRING)) END"""

_RC = "(CAST(l_quantity AS BIGINT) * 2100 + l_partkey % 100)"
_RW = f"CAST(floor({_RC} / 100) AS BIGINT)"
_RF = f"lpad(CAST({_RC} % 100 AS STRING), 2, '0')"
RATE_TEXT = f"""CASE (l_orderkey * 8 + l_linenumber) % 5
  WHEN 0 THEN concat(CAST({_RW} AS STRING), '.', {_RF})
  WHEN 1 THEN concat(CAST(CAST(floor({_RW} / 1000) AS BIGINT) AS STRING), ',', lpad(CAST({_RW} % 1000 AS STRING), 3, '0'), '.', {_RF})
  WHEN 2 THEN CAST({_RW} AS STRING)
  WHEN 3 THEN 'n/a'
  ELSE concat(' ', CAST({_RW} AS STRING), '.', {_RF}, ' ') END"""

HEADER_TEXT = """CASE p_partkey % 10
  WHEN 0 THEN concat(p_type, ' lad')
  WHEN 1 THEN concat('Fur. ', CAST(p_size * 100 AS STRING))
  WHEN 2 THEN p_name
  WHEN 3 THEN concat(' ', p_brand, ' ')
  WHEN 4 THEN concat('Effective Date ', CAST(p_size AS STRING))
  WHEN 5 THEN concat('LP ', CAST(90 + p_size % 6 AS STRING))
  WHEN 6 THEN lower(p_type)
  WHEN 7 THEN ''
  WHEN 8 THEN concat(p_type, ' LSD')
  ELSE upper(p_name) END"""

LABEL_TEXT = """CASE o_orderkey % 4
  WHEN 0 THEN o_orderpriority
  WHEN 1 THEN lower(o_orderpriority)
  WHEN 2 THEN concat('  ', o_orderpriority, ' ')
  ELSE concat(lower(o_orderpriority), '  ') END"""


def _period_text(d: str) -> F.Column:
    """Order date rendered in one of twelve shapes (Spark spelling of the patterns)."""
    fmt = lambda p: F.date_format(d, p)
    k = F.col("o_orderkey") % 12
    shapes = [fmt("dd.MM.yyyy"), fmt("dd/MM/yyyy"), fmt("dd-MM-yyyy"), fmt("yyyy-MM-dd"),
              F.lower(fmt("MMM-yyyy")), fmt("MMM yyyy"), fmt("MMMM yyyy"), fmt("MM/yyyy"),
              F.concat(F.lit("Updated "), fmt("dd.MM.yyyy")), fmt("yyyy.MM"), fmt("d.M.yyyy"), fmt("MM/dd/yyyy")]
    expr = F.when(k == 0, shapes[0])
    for i, s in enumerate(shapes[1:], start=1):
        expr = expr.when(k == i, s)
    return expr


def _rate_date_text() -> F.Column:
    fmt = lambda p: F.date_format("l_shipdate", p)
    k = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 6
    shapes = [fmt("yyyy-MM-dd"), fmt("dd/MM/yyyy"), fmt("dd-MM-yyyy"), fmt("dd.MM.yyyy"), fmt("MM/dd/yyyy"),
              fmt("yyyy/MM/dd")]
    expr = F.when(k == 0, shapes[0])
    for i, s in enumerate(shapes[1:], start=1):
        expr = expr.when(k == i, s)
    return expr


def q_clean_price(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(PRICE_TEXT).alias("price_text"))
    return o.withColumn("price_lkr", clean_price("price_text"))


def q_parse_period(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", _period_text("o_orderdate").alias("date_text"))
    return o.withColumn("period", parse_period("date_text"))


def parse_daily_rate(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        _rate_date_text().alias("raw_date"), F.expr(RATE_TEXT).alias("raw_rate"))
    return parse_then_filter(li, {"date": parse_rate_date("raw_date"), "usd_lkr": parse_rate("raw_rate")})


def q_map_category(spark, sf) -> DataFrame:
    p = table(spark, sf, "part").select("p_partkey", F.expr(HEADER_TEXT).alias("header"))
    return p.withColumn("category", map_category("header"))


def q_standardise_label(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(LABEL_TEXT).alias("label"))
    return o.withColumn("fuel_type", standardise_label("label"))


PERIOD_TEXT = """CASE o_orderkey % 3
  WHEN 0 THEN concat(CAST(year(o_orderdate) AS STRING), '-', lpad(CAST(month(o_orderdate) AS STRING), 2, '0'))
  WHEN 1 THEN concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) + 12 AS STRING))
  ELSE concat(CAST(year(o_orderdate) AS STRING), '-', CAST(month(o_orderdate) AS STRING)) END"""


def q_period_to_date(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.expr(PERIOD_TEXT).alias("period_text"))
    return o.withColumn("period", period_to_date("period_text"))


def q_drop_nulls(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.col("o_orderpriority").alias("fuel_type"), F.expr(PRICE_TEXT).alias("price_text"))
    parsed = o.withColumn("price_lkr", clean_price("price_text")).drop("price_text")
    return _drop_nulls(parsed, ["period", "fuel_type", "price_lkr"])


QUERIES = {
    "clean_price": q_clean_price,
    "parse_period": q_parse_period,
    "parse_daily_rate": parse_daily_rate,
    "map_category": q_map_category,
    "standardise_label": q_standardise_label,
    "period_to_date": q_period_to_date,
    "drop_nulls": q_drop_nulls,
}


def quarantine_periods(spark, sf) -> DataFrame:
    """Price records whose period text is not a real ``yyyy-MM`` month (e.g. ``1997-15``), as
    quarantined by the transform's steps 1-5 (dedupe, null drop, date conversion, labels,
    ranges) instead of flowing into the fact with a NULL period (Q4)."""
    from pricemart.plans.transform import prepare
    from pricemart.queries.inputs import ANALOG_SPEC
    o = table(spark, sf, "orders")
    prices = o.select(F.expr(PERIOD_TEXT).alias("period"), F.col("o_orderpriority").alias("fuel_type"),
                      (F.col("o_totalprice") / 200).alias("price_lkr"), F.to_date("o_orderdate").alias("fetched_at"),
                      F.col("o_orderkey").alias("_pos"))
    from pricemart.queries.inputs import benchmark_feed
    from pricemart.queries.star import _rates
    _b, _r, _p, quarantine = prepare(benchmark_feed(spark, sf), _rates(spark, sf), prices, ANALOG_SPEC)
    return quarantine.where("feed = 'prices' and reason = 'impossible month'").select("fuel_type", F.col("value").alias("price_lkr"))


QUERIES["quarantine_periods"] = quarantine_periods
