"""CSV feeds whose headers vary: columns are found by alias, first non-empty wins.

Each file group with one header layout is read with ``header=true`` and all
columns as text (a folder whose files have different headers fails instead of mixing
columns); quotes are doubled inside quoted values, which may hold line breaks; a UTF-8 byte-order
mark on the first header is removed; an
alias list resolves to ``coalesce(nullif(col, ''), ...)`` over the aliases that
exist in that layout (truthiness of ``a or b or c``), and is stripped after.
A row missing a value is skipped (not the whole file, Q18).  Every row keeps its place: file, block of
the file and order within the block, so "first listed wins" needs no column of the file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.config import (
    BENCHMARK_CSV_PERIOD_ALIASES, BENCHMARK_CSV_VALUE_ALIASES, PRICE_CSV_DATE_ALIASES, PRICE_CSV_FUEL_ALIASES,
    PRICE_CSV_PRICE_ALIASES, RATE_CSV_CURRENCY_ALIASES, RATE_CSV_DATE_ALIASES, RATE_CSV_RATE_ALIASES, Bounds,
)
from pricemart.functions.numbers import clean_price, parse_float, parse_rate
from pricemart.functions.periods import parse_period, parse_rate_date, slash_date_to_month
from pricemart.functions.text import normalise_label, py_strip
from pricemart.operators.quality import non_empty, parse_then_filter

BOM = "﻿"


POSITION = "_pos"


def read_csv_text(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All-text CSV read with a header row; BOM removed from the first column name; ``_pos`` = (file, block
    start, row).  ``multiline=False`` lets Spark split large files, for feeds whose values hold no line
    breaks."""
    df = (spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False).option("quote", '"')
          .option("escape", '"').option("multiLine", multiline).option("mode", "PERMISSIVE").csv(path))
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("a"),
                     F.monotonically_increasing_id().alias("b"), F.lit(0).cast("long").alias("c"))
    return df.select(*[F.col(f"`{c}`").alias(c.lstrip(BOM)) for c in df.columns], place.alias(POSITION))


def alias(df: DataFrame, names: Sequence[str], default: str | None = "") -> Column:
    """First non-empty value among the alias columns present in ``df``, then stripped."""
    present = [F.nullif(F.col(f"`{n}`"), F.lit("")) for n in names if n in df.columns]
    if default is not None:
        present.append(F.lit(default))
    if not present:
        return F.lit(None).cast("string")
    return py_strip(F.coalesce(*present))


def benchmark_from_csv(df: DataFrame, source: str = "backup_csv") -> DataFrame:
    """Benchmark CSV -> (period, value, source): ``M/D/YYYY`` -> ``YYYY-MM``, first 7
    characters kept, thousands commas removed; bad rows skipped."""
    period = alias(df, BENCHMARK_CSV_PERIOD_ALIASES)
    value = alias(df, BENCHMARK_CSV_VALUE_ALIASES)
    x = df.select(period.alias("_p"), value.alias("_v"))
    x = x.where(non_empty("_p", "_v"))
    out = parse_then_filter(x, {"period": slash_date_to_month("_p"),
                                "value": parse_float(F.replace(F.col("_v"), F.lit(","), F.lit("")))}, keep=[])
    return out.select("period", "value", F.lit(source).alias("source"))


def rates_from_csv(df: DataFrame, bounds: Bounds = Bounds(0.0, 1000.0, hi_inclusive=True)) -> DataFrame:
    """Rate CSV (three layouts) -> daily (date DATE, usd_lkr DOUBLE).

    A currency column, when present, keeps blank or ``USD`` rows only; the rate
    column prefers Mid > Exchange > Selling > generic names."""
    cur = F.upper(alias(df, RATE_CSV_CURRENCY_ALIASES, default="USD"))
    date = alias(df, RATE_CSV_DATE_ALIASES)
    rate = alias(df, RATE_CSV_RATE_ALIASES)
    x = df.select(cur.alias("_c"), date.alias("_d"), rate.alias("_r"))
    x = x.where(((F.col("_c") == "") | (F.col("_c") == "USD")) & non_empty("_d", "_r"))
    return parse_then_filter(x, {"date": parse_rate_date("_d"), "usd_lkr": parse_rate("_r", bounds)}, keep=[])


def prices_from_csv(df: DataFrame, source: str = "history_csv") -> DataFrame:
    """Retail-price CSV -> (period, fuel_type, price_lkr, source, _pos): period parsed from
    mixed date text, price cleaned, label in upper snake case.  ``_pos`` is the row's place
    in the files (first listed row wins later)."""
    date = alias(df, PRICE_CSV_DATE_ALIASES)
    fuel = alias(df, PRICE_CSV_FUEL_ALIASES)
    price = alias(df, PRICE_CSV_PRICE_ALIASES)
    x = df.select(date.alias("_d"), fuel.alias("_f"), price.alias("_p"), POSITION)
    x = x.where(non_empty("_d", "_f", "_p"))
    out = parse_then_filter(x, {"period": parse_period("_d"), "fuel_type": normalise_label("_f"),
                                "price_lkr": clean_price("_p")}, keep=[POSITION], require=["period", "price_lkr"])
    return out.select("period", "fuel_type", "price_lkr", F.lit(source).alias("source"), POSITION)


def read_layouts(spark: SparkSession, paths: Sequence[str], parse, multiline: bool = True) -> DataFrame:
    """Read each header layout separately, resolve aliases per layout, union the results.  ``multiline=False`` as in
    ``read_csv_text``."""
    parts = [parse(read_csv_text(spark, p, multiline)) for p in paths]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
