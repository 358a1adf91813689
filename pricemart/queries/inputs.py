"""Stand-in inputs rendered from the test tables.

The reference's feeds are monthly price series; the test tables are TPC-H-like.
These builders only reshape rows into the schema a job expects - they do none
of the job's work:

  benchmark feed  lineitem: period = month of l_shipdate, value = l_extendedprice / 1000,
                  fetched_at = ship day, position = (orderkey, partkey, suppkey, linenumber)
  daily rates     lineitem: date = l_shipdate as text, rate = l_quantity
  price feed      orders: period = month of o_orderdate, category = o_orderpriority,
                  price = o_totalprice / 200, source = o_orderstatus,
                  fetched_at = order day, position = o_orderkey
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricemart.config import MartSpec

# Fixed values of the analog star: the five order priorities as categories.
ANALOG_CATEGORY_ROWS = (
    ("1-URGENT", "URGENT", "priority 1"),
    ("2-HIGH", "HIGH", "priority 2"),
    ("3-MEDIUM", "MEDIUM", "priority 3"),
    ("4-NOT SPECIFIED", "NOT SPECIFIED", "priority 4"),
    ("5-LOW", "LOW", "priority 5"),
)
ANALOG_SPEC = MartSpec(category_rows=ANALOG_CATEGORY_ROWS, crisis_start="1998-01-01", crisis_end="1998-12-31")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def benchmark_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.date_format("l_shipdate", "yyyy-MM").alias("period"),
        (F.col("l_extendedprice") / 1000).alias("brent_usd_per_barrel"),
        F.to_date("l_shipdate").alias("fetched_at"),
        F.struct("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("_pos"),
    )


def daily_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                     F.col("l_quantity").alias("usd_lkr"))


def price_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.date_format("o_orderdate", "yyyy-MM").alias("period"),
        F.col("o_orderpriority").alias("fuel_type"),
        (F.col("o_totalprice") / 200).alias("price_lkr"),
        F.col("o_orderstatus").alias("source"),
        F.to_date("o_orderdate").alias("fetched_at"),
        F.col("o_orderkey").alias("_pos"),
    )
