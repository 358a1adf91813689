"""Driver queries for the composite jobs: the three ingest jobs and the ETL job."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.operators.resample import resample_monthly
from pricemart.plans import ingest
from pricemart.plans.etl import balance, run_etl
from pricemart.queries.inputs import ANALOG_SPEC, table
from pricemart.queries import readers as R
from pricemart.queries.render import dfmt
from pricemart.session import scratch_path, staged
from pricemart.sinks import ledger, publish
from pricemart.sinks.warehouse import FACT_SCHEMA, conform, varchar, write_table
from pricemart.sources import csv_alias as csv
from pricemart.sources import html_tables as html

RUN_DATE = "2001-08-02"


def ingest_benchmark(spark, sf) -> DataFrame:
    """API payload records, else backup CSV -> validation -> landed snapshot (read back)."""
    api = R.api_payload_records(spark, sf)
    backup = lambda: R.csv_alias_benchmark(spark, sf)  # noqa: E731  (rendered only if the API feed is empty)
    landed, _removed, _counts = ingest.ingest_benchmark(api, backup, scratch_path(spark, "raw-benchmark"), RUN_DATE)
    return landed.select("period", "value", "source")


def ingest_rates(spark, sf) -> DataFrame:
    """Rates: first table of ``pages`` -> all tables of rendered rate pages -> CSV; monthly; landed."""
    pages = table(spark, sf, "pages")
    a = html.two_column_rates(pages, first_table_only=True)
    # rendered once for the probe and the read
    b = lambda: html.two_column_rates(staged(spark, R.rate_pages(spark, sf), "rate-pages"), first_table_only=False)
    c = lambda: csv.read_layouts(spark, R._rates_csv_paths(spark, sf), csv.rates_from_csv)
    landed = ingest.ingest_rates([a, b, c], scratch_path(spark, "raw-rates"), RUN_DATE)
    return landed.select("period", "usd_lkr_avg", "sample_count")


def _scraped_and_history(spark, sf):
    scraped = html.price_table(R.price_pages(spark, sf))
    history = csv.read_layouts(spark, R._prices_csv_paths(spark, sf), csv.prices_from_csv)
    return scraped, history


def ingest_prices(spark, sf) -> DataFrame:
    """Price scrape and history CSV merged (scrape first, first listed row wins), landed."""
    scraped, history = _scraped_and_history(spark, sf)
    landed = ingest.ingest_prices(scraped, history, scratch_path(spark, "raw-prices"), RUN_DATE)
    return landed.select("period", "fuel_type", "price_lkr", "source")


def etl_job(spark, sf) -> DataFrame:
    """End to end: land the three feeds, run extract -> transform -> load, return the loaded fact."""
    raw = scratch_path(spark, "raw")
    li = table(spark, sf, "lineitem")
    bench = resample_monthly(li.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                                       (F.col("l_extendedprice") / 1000).alias("usd_lkr")), sort=False)
    ingest.land(bench.select("period", F.col("usd_lkr_avg").alias("value"), F.lit("api").alias("source")),
                f"{raw}/benchmark", RUN_DATE)
    rates = resample_monthly(li.select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("date"),
                                       F.col("l_quantity").alias("usd_lkr")), sort=False)
    ingest.land(rates, f"{raw}/rates", RUN_DATE)
    scraped, history = _scraped_and_history(spark, sf)
    ingest.ingest_prices(scraped, history, f"{raw}/prices", RUN_DATE)
    mart = scratch_path(spark, "mart")
    run_etl(spark, raw, mart, ANALOG_SPEC)
    return publish.read(spark, mart, "fact", FACT_SCHEMA)


# Landed feeds with impossible months, missing and out-of-range values and repeated keys, as SQL for either engine.
def dirty_feeds(engine: str) -> dict[str, str]:
    month, year = (dfmt("{d}", n, engine) for n in ("ym", "y"))

    def period(col, key, every):
        return f"CASE WHEN {key} % {every} = 0 THEN concat({year.format(d=col)}, '-13') ELSE {month.format(d=col)} END"
    return {
        "benchmark": f"""SELECT {period("l_shipdate", "l_orderkey", 40)} AS period, l_orderkey * 8 + l_linenumber AS _pos,
            CASE WHEN l_orderkey % 37 = 0 THEN 5000 WHEN l_orderkey % 41 <> 0 THEN l_extendedprice / 1000 END AS value FROM lineitem""",
        "rates": f"""SELECT {period("o_orderdate", "o_orderkey", 50)} AS period, o_orderkey AS _pos,
            CASE WHEN o_orderkey % 43 <> 0 THEN o_totalprice / 1000 END AS usd_lkr_avg FROM orders""",
        "prices": f"""SELECT {period("o_orderdate", "o_orderkey", 45)} AS period, o_orderkey AS _pos,
            concat(' ', lower(o_orderpriority)) AS fuel_type, o_totalprice / 200 AS price_lkr FROM orders""",
    }


MART_SPEC = replace(ANALOG_SPEC, date_dim_start="1995-01-01", date_dim_months=84)


def _dirty_mart(spark, sf, mart: str | None = None):
    raw = scratch_path(spark, "raw")
    for name in ("lineitem", "orders"):
        table(spark, sf, name).createOrReplaceTempView(name)
    for feed, sql in dirty_feeds("spark").items():
        ingest.land(spark.sql(sql), f"{raw}/{feed}", RUN_DATE)
    return run_etl(spark, raw, mart or scratch_path(spark, "mart"), MART_SPEC)


def etl_balance(spark, sf) -> DataFrame:
    """Rows in, duplicates, quarantined, rejected and loaded of each feed of a load with dirty feeds."""
    return balance(spark, _dirty_mart(spark, sf))


def etl_quarantine(spark, sf) -> DataFrame:
    """The quarantine of all three feeds, read back from the load."""
    return spark.read.parquet(_dirty_mart(spark, sf).quarantine)


def etl_summary(spark, sf) -> DataFrame:
    """The monthly summary, read back from the load."""
    return spark.read.parquet(_dirty_mart(spark, sf).summary)


def etl_view(spark, sf) -> DataFrame:
    """The BI view that the load registers over its fact, date and category tables."""
    _dirty_mart(spark, sf)
    return spark.table("vw_price_vs_benchmark")


def append_load(spark, sf) -> DataFrame:
    """Orders loaded in two appends (SNK9), read back."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    path = scratch_path(spark, "append")
    write_table(o.where("o_orderstatus = 'F'"), path, mode="append", sort_within=["o_orderkey"])
    write_table(o.where("o_orderstatus <> 'F'"), path, mode="append", sort_within=["o_orderkey"])
    return spark.read.parquet(path)


def refresh_load(spark, sf) -> DataFrame:
    """Full refreshes of two tables, published together: what is read after a load of the finished orders, after one that
    broke between its two tables, and after one of all orders."""
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "refresh")

    def load(rows: DataFrame, breaks: bool) -> None:
        base, version = publish.current(spark, root), publish.new_version(root)
        write_table(rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")), f"{version}/statuses")
        if not breaks:
            write_table(rows.select("o_orderkey", "o_orderstatus"), f"{version}/orders")
            publish.publish(spark, root, {n: f"{version}/{n}" for n in ("statuses", "orders")}, base)

    def seen(step: str) -> DataFrame:
        release = publish.current(spark, root)
        counted = publish.read(spark, root, "statuses", release=release)
        rows = publish.read(spark, root, "orders", release=release).groupBy("o_orderstatus").agg(F.sum("o_orderkey").alias("keys"))
        return counted.join(rows, "o_orderstatus").withColumn("step", F.lit(step))

    load(o.where("o_orderstatus = 'F'"), False)
    load(o.where("o_orderstatus <> 'F'"), True)
    broken = seen("after a broken load")
    load(o, False)
    return broken.unionByName(seen("after a whole load"))


def append_once(spark, sf) -> DataFrame:
    """Three appends with load ids, the second one twice, ids going on from load to load (SNK9, SNK8)."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    root = scratch_path(spark, "ledger")
    for status in ("F", "O", "O", "P"):
        ledger.append_once(o.where(F.col("o_orderstatus") == status), root, f"orders-{status}", ["o_orderkey"])
    return ledger.read(spark, root, T.StructType([T.StructField("fact_id", T.LongType()), *o.schema.fields]))


def fact_month(spark, sf) -> DataFrame:
    """One month of the loaded fact (SNK6), with whether the month lies outside the span of periods of most of the table's
    files, which a scan with that filter skips."""
    mart = scratch_path(spark, "mart")
    out = _dirty_mart(spark, sf, mart)
    day = F.lit("1996-03-01").cast("date")
    month = publish.read(spark, mart, "fact", FACT_SCHEMA).where(F.col("period") == day)
    spans = (spark.read.parquet(out.fact).groupBy(F.input_file_name().alias("file"))
             .agg(F.min("period").alias("low"), F.max("period").alias("high")))
    skipped = F.count_if((F.col("low") > day) | (F.col("high") < day))
    most = spans.agg((2 * skipped > F.count(F.lit(1))).alias("most_files_skipped"))                 # one row
    return month.select("period", "fuel_type", "price_lkr").join(F.broadcast(most), F.lit(True))


def conform_rejects(spark, sf) -> DataFrame:
    """Rows that conform and rows rejected by NOT NULL, text length and primary key, counted by reason."""
    schema = T.StructType([T.StructField("k", T.LongType(), False), varchar("label", 12)])
    o = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 10 != 0, F.col("o_custkey")).alias("k"), F.col("o_orderpriority").alias("label"))
    ok, bad = conform(o, schema, key=["k"])
    return ok.withColumn("_reject", F.lit("loaded")).unionByName(bad).groupBy(F.col("_reject").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    "etl_balance": etl_balance,
    "etl_quarantine": etl_quarantine,
    "etl_summary": etl_summary,
    "etl_view": etl_view,
    "append_load": append_load,
    "append_once": append_once,
    "fact_month": fact_month,
    "refresh_load": refresh_load,
    "conform_rejects": conform_rejects,
    "ingest_benchmark": ingest_benchmark,
    "ingest_rates": ingest_rates,
    "ingest_prices": ingest_prices,
    "etl_job": etl_job,
}
