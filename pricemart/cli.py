"""Command-line jobs: the three ingest jobs and the ETL job.

    python -m pricemart.cli ingest-benchmark --payloads P --csv D1 [D2 ...] --out RAW/benchmark --run-date 2024-01-31
    python -m pricemart.cli ingest-rates --pages-first P1 --pages-all P2 --csv D1 [...] --out RAW/rates --run-date ...
    python -m pricemart.cli ingest-prices --pages P --csv D1 [...] --out RAW/prices --run-date ...
    python -m pricemart.cli etl --raw RAW --out MART [--layout snapshot|envelope] [--multiline]

Inputs are tables and folders: landed API payloads (a Parquet table with a
``payload`` text column), CSV folders (one per header layout), page tables
(``page_id, url, html``).  A job whose output is empty fails (non-zero exit).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from pricemart.plans import ingest
from pricemart.plans.etl import run_etl
from pricemart.session import apply_runtime_conf, ensure_checkpoint_dir, job_scratch
from pricemart.sources import api_payload, csv_alias, html_tables


def _spark() -> SparkSession:
    spark = SparkSession.builder.appName("pricemart").getOrCreate()
    apply_runtime_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="pricemart")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("ingest-benchmark")
    b.add_argument("--payloads")
    b.add_argument("--csv", nargs="*", default=[])
    r = sub.add_parser("ingest-rates")
    r.add_argument("--pages-first")
    r.add_argument("--pages-all")
    r.add_argument("--csv", nargs="*", default=[])
    p = sub.add_parser("ingest-prices")
    p.add_argument("--pages")
    p.add_argument("--csv", nargs="*", default=[])
    for s in (b, r, p):
        s.add_argument("--out", required=True)
        s.add_argument("--run-date", required=True)
        s.add_argument("--csv-single-line", action="store_true", help="no CSV value holds a line break: large files are split")
    e = sub.add_parser("etl")
    e.add_argument("--raw", required=True)
    e.add_argument("--out", required=True)
    e.add_argument("--layout", default="snapshot", choices=["snapshot", "envelope"])
    e.add_argument("--multiline", action="store_true")
    a = ap.parse_args(argv)
    spark = _spark()
    with job_scratch(spark):
        result = _run(spark, a)
    print(json.dumps(result))
    return 0


def _run(spark: SparkSession, a: argparse.Namespace) -> dict:
    if a.cmd == "ingest-benchmark":
        feeds = []
        if a.payloads:
            feeds.append(lambda: api_payload.payload_records(spark.read.parquet(a.payloads)))
        if a.csv:
            feeds.append(lambda: csv_alias.read_layouts(spark, a.csv, csv_alias.benchmark_from_csv, not a.csv_single_line))
        _landed, _removed, counts = ingest.ingest_benchmark(feeds[0], feeds[-1], a.out, a.run_date)
        result = {"landed": counts["kept"], "removed": counts["removed"]}
    elif a.cmd == "ingest-rates":
        feeds = []
        if a.pages_first:
            feeds.append(lambda: html_tables.two_column_rates(spark.read.parquet(a.pages_first), True))
        if a.pages_all:
            feeds.append(lambda: html_tables.two_column_rates(spark.read.parquet(a.pages_all), False))
        if a.csv:
            feeds.append(lambda: csv_alias.read_layouts(spark, a.csv, csv_alias.rates_from_csv, not a.csv_single_line))
        result = {"landed": ingest.ingest_rates(feeds, a.out, a.run_date).count()}
    elif a.cmd == "ingest-prices":
        empty = "period string, fuel_type string, price_lkr double, source string, _pos struct<file:string,a:long,b:long,c:long>"
        scraped = (html_tables.price_table(spark.read.parquet(a.pages)) if a.pages
                   else spark.createDataFrame([], empty))
        history = (csv_alias.read_layouts(spark, a.csv, csv_alias.prices_from_csv, not a.csv_single_line) if a.csv
                   else spark.createDataFrame([], empty))
        result = {"landed": ingest.ingest_prices(scraped, history, a.out, a.run_date).count()}
    else:
        out = run_etl(spark, a.raw, a.out, layout=a.layout, multiline=a.multiline)
        measured = ("counts", "read", "overflow")
        result = {"outputs": {k: v for k, v in vars(out).items() if k not in measured}, **{k: getattr(out, k) for k in measured}}
    return result


if __name__ == "__main__":
    sys.exit(main())
