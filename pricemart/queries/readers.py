"""Driver queries for the readers and sinks (envelopes, snapshots, payloads, CSV, HTML).

Stand-in files are rendered from the test tables with Spark into a fresh folder
below the session's checkpoint folder, then read back through the library's
readers, which do all of the parsing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricemart.operators.dedupe import keep_first
from pricemart.operators.merge import source_cascade as _cascade
from pricemart.queries.inputs import table
from pricemart.queries.render import cents, dfmt, money
from pricemart.session import scratch_path
from pricemart.sinks.warehouse import insert_if_empty as _insert_if_empty
from pricemart.sources import api_payload as api
from pricemart.sources import csv_alias as csv
from pricemart.sources import envelope as env
from pricemart.sources import html_tables as html
from pricemart.sources.lookback import lookback_filter as _lookback

SP = "spark"

# ----------------------------------------------------------------- envelopes

EVENT_RECORD = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()), T.StructField("value", T.StringType()),
])


def scan_envelope(spark, sf) -> DataFrame:
    """Events landed as daily JSON envelopes (SNK1), read back and exploded (SRC1-3)."""
    ev = table(spark, sf, "events")
    recs = ev.select("event_id", "user_id", "event_type", "value",
                     F.date_format("ts", "yyyy-MM-dd").alias("fetched_at"))
    path = scratch_path(spark, "envelopes")
    env.write_envelopes(recs, path, source="events", order=["event_id"], max_records=500)
    back = env.read_envelopes(spark, path, EVENT_RECORD)
    return back.select("event_id", "user_id", "event_type", F.col("value").try_cast("double").alias("value"),
                       "fetched_at")


def feed_records(spark, sf) -> dict[str, tuple]:
    """Records of the three feeds in their landed schemas: (frame with a ``k`` to order by, record schema)."""
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    month = F.date_format("o_orderdate", "yyyy-MM").alias("period")
    text = lambda c: c.cast("string")
    return {
        "benchmark": (li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("k"), F.date_format("l_shipdate", "yyyy-MM").alias("period"),
                                text(F.col("l_extendedprice") / 1000).alias("value"), F.lit('a "quoted" }{ source').alias("source")), env.BENCHMARK_RECORD),
        "rates": (o.select(F.col("o_orderkey").alias("k"), month, text(F.col("o_totalprice") / 1000).alias("usd_lkr_avg"),
                           text(F.col("o_orderkey") % 30).alias("sample_count")), env.RATES_RECORD),
        "prices": (o.select(F.col("o_orderkey").alias("k"), month, F.col("o_orderpriority").alias("fuel_type"),
                            text(F.col("o_totalprice") / 200).alias("price_lkr"), F.lit("scrape").alias("source")), env.PRICES_RECORD),
    }


def scan_envelope_feeds(spark, sf) -> DataFrame:
    """The three feeds as envelopes of both layouts in one folder, JSON Lines and pretty objects one after another, read back."""
    out = None
    for feed, (rows, record) in feed_records(spark, sf).items():
        path = scratch_path(spark, f"envelopes-{feed}")
        env.write_envelopes(rows.where("k % 2 = 0").withColumn("fetched_at", F.lit("2001-08-02")).select(
            "fetched_at", *record.fieldNames(), "k"), path, source=feed, order=["k"], max_records=500)
        pretty = rows.where("k % 2 = 1").groupBy(F.floor(F.col("k") / 4000).alias("part")).agg(
            F.sort_array(F.collect_list(F.struct("k", F.struct(*record.fieldNames()).alias("r")))).alias("rs"))
        body = F.to_json(F.struct(F.lit(feed).alias("source"), F.lit("2001-08-03").alias("fetched_at"), "part",
                                  F.transform("rs", lambda x: x["r"]).alias("records")), {"pretty": "true"})
        pretty.select(body.alias("value")).write.text(f"{path}/_day=pretty")
        back = env.read_envelopes(spark, path, record, multiline=True)
        value = next(c for c in ("value", "usd_lkr_avg", "price_lkr") if c in back.columns)
        label = F.col("fuel_type") if feed == "prices" else F.col("sample_count") if feed == "rates" else F.col("source")
        rows = back.select(F.lit(feed).alias("feed"), "period", label.alias("label"), F.col(value).try_cast("double").alias("value"), "fetched_at")
        out = rows if out is None else out.unionByName(rows)
    return out


def snapshot_latest(spark, sf) -> DataFrame:
    """Three landed snapshots (one per order status) read as one directory; newest wins (Q2)."""
    o = table(spark, sf, "orders")
    recs = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("period"),
                    F.col("o_orderpriority").alias("fuel_type"), (F.col("o_totalprice") / 200).alias("price_lkr"),
                    F.col("o_orderkey").alias("_pos"),
                    F.when(F.col("o_orderstatus") == "F", "2001-08-02").when(F.col("o_orderstatus") == "O", "2001-08-03")
                     .otherwise("2001-08-04").alias("fetched_at"))
    path = scratch_path(spark, "snapshots")
    env.write_snapshot(recs, path)
    snaps = env.read_snapshots(spark, path)
    latest = keep_first(snaps, ["period", "fuel_type"], [("fetched_at", False), ("_pos", True)])
    return latest.select("period", "fuel_type", "price_lkr", F.col("fetched_at").cast("date").alias("fetched_at"))


# ----------------------------------------------------------------- API payloads

def payload_docs(spark, sf) -> DataFrame:
    """Landed API responses rendered from lineitem: one document per 16 orders."""
    li = table(spark, sf, "lineitem")
    k = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) % 10
    item = F.struct(
        F.when(k == 1, F.lit("")).otherwise(F.date_format("l_shipdate", "yyyy-MM")).alias("period"),
        F.when(k == 0, F.lit(None).cast("string")).when(k == 2, F.lit("n/a"))
         .otherwise((F.col("l_extendedprice") / 1000).cast("string")).alias("value"))
    doc_id = F.floor(F.col("l_orderkey") / 16).cast("long")
    docs = li.groupBy(doc_id.alias("doc_id")).agg(
        F.sort_array(F.collect_list(F.struct("l_orderkey", "l_linenumber", item.alias("item")))).alias("items"))
    body = F.to_json(F.struct(F.struct(F.transform("items", lambda x: x["item"]).alias("data")).alias("response")))
    # beside them responses without data
    more = docs.where("doc_id % 5 = 0").select((-1 - F.col("doc_id")).alias("doc_id"), F.lit('{"status":"no data"}').alias("payload"))
    return docs.select("doc_id", body.alias("payload")).unionByName(more)


def api_payload_records(spark, sf) -> DataFrame:
    return api.payload_records(payload_docs(spark, sf), source="api").select("period", "value", "source")


def json_path(spark, sf) -> DataFrame:
    d = payload_docs(spark, sf)
    return d.select("doc_id", F.size(api.payload_items("payload")).cast("long").alias("n_items"))


def page_sorted(spark, sf) -> DataFrame:
    return api.page(api_payload_records(spark, sf), ["period", "value", "source"], 0, 5000)


# ----------------------------------------------------------------- CSV layouts

def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", True).mode("overwrite").csv(path)
    return path


def benchmark_csv_text(engine: str) -> dict[int, list[tuple[str, str]]]:
    value = f"CASE WHEN l_orderkey % 13 = 0 THEN '' ELSE {money(cents('l_extendedprice'), thousands=True)} END"
    return {
        0: [(dfmt("l_shipdate", "ym", engine), "period"), (value, "value")],
        1: [(dfmt("l_shipdate", "mdy_slash", engine), "Period"), (value, "Value")],
        2: [(dfmt("l_shipdate", "ymd", engine), "date"), (value, "price")],
        3: [(dfmt("l_shipdate", "mdy_short", engine), "Date"), (value, "Price")],
    }


def csv_alias_benchmark(spark, sf) -> DataFrame:
    li = table(spark, sf, "lineitem")
    base = scratch_path(spark, "csv-benchmark")
    paths = []
    for lay, cols in benchmark_csv_text(SP).items():
        part = li.where(F.col("l_linenumber") % 4 == lay).select(*[F.expr(e).alias(n) for e, n in cols])
        paths.append(_write_csv(part, f"{base}/layout{lay}"))
    return csv.read_layouts(spark, paths, csv.benchmark_from_csv)


RATE_CENTS = "(CAST(l_quantity AS BIGINT) * 2100 + l_partkey % 100)"


def rates_csv_text(engine: str) -> dict[int, list[tuple[str, str]]]:
    rate = money(RATE_CENTS, thousands=True)
    return {
        0: [("CASE l_orderkey % 5 WHEN 0 THEN 'EUR' WHEN 1 THEN '' ELSE 'usd' END", "Currency"),
            (dfmt("l_shipdate", "ymd", engine), "Date"), (rate, "Exchange Rate")],
        1: [(dfmt("l_shipdate", "dmy_slash", engine), "date"), (rate, "usd_lkr")],
        2: [(dfmt("l_shipdate", "dmy_dot", engine), "﻿Date"), (money(f"{RATE_CENTS} - 50", True), "Buying Rate"),
            (money(f"{RATE_CENTS} + 50", True), "Selling Rate"),
            (f"CASE WHEN l_orderkey % 4 = 0 THEN '' ELSE {rate} END", "Mid Rate")],
    }


def _rates_csv_paths(spark, sf) -> list[str]:
    li = table(spark, sf, "lineitem")
    base = scratch_path(spark, "csv-rates")
    paths = []
    for lay, cols in rates_csv_text(SP).items():
        part = li.where(F.col("l_linenumber") % 3 == lay).select(*[F.expr(e).alias(n) for e, n in cols])
        paths.append(_write_csv(part, f"{base}/layout{lay}"))
    return paths


def csv_alias_rates(spark, sf) -> DataFrame:
    return csv.read_layouts(spark, _rates_csv_paths(spark, sf), csv.rates_from_csv)


PRICE_CENTS = "CAST(floor(CAST(ROUND(o_totalprice * 100) AS BIGINT) / 200) AS BIGINT)"


def prices_csv_text(engine: str) -> dict[int, list[tuple[str, str]]]:
    return {
        0: [(dfmt("o_orderdate", "ym", engine), "period"), ("o_orderpriority", "fuel_type"),
            (money(PRICE_CENTS), "price_lkr")],
        1: [(dfmt("o_orderdate", "dmy_dot", engine), "﻿Date"), ("lower(o_orderpriority)", "Fuel Type"),
            (f"concat('Rs ', {money(PRICE_CENTS)})", "Price LKR")],
        2: [(dfmt("o_orderdate", "mon_y", engine), "date"), ("o_orderpriority", "fuel"),
            (money(PRICE_CENTS, thousands=True), "price")],
    }


def _prices_csv_paths(spark, sf, orders: DataFrame | None = None) -> list[str]:
    o = orders if orders is not None else table(spark, sf, "orders")
    base = scratch_path(spark, "csv-prices")
    paths = []
    for lay, cols in prices_csv_text(SP).items():
        part = o.where(F.col("o_orderkey") % 3 == lay).orderBy("o_orderkey").select(*[F.expr(e).alias(n) for e, n in cols])
        paths.append(_write_csv(part, f"{base}/layout{lay}"))
    return paths


def csv_alias_prices(spark, sf) -> DataFrame:
    return csv.read_layouts(spark, _prices_csv_paths(spark, sf), csv.prices_from_csv).drop("_pos")


# ----------------------------------------------------------------- HTML pages

HIDDEN_TABLE = "<!-- <table><tr><td>LP 92</td></tr><tr><td>1999-01-02</td><td>1.00</td></tr></table> -->"


def rate_row_html(engine: str) -> str:
    date = (f"CASE l_linenumber % 3 WHEN 0 THEN {dfmt('l_shipdate', 'ymd', engine)} "
            f"WHEN 1 THEN {dfmt('l_shipdate', 'dmy_slash', engine)} ELSE {dfmt('l_shipdate', 'dmy_dot', engine)} END")
    rate = money(RATE_CENTS, thousands=True)
    # some rates in a nested table, with numeric references, in cells without end tags
    return (f"CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN '<tr><td colspan=\"2\">n/a</td></tr>' "
            f"WHEN l_orderkey % 96 = 1 THEN concat('<tr><td>', {date}, '</td><td><table><tr><td> ', {rate}, '</td></tr></table></td></tr>') "
            f"WHEN l_orderkey % 3 = 0 THEN concat('<tr><td>', {date}, '</td><td>&#160;', replace({rate}, '.', '&#x2E;'), '&ensp;</td></tr>') "
            f"WHEN l_orderkey % 7 = 2 THEN concat('<tr><td>', {date}, '<td>', {rate}, '<!-- </td><td>0 -->') "
            f"ELSE concat('<tr class=\"r\"><td>', {date}, '</td><td> ', {rate}, ' </td></tr>') END")


def rate_pages(spark, sf) -> DataFrame:
    """Pages with two rate tables each, rendered from lineitem (8 orders per page); some with a table in a comment, some
    without the last table's end."""
    li = table(spark, sf, "lineitem")
    rows = li.select(F.floor(F.col("l_orderkey") / 8).cast("long").alias("page_id"),
                     F.when(F.col("l_linenumber") <= 3, 0).otherwise(1).alias("tbl"),
                     F.struct("l_orderkey", "l_linenumber").alias("k"), F.expr(rate_row_html(SP)).alias("row_html"))
    pages = rows.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("tbl", "k", "row_html"))).alias("rs"))

    def rate_table(tbl):
        own = F.transform(F.filter("rs", lambda x: x["tbl"] == tbl), lambda x: x["row_html"])
        return F.concat(F.lit('<table class="rates"><tr><th>Date</th><th>Rate</th></tr>'), F.array_join(own, ""), F.lit("</table>"))
    tables = F.array_join(F.transform(F.array_sort(F.array_distinct(F.transform("rs", lambda x: x["tbl"]))), rate_table), "\n")
    return pages.select("page_id", F.concat(F.lit("http://rates.example/p"), F.col("page_id").cast("string")).alias("url"),
                        F.concat(F.lit("<html><body><h1>Rates</h1>"), F.when(F.col("page_id") % 2 == 1, HIDDEN_TABLE).otherwise(""),
                                 F.when((F.col("page_id") % 5 == 1) & (F.col("page_id") % 12 != 0), F.regexp_replace(tables, "</table>$", ""))
                                 .otherwise(tables),
                                 F.lit("</body></html>")).alias("html"))


def html_first_table(spark, sf) -> DataFrame:
    return html.two_column_rates(rate_pages(spark, sf), first_table_only=True).select("page_id", "date", "usd_lkr")


def html_all_tables(spark, sf) -> DataFrame:
    return html.two_column_rates(rate_pages(spark, sf), first_table_only=False).select("page_id", "date", "usd_lkr")


def price_cells(engine: str) -> dict[str, str]:
    c0 = PRICE_CENTS
    return {
        "date": (f"CASE o_orderkey % 4 WHEN 0 THEN {dfmt('o_orderdate', 'dmy_dot', engine)} "
                 f"WHEN 1 THEN {dfmt('o_orderdate', 'ymd', engine)} WHEN 2 THEN {dfmt('o_orderdate', 'mon_y', engine)} "
                 f"ELSE {dfmt('o_orderdate', 'dmy_slash', engine)} END"),
        "p1": money(c0),
        "p2": money(f"{c0} + 150", thousands=True),
        "p3": f"CASE WHEN o_orderkey % 4 = 0 THEN '-' ELSE {money(f'{c0} * 2')} END",
        "p4": f"concat('Rs. ', {money(f'{c0} * 3')})",
    }


def price_pages(spark, sf, orders: DataFrame | None = None) -> DataFrame:
    """Pages with a decoy table and a wide price table, rendered from orders (16 orders per page)."""
    o = orders if orders is not None else table(spark, sf, "orders")
    c = {k: F.expr(v) for k, v in price_cells(SP).items()}
    key = F.col("o_orderkey")
    # some dates in header cells, prices with numeric references, a last price in a nested table
    date = F.when(key % 6 == 1, F.concat(F.lit("<tr><th scope=row>"), c["date"], F.lit("</th>"))).otherwise(
        F.concat(F.lit("<tr><td>"), c["date"], F.lit("</td>")))
    p2 = F.when(key % 5 == 0, F.concat(F.lit("&#xA0;"), F.replace(c["p2"], F.lit("."), F.lit("&#46;")))).otherwise(c["p2"])
    p4 = F.when(key % 64 == 5, F.concat(F.lit("<table><tr><td>"), c["p4"], F.lit("</td></tr></table>"))).otherwise(c["p4"])
    full = F.concat(date, F.lit("<td>&nbsp;"), c["p1"], F.lit("</td><td><b>"), p2,
                    F.lit("</b></td><td>"), c["p3"], F.lit("</td><td>"), p4, F.lit("</td></tr>"))
    short = F.concat(F.lit("<tr><td>"), c["date"], F.lit("</td><td>&nbsp;"), c["p1"], F.lit("</td></tr>"))
    rows = o.select(F.floor(F.col("o_orderkey") / 16).cast("long").alias("page_id"), "o_orderkey",
                    F.when(F.col("o_orderkey") % 7 == 0, short).otherwise(full).alias("row_html"))
    pages = rows.groupBy("page_id").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "row_html"))).alias("rs"))
    head = ('<html><body><table class="note"><tr><td>Notice</td></tr><tr><td>Updated daily</td></tr></table>'
            '<table id="prices" border="1"><tr><th>Date</th><th>LP 95</th><th>LP 92</th>'
            '<th class="x">LAD</th><th>Fur. 800</th></tr>')
    return pages.select("page_id", F.concat(F.lit("http://prices.example/p"), F.col("page_id").cast("string")).alias("url"),
                        F.concat(F.when(F.col("page_id") % 2 == 1, HIDDEN_TABLE).otherwise(""), F.lit(head),
                                 F.array_join(F.transform("rs", lambda x: x["row_html"]), "\n"),
                                 F.when((F.col("page_id") % 3 == 1) & (F.col("page_id") % 4 != 0), "").otherwise("</table>"),
                                 F.lit("</body></html>")).alias("html"))


def html_price_table(spark, sf) -> DataFrame:
    return html.price_table(price_pages(spark, sf)).select("page_id", "period", "fuel_type", "price_lkr", "source")


# ----------------------------------------------------------------- cascade, look-back, insert-if-empty

def source_cascade(spark, sf) -> DataFrame:
    """Rates: first table of the real ``pages`` -> all tables of ``pages`` -> rate CSVs."""
    pages = table(spark, sf, "pages")
    a = html.two_column_rates(pages, first_table_only=True).select("date", "usd_lkr")
    b = html.two_column_rates(pages, first_table_only=False).select("date", "usd_lkr")
    c = lambda: csv.read_layouts(spark, _rates_csv_paths(spark, sf), csv.rates_from_csv)
    return _cascade([a, b, c])


LOOKBACK_AS_OF = "2001-08-01"


def lookback_filter(spark, sf) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    return _lookback(o, "o_orderdate", LOOKBACK_AS_OF, 730)


def insert_if_empty(spark, sf) -> DataFrame:
    from pricemart.queries.star import q_dim_date
    src = q_dim_date(spark, sf)
    empty_path, filled_path = scratch_path(spark, "target-empty"), scratch_path(spark, "target-filled")
    src.limit(0).write.mode("overwrite").parquet(empty_path)
    src.write.mode("overwrite").parquet(filled_path)
    a = _insert_if_empty(src, spark.read.parquet(empty_path)).withColumn("tgt", F.lit("empty_target"))
    b = _insert_if_empty(src, spark.read.parquet(filled_path)).withColumn("tgt", F.lit("filled_target"))
    return a.unionByName(b)


QUERIES = {
    "scan_envelope": scan_envelope,
    "scan_envelope_feeds": scan_envelope_feeds,
    "snapshot_latest": snapshot_latest,
    "api_payload_records": api_payload_records,
    "json_path": json_path,
    "page_sorted": page_sorted,
    "csv_alias_benchmark": csv_alias_benchmark,
    "csv_alias_rates": csv_alias_rates,
    "csv_alias_prices": csv_alias_prices,
    "html_first_table": html_first_table,
    "html_all_tables": html_all_tables,
    "html_price_table": html_price_table,
    "source_cascade": source_cascade,
    "lookback_filter": lookback_filter,
    "insert_if_empty": insert_if_empty,
}


def snapshot_latest_stream(spark, sf) -> DataFrame:
    """The same three snapshots as ``snapshot_latest``, landed one after another and folded
    incrementally by a file-source stream (one micro-batch per landed snapshot)."""
    from pricemart.streaming import fold_latest
    o = table(spark, sf, "orders")
    recs = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("period"),
                    F.col("o_orderpriority").alias("fuel_type"), (F.col("o_totalprice") / 200).alias("price_lkr"),
                    F.col("o_orderkey").alias("_pos"), F.col("o_orderstatus"))
    raw, state = scratch_path(spark, "stream-raw"), scratch_path(spark, "stream-state")
    schema = T.StructType([T.StructField("period", T.StringType()), T.StructField("fuel_type", T.StringType()),
                           T.StructField("price_lkr", T.DoubleType()), T.StructField("_pos", T.LongType()),
                           T.StructField("fetched_at", T.DateType())])
    ckpt = scratch_path(spark, "stream-ckpt")
    out = None
    for status, day in (("F", "2001-08-02"), ("O", "2001-08-03"), ("P", "2001-08-04")):
        env.write_snapshot(recs.where(F.col("o_orderstatus") == status).drop("o_orderstatus")
                           .withColumn("fetched_at", F.lit(day)), raw)
        out = fold_latest(spark, raw, schema, ["period", "fuel_type"], [("fetched_at", False), ("_pos", True)],
                          state, checkpoint=ckpt)
    return out.select("period", "fuel_type", "price_lkr", F.col("fetched_at").cast("date").alias("fetched_at"))


QUERIES["snapshot_latest_stream"] = snapshot_latest_stream
