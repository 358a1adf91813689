"""Reader tests on small fixtures (FIXTURES.md §1-4)."""

import json
import os

from pyspark.sql import functions as F

from pricemart.session import scratch_path
from pricemart.sources import api_payload as api
from pricemart.sources import csv_alias as csv
from pricemart.sources import envelope as env
from pricemart.sources import html_tables as html


def _local(p):
    return p[len("file:"):] if p.startswith("file:") else p


def test_reference_envelopes_multiline(spark):
    base = scratch_path(spark, "ref-env")
    d = _local(base)
    os.makedirs(d, exist_ok=True)
    docs = {
        "2024-01-01.json": {"source": "api", "fetched_at": "2024-01-01",
                            "records": [{"period": "2022-01", "value": 83.5, "source": "api"},
                                        {"period": "2022-02", "value": None, "source": "api"}]},
        "2024-01-02.json": {"source": "api", "fetched_at": "2024-01-02",
                            "records": [{"period": "2022-01", "value": 84.0, "extra": 1},
                                        {"value": 90.0}]},
        "2024-01-03.json": {"source": "api", "fetched_at": "2024-01-03", "records": []},
    }
    for name, doc in docs.items():
        with open(os.path.join(d, name), "w") as fh:
            json.dump(doc, fh, indent=2)
    df = env.read_envelopes(spark, base, env.BENCHMARK_RECORD, multiline=True)
    key = lambda t: tuple("" if x is None else x for x in t)
    got = sorted(((r.period, r.value, str(r.fetched_at)) for r in df.collect()), key=key)
    assert got == sorted([(None, "90.0", "2024-01-02"), ("2022-01", "83.5", "2024-01-01"),
                          ("2022-01", "84.0", "2024-01-02"), ("2022-02", None, "2024-01-01")], key=key)


def test_envelope_round_trip_and_chunks(spark):
    recs = spark.range(0, 1200).select(F.col("id").alias("event_id"), F.lit(1).cast("long").alias("user_id"),
                                       F.lit("view").alias("event_type"), (F.col("id") / 10).cast("string").alias("value"),
                                       F.when(F.col("id") < 1000, "2024-01-01").otherwise("2024-01-02").alias("fetched_at"))
    path = scratch_path(spark, "env")
    env.write_envelopes(recs, path, source="t", order=["event_id"], max_records=300)
    raw = spark.read.json(path)
    sizes = [r[0] for r in raw.select(F.size("records")).collect()]
    assert sorted(sizes) == [100, 200, 300, 300, 300]         # 1000 records of one day, 200 of the other
    back = env.read_envelopes(spark, path, env.BENCHMARK_RECORD.__class__([
        *[f for f in __import__("pricemart.queries.readers", fromlist=["EVENT_RECORD"]).EVENT_RECORD.fields]]))
    assert back.count() == 1200


def test_snapshot_dynamic_overwrite(spark):
    path = scratch_path(spark, "snap")
    a = spark.createDataFrame([("2022-01", 1.0, "2024-01-01"), ("2022-01", 2.0, "2024-01-02")],
                              "period string, v double, fetched_at string")
    env.write_snapshot(a, path)
    env.write_snapshot(spark.createDataFrame([("2022-01", 3.0, "2024-01-02")], "period string, v double, fetched_at string"), path)
    got = sorted((r.v, str(r.fetched_at)) for r in env.read_snapshots(spark, path).collect())
    assert got == [(1.0, "2024-01-01"), (3.0, "2024-01-02")]
    assert env.read_snapshots(spark, path, since="2024-01-02").count() == 1


def test_api_payload_golden(spark):
    payload = ('{"response":{"data":[{"period":"2022-01","value":"83.41"}, {"period":"","value":1}, '
               '{"period":"2022-02","value":null}, {"period":"2022-03","value":"n/a"}]}}')
    docs = spark.createDataFrame([(1, payload), (2, '{"status":"x"}')], "doc_id long, payload string")
    got = [tuple(r) for r in api.payload_records(docs).select("period", "value", "source").collect()]
    assert got == [("2022-01", 83.41, "api")]
    assert sorted(tuple(r) for r in docs.select("doc_id", F.size(api.payload_items("payload"))).collect()) == [(1, 4), (2, 0)]


def _write(path, text):
    p = _local(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, "part-0.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)
    return path


def test_csv_layouts(spark):
    b1 = _write(scratch_path(spark, "c1"), 'period,value\n2022-01,"1,234.50"\n01/2022,5\n, 7\n')
    b2 = _write(scratch_path(spark, "c2"), "Date,Price\n1/15/2022,83.41\n2022-01-15,80\n")
    got = sorted(tuple(r) for r in csv.read_layouts(spark, [b1, b2], csv.benchmark_from_csv).collect())
    assert got == [("2022-01", 80.0, "backup_csv"), ("2022-01", 83.41, "backup_csv"), ("2022-01", 1234.5, "backup_csv")]
    r1 = _write(scratch_path(spark, "r1"), "Currency,Date,Exchange Rate\nUSD,2023-01-05,365.20\nEUR,2023-01-05,400\n,05/01/2023,366\n")
    r2 = _write(scratch_path(spark, "r2"), "﻿Date,Buying Rate,Selling Rate,Mid Rate\n05.01.2023,360,370,365\n06.01.2023,360,370,\n")
    got = sorted((str(r.date), r.usd_lkr) for r in csv.read_layouts(spark, [r1, r2], csv.rates_from_csv).collect())
    assert got == [("2023-01-05", 365.0), ("2023-01-05", 365.2), ("2023-01-05", 366.0), ("2023-01-06", 370.0)]
    p1 = _write(scratch_path(spark, "p1"), "﻿Date,Fuel Type,Price LKR\n22.03.2026,lp 92,\"1,200.50\"\nMar 2026,Auto Diesel,-\n")
    got = [tuple(r) for r in csv.read_layouts(spark, [p1], csv.prices_from_csv).select(
        "period", "fuel_type", "price_lkr").collect()]
    assert got == [("2026-03", "LP_92", 1200.5)]


def test_csv_without_line_breaks_is_split(spark):
    p = _write(scratch_path(spark, "split"), "period,value\n" + "".join(f"{1900 + i % 100}-01,{i}\n" for i in range(2000)))
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        whole, split = (csv.read_layouts(spark, [p], csv.benchmark_from_csv, m) for m in (True, False))
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 1
        assert sorted(whole.collect()) == sorted(split.collect()) and split.count() == 2000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)


PRICE_PAGE = """<html><body>
<table class="menu"><tr><td>Home</td><td>About</td></tr></table>
<table id="t" border=1>
<tr><th>Date</th><th>LP 95</th><th>LP 92</th><th>LAD</th><th>Kerosene X</th></tr>
<tr><td>22.03.2026</td><td>400.00</td><td><b>317</b>.00</td><td>-</td><td>190</td></tr>
<tr><td class="d">01.03.2026</td><td>390.00</td></tr>
<tr><td>junk</td><td>1</td><td>2</td></tr>
<tr><td>15/02/2026</td><td>380</td><td>300</td><td>280</td>
</table></body></html>"""


def test_price_table_fixture(spark):
    pages = spark.createDataFrame([(1, "u", PRICE_PAGE)], "page_id long, url string, html string")
    got = sorted((r.period, r.fuel_type, r.price_lkr, r.row_pos) for r in html.price_table(pages).collect())
    assert got == [("2026-02", "AUTO_DIESEL", 280.0, 4), ("2026-02", "LP_92", 300.0, 4), ("2026-02", "LP_95", 380.0, 4),
                   ("2026-03", "KEROSENE_X", 190.0, 1), ("2026-03", "LP_92", 317.0, 1), ("2026-03", "LP_95", 390.0, 2),
                   ("2026-03", "LP_95", 400.0, 1)]


def test_two_column_rates_fixture(spark):
    page = ("<table><tr><th>Date</th><th>Rate</th></tr><tr><td>2023-01-05</td><td>365.20</td></tr>"
            "<tr><td colspan=2>n/a</td></tr><tr><td>05/01/2023</td><td>1,000.00</td></tr></table>"
            "<table><tr><th>D</th></tr><tr><td>06.01.2023</td><td>366</td></tr></table>")
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    first = sorted((str(r.date), r.usd_lkr) for r in html.two_column_rates(pages, True).collect())
    assert first == [("2023-01-05", 365.2), ("2023-01-05", 1000.0)]
    assert html.two_column_rates(pages, False).count() == 3


def test_envelopes_keep_order_and_size_of_equal_records(spark):
    rec = env.BENCHMARK_RECORD
    same = spark.createDataFrame([("2022-01", "5", "api", "2024-01-01")] * 50, "period string, value string, source string, fetched_at string")
    path = scratch_path(spark, "same")
    env.write_envelopes(same, path, source="t", max_records=5)
    assert {r[0] for r in spark.read.json(path).select(F.size("records")).collect()} == {5}
    listed = spark.createDataFrame([("2022-01", str(v), "api", "2024-01-01", i) for i, v in enumerate((300, 250, 296, 280))],
                                   "period string, value string, source string, fetched_at string, n int")
    path = scratch_path(spark, "listed")
    env.write_envelopes(listed, path, source="t", order=["n"], max_records=2)
    back = env.read_envelopes(spark, path, rec).orderBy("_pos")
    assert [r.value for r in back.collect()] == ["300", "250", "296", "280"]


def test_a_file_of_the_other_layout_stops_the_read(spark):
    import pytest
    base = scratch_path(spark, "mixed")
    os.makedirs(_local(base), exist_ok=True)
    doc = {"source": "api", "fetched_at": "2024-01-01", "records": [{"period": "2022-01", "value": 1}]}
    for name, indent in (("a.json", None), ("b.json", 2)):
        with open(os.path.join(_local(base), name), "w") as fh:
            json.dump(doc, fh, indent=indent)
    with pytest.raises(Exception, match="(?i)malformed"):
        env.read_envelopes(spark, base, env.BENCHMARK_RECORD).collect()
    assert env.read_envelopes(spark, base, env.BENCHMARK_RECORD, multiline=True).count() == 2


def test_csv_first_listed_row_wins(spark):
    from pricemart.operators import priority_merge, tag_source
    p = _write(scratch_path(spark, "first"), "date,fuel,price\nMar 2026,LP 92,300\nMar 2026,LP 92,250\nMar 2026,LP 92,280\n")
    df = csv.prices_from_csv(csv.read_csv_text(spark, p))
    merged = priority_merge([tag_source(df, 0, "csv")], ["period", "fuel_type"])
    assert [r.price_lkr for r in merged.collect()] == [300.0]


def test_csv_quoted_line_breaks_and_quotes(spark):
    p = _write(scratch_path(spark, "quoted"), 'period,value,note\n2022-01,"1,2\n50",x\n2022-02,7,"a ""b"", c"\n')
    df = csv.read_csv_text(spark, p)
    assert df.count() == 2 and df.where("period = '2022-02'").first().note == 'a "b", c'
    assert [tuple(r) for r in csv.benchmark_from_csv(df).collect()] == [("2022-02", 7.0, "backup_csv")]


def test_csv_headers_that_differ_in_one_folder_fail(spark):
    import pytest
    base = scratch_path(spark, "swapped")
    os.makedirs(_local(base), exist_ok=True)
    for name, text in (("a.csv", "period,value\n2022-01,5\n"), ("b.csv", "value,period\n6,2022-02\n")):
        with open(os.path.join(_local(base), name), "w") as fh:
            fh.write(text)
    with pytest.raises(Exception, match="(?i)header"):
        csv.benchmark_from_csv(csv.read_csv_text(spark, base)).collect()


def _price_page(spark, *rows, head="<th>Date</th><th>LP 95</th><th>LP 92</th>", end="</table>"):
    page = f"<table><tr>{head}</tr>" + "".join(f"<tr><td>22.03.2026</td>{r}</tr>" for r in rows) + end
    return spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")


def test_html_references_never_become_prices(spark):
    cells = ["&#160;", "&#xA0;", "&nbsp;", "&#45;", "&#x2D;", "&ndash;", "&#8212;", "&#150;", "&#160;13.5", "&#49;&#50;.5", "1&#44;200.5", "&amp;#49;"]
    pages = _price_page(spark, *[f"<td>{c}</td>" for c in cells])
    got = {(r.row_pos, r.price_lkr) for r in html.price_table(pages).collect()}
    assert got == {(9, 13.5), (10, 12.5), (11, 1200.5)} | {(r, p) for r, p in got if r == 12}      # "&#49;" as text: digits of a text
    from pricemart.functions.text import cell_text
    texts = ["&lt;b&gt;", "&amp;lt;", "&amp;#49;", " &#x1F600; ", "a&#0;b&#xD800;", "&bogus; & &#x;", "&euro;&#128;", "<i>&#32; x </i>\n y"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(cell_text("t").alias("c"))
    assert [r.c for r in df.collect()] == ["<b>", "&lt;", "&#49;", "\U0001F600", "a\ufffdb\ufffd", "&bogus; & &#x;", "\u20ac\u20ac", "xy"]


def test_html_comments_scripts_and_missing_ends(spark):
    hidden = ("<!-- <table><tr><td>2023-01-01</td><td>1</td></tr><tr><td>2023-01-01</td><td>1</td></tr></table> -->"
              "<script>var t='<table><tr><td>x</td></tr><tr><td>2023-01-02</td><td>2</td></tr></table>';</script>")
    page = hidden + "<table><tr><th>D</th><th>R</th></tr><tr><td>2023-01-05<th>note<td>365.2<tr><td>06.01.2023</td><td>366"
    pages = spark.createDataFrame([(1, "u", page), (2, "u", page + "<table><tr><td>h</td></tr><tr><td>07.01.2023<td>367")],
                                  "page_id long, url string, html string")
    first = sorted((r.page_id, str(r.date), r.usd_lkr) for r in html.two_column_rates(pages, True).collect())
    assert first == [(i, d, v) for i in (1, 2) for d, v in (("2023-01-05", 365.2), ("2023-01-06", 366.0))]
    assert html.two_column_rates(pages, False).count() == 5


def _files(path, files):
    os.makedirs(_local(path), exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(_local(path), name), "w", encoding="utf-8") as fh:
            fh.write(text)
    return path


def _envelope(value, **more):
    return {"source": "api", "fetched_at": "2024-01-01", "records": [{"period": "2022-01", "value": value, **more}]}


def test_no_envelope_is_skipped(spark):
    """JSON Lines read as multi-line, several objects in a pretty file or on a line, strings that look like ends."""
    import pytest
    tricky = 'a "quoted" }\\{ }  { [ \\n ] \\\\'
    objects = [_envelope(i, source=tricky) for i in range(6)]
    lines = "\n".join(json.dumps(o) for o in objects[:3]) + "\n"
    pretty = "﻿" + json.dumps(objects[3], indent=2) + "\n\n" + json.dumps(objects[4], indent=2)
    path = _files(scratch_path(spark, "objects"), {"a.json": lines, "b.json": pretty, "c.json": json.dumps(objects[5]), "d.json": " \n"})
    got = env.read_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True).collect()
    assert sorted(r.value for r in got) == list("012345") and {r.source for r in got} == {tricky}
    one_line = _files(scratch_path(spark, "one-line"), {"a.json": "".join(json.dumps(o) for o in objects) + "\n"})
    for multiline in (False, True):
        assert env.read_envelopes(spark, one_line, env.BENCHMARK_RECORD, multiline).count() == 6
    with pytest.raises(Exception, match="(?i)malformed"):
        env.read_envelopes(spark, path, env.BENCHMARK_RECORD).collect()


def test_corrupt_envelopes_stop_the_read_or_are_kept(spark):
    import pytest
    good = json.dumps(_envelope(1), indent=1)
    bad = {"cut.json": good[:-20], "tail.json": good + " xyz", "text.json": "not json", "list.json": "[1, 2]", "type.json": '{"records": "none"}',
           "string.json": '{"source": "open, "records": []}'}
    for name, text in bad.items():
        path = _files(scratch_path(spark, "bad"), {name: text, "good.json": good})
        with pytest.raises(Exception, match="(?i)malformed"):
            env.read_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True).collect()
    path = _files(scratch_path(spark, "mixed-bad"), {**bad, "good.json": good + good})
    assert env.read_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True, corrupt="keep").count() == 2
    kept = env.corrupt_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True).collect()
    assert sorted({os.path.basename(r.path) for r in kept}) == sorted(bad)
    with pytest.raises(ValueError):
        env.read_envelopes(spark, path, env.BENCHMARK_RECORD, corrupt="skip")


def test_nested_tables_keep_the_outer_rows(spark):
    inner = "<table><tr><td>inner</td><td>7</td></tr><tr><td>09.01.2023</td><td>369</td></tr></table>"
    page = (f"<TABLE><tr><th>D</th><th>R</th></tr><tr><td>2023-01-05</td><td>365.2</td></tr>"
            f"<tr><td>06.01.2023</td><td><table><tr><td> 366 </td></tr></table></td></tr>"
            f"<tr><td>07.01.2023</td><td>367</td><td>{inner}</td></tr><tr><td>08.01.2023</td><td>368</td></tr></TABLE>"
            f"<table><tr><td>h</td></tr><tr><td>10.01.2023</td><td>370</td></tr></table>")
    pages = spark.createDataFrame([(1, "u", page), (2, "u", page.replace("</tr>", "").replace("</td>", ""))], "page_id long, url string, html string")
    outer = [("2023-01-05", 365.2), ("2023-01-06", 366.0), ("2023-01-07", 367.0), ("2023-01-08", 368.0), ("2023-01-09", 369.0)]
    first = sorted((r.page_id, str(r.date), r.usd_lkr) for r in html.two_column_rates(pages, True).collect())
    assert [x[1:] for x in first if x[0] == 1] == outer
    assert {x[1:] for x in first if x[0] == 2} >= {("2023-01-05", 365.2), ("2023-01-08", 368.0)}
    every = sorted((str(r.date), r.usd_lkr) for r in html.two_column_rates(pages.where("page_id = 1"), False).collect())
    assert every == sorted([*outer, ("2023-01-09", 369.0), ("2023-01-10", 370.0)])
    price = ("<table><tr><td><table><tr><td>menu</td></tr></table></td></tr><tr><th>Date</th><th>LP 95</th></tr></table>"
             "<table><tr><th>Date</th><th>LP 95</th><th>LP 92</th></tr><tr><td>22.03.2026</td><td>400</td>"
             "<td><b>317</b><table><tr><td>.5</td></tr></table></td></tr><tr><td>01.03.2026</td><td>390</td></tr></table>")
    got = html.price_table(spark.createDataFrame([(1, "u", price.replace("<th>Date</th><th>LP 95</th></tr></table>", "</tr></table>"))],
                                                 "page_id long, url string, html string")).collect()
    assert sorted((r.period, r.fuel_type, r.price_lkr) for r in got) == [("2026-03", "LP_92", 317.5), ("2026-03", "LP_95", 390.0), ("2026-03", "LP_95", 400.0)]


def test_all_named_references_are_decoded(spark):
    from pricemart.functions.text import cell_text
    texts = ["&aacute;&Ccedil;&nosuch;x", "&alpha;&amp;beta;&gt", "caf&eacute; &amp;eacute;", "&NotEqualTilde;!"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(cell_text("t").alias("c"))
    assert [r.c for r in df.collect()] == ["áÇ&nosuch;x", "α&beta;&gt", "café &eacute;", "≂̸!"]


def test_large_files_of_objects_are_split(spark):
    """Objects over several lines: tasks read parts of a file, and an object that goes over them is put together."""
    objects = [_envelope(i, note="x" * (i % 7) + ' } \\n{ "') for i in range(400)]
    dense = [f'{{"source": "api", "fetched_at": "2024-01-01", "records": [\n{{"period": "2022-01", "value": "d{i}"}},\n'
             f'{{"period": "2022-02",\n "value": "e{i}"}}\n]\n}}' for i in range(300)]
    files = {"pretty.json": "﻿\n" + "\n\n".join(json.dumps(o, indent=2) for o in objects),
             "dense.json": "\r\n".join(dense[:200]) + "\n" + "".join(dense[200:250]) + "\n  ".join(dense[250:]),
             "bad.json": json.dumps(_envelope("z"), indent=2) + '\n{"source": "open}\n{"}'}
    path = _files(scratch_path(spark, "large"), files)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        spread = env._stretches(spark, path)
        longest = max(len(r.value) for r in spread.where("path not like '%dense%'").collect())
        got = env.read_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True, corrupt="keep").collect()
        kept = env.corrupt_envelopes(spark, path, env.BENCHMARK_RECORD, multiline=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert longest < 400
    expected = [*map(str, range(400)), *(f"{c}{i}" for i in range(300) for c in "de"), "z"]
    assert sorted(r.value for r in got) == sorted(expected)
    assert sorted(r.text for r in kept) == ['{"\n}', '{"source"\n: "open}']


def test_cells_are_extracted_once(spark):
    """A filter by the number of cells is pushed below the projection that computes them, and computes them again."""
    pages = spark.createDataFrame([(1, "u", "<table><tr><td>d</td></tr><tr></tr><tr><td>2023-01-05</td></tr><tr><td>2023-01-06</td><td>7</td></tr></table>")],
                                  "page_id long, url string, html string")
    rates = html.two_column_rates(pages, False)
    assert [(str(r.date), r.usd_lkr) for r in rates.collect()] == [("2023-01-06", 7.0)]
    assert rates._jdf.queryExecution().optimizedPlan().toString().count("<(?:td)") == 1
    prices = html.price_table(pages)
    filters = [x for x in prices._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in x]
    assert filters and not any("<(?:th|td)" in x for x in filters)


def test_long_nested_pages(spark):
    """Many rows with tables in their cells: every row and cell in its place."""
    rows = "".join(f"<tr><td>{1 + i % 28:02d}.01.2023<td><table><tr><td> {i + 1}</table></td><td>&#160;<p>x</tr>" for i in range(60))
    page = f"<table><tr><th>Date</th><th>Rate</th></tr>{rows}</table>" + "</table>" * 2
    pages = spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")
    got = html.two_column_rates(pages, True).orderBy("row_pos").collect()
    assert [(r.date.day, r.usd_lkr) for r in got] == [(1 + i % 28, i + 1.0) for i in range(60)]


def test_rendered_rate_pages_are_staged(spark, monkeypatch):
    """The cascade probes its feeds: pages rendered by a shuffle would be rendered for the probe and again for the read."""
    from pricemart.queries import jobs
    feeds = []
    monkeypatch.setattr(jobs.ingest, "ingest_rates", lambda sources, path, day: feeds.extend(sources) or sources[0].limit(0).select(
        F.lit("").alias("period"), F.lit(0.0).alias("usd_lkr_avg"), F.lit(0).alias("sample_count")))
    jobs.ingest_rates(spark, "/root/testdata/sf0.001")
    plan = feeds[1]()._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "lineitem" not in plan
