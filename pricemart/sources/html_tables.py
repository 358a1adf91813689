"""HTML tables held in a ``pages(page_id, url, html)`` table, extracted with native
regular expressions and exploded into rows and cells (no DOM parser, no UDF).

Comments, scripts and styles are removed first.  A table runs from ``<table ...>`` to
``</table>``, the next ``<table`` or the end of the page, a row from ``<tr ...>`` to the next row or the
table's end, a cell from ``<td ...>`` or ``<th ...>`` to the next cell of either kind or the row's end: closing
tags may be missing.  Cell text = text nodes decoded, stripped and joined without a
gap.  Every step is per page (one row), so the
work is spread by Spark's scan of the pages table.

Tables may be nested: a table that is closed holds all up to its own end tag, also other tables.  As in a search below an
element, the rows of inner tables are rows of the outer ones too, in document order, inner cells are cells of the
outer row too, and an outer cell's text holds the inner texts.  Pages without nesting (no two end tags in a row) take the
plain expressions; the others a scan of their tags, whose time grows with the page's tags times its tables.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricemart.config import FUEL_TABLE_KEYWORDS
from pricemart.functions.labels import map_category
from pricemart.functions.numbers import clean_price, parse_rate
from pricemart.functions.periods import parse_period, parse_rate_date
from pricemart.functions.text import cell_text, spaced_text, visible
from pricemart.operators.quality import parse_then_filter

# An element runs to the first of its stops or the end; they all begin with "<", so other characters pass in one go.
TABLE_RE = r"(?i)<table\b[^>]*>(?:[^<]++|<(?!/table\s*>|table\b))*+"
ROW_RE = r"(?i)<tr\b[^>]*>(?:[^<]++|<(?!tr\b|/table\s*>))*+"


def _cells_re(kinds: Sequence[str]) -> str:
    return rf"(?i)<(?:{'|'.join(kinds)})\b[^>]*>(?:[^<]++|<(?!t[dh]\b|/tr\s*>|tr\b))*+"


def _cells(row_html: Column, kinds: Sequence[str]) -> Column:
    """Text of every cell of a row (a lambda over the cells: use for small per-page work)."""
    return F.transform(_raw_cells(row_html, kinds), lambda c: cell_text(c))


def _raw_cells(row_html: Column, kinds: Sequence[str]) -> Column:
    """HTML of every cell of a row, in order."""
    return F.regexp_extract_all(row_html, F.lit(_cells_re(kinds)), 0)


_TAG = r"</?(?:table|tr|td|th)\b"


def _is_nested(page: Column) -> Column:
    """Whether a table ends inside another: two end tags without a table's begin between them."""
    return F.rlike(page, F.lit(r"(?i)</table\b(?:[^<]++|<(?!/?table\b))*+</table\b"))


def _flat_tables(page: Column) -> Column:
    """Tables as structs of their HTML and their rows' HTML, where none is nested."""
    tabs = F.regexp_extract_all(page, F.lit(TABLE_RE), 0)
    return F.transform(tabs, lambda t: F.struct(t.alias("html"), F.regexp_extract_all(t, F.lit(ROW_RE), 0).alias("rows")))


def _nested_tables(page: Column) -> Column:
    """The same where tables are nested: rows are written anew, one flat cell after another (inner tags become ``<i>``)."""
    def let(value, use):
        return F.element_at(F.transform(F.array(value), use), 1)

    def flat(html):
        return F.regexp_replace(html, rf"(?i){_TAG}[^>]*>", "<i>")

    def tables(segs, marks):
        """(o, e): numbers of a table's first segment and the one after its last.  The scan keeps a stack of open tables."""
        start = F.struct(F.array().cast("array<int>").alias("open"), F.array().cast("array<struct<o:int,e:int>>").alias("done"))

        def step(state, m):
            top = F.element_at(state["open"], -1)
            pushed = F.struct(F.concat(state["open"], F.array(m["i"])).alias("open"), state["done"].alias("done"))
            popped = F.struct(F.slice(state["open"], 1, F.size(state["open"]) - 1).alias("open"),
                              F.concat(state["done"], F.array(F.struct(top.alias("o"), m["i"].alias("e")))).alias("done"))
            return F.when(m["k"] == "table", pushed).when(F.size(state["open"]) > 0, popped).otherwise(state)

        seen = F.filter(marks, lambda m: m["k"].isin("table", "/table"))
        begins = F.filter(seen, lambda m: m["k"] == "table")
        return let(F.aggregate(seen, start, step)["done"], lambda done: F.transform(begins, lambda b: F.struct(
            b["i"].alias("o"), F.coalesce(F.get(F.filter(done, lambda d: d["o"] == b["i"]), 0)["e"],
                                          F.get(F.filter(begins, lambda x: x["i"] > b["i"]), 0)["i"], F.size(segs)).alias("e"))))

    def ended(marks, kinds, stops, tabs):
        """Elements of ``kinds``, each up to the next tag of ``stops`` in its own table or that table's end."""
        placed = F.transform(F.filter(marks, lambda m: m["k"].isin(*stops)), lambda m: F.struct(m["i"].alias("i"), m["k"].alias("k"), F.get(
            F.reverse(F.filter(tabs, lambda t: (t["o"] <= m["i"]) & (m["i"] < t["e"]))), 0).alias("t")))
        def of_table(every, t):
            own = F.filter(every, lambda x: x["t"]["o"] == t["o"])       # in page order: the next one is where an element ends
            return let(own, lambda own: F.filter(F.transform(own, lambda x, j: F.struct(
                x["i"].alias("i"), x["k"].alias("k"), F.coalesce(F.get(own, j + 1)["i"], t["e"]).alias("e"))), lambda x: x["k"].isin(*kinds)))
        return let(placed, lambda every: F.array_sort(F.flatten(F.transform(tabs, lambda t: of_table(every, t)))))

    def counts(segs, cells):
        """For every segment the number of cells that begin up to it."""
        return F.concat(F.array_repeat(F.lit(0), F.coalesce(F.get(cells, 0)["i"], F.size(segs))), F.flatten(F.transform(cells, lambda c, j: F.array_repeat(
            j + 1, F.coalesce(F.get(cells, j + 1)["i"], F.size(segs)) - c["i"]))))

    def build(segs, tabs, rows, cells, upto):
        def text(x):
            return F.array_join(F.slice(segs, x["i"] + 1, x["e"] - x["i"]), "")

        def row(r):
            first = F.get(upto, r["i"])
            own = F.slice(cells, first + 1, F.get(upto, r["e"] - 1) - first)
            return F.concat(F.lit("<tr>"), F.array_join(F.transform(own, lambda c: F.concat(F.lit("<"), c["k"], F.lit(">"), flat(text(c)))), ""))

        written = F.transform(rows, lambda r: F.struct(r["i"].alias("i"), row(r).alias("html")))
        return let(written, lambda written: F.transform(tabs, lambda t: F.struct(
            F.array_join(F.slice(segs, t["o"] + 1, t["e"] - t["o"]), "").alias("html"),
            F.transform(F.filter(written, lambda r: (r["i"] > t["o"]) & (r["i"] < t["e"])), lambda r: r["html"]).alias("rows"))))

    cell_kinds, row_stops = ("td", "th"), ("tr", "/tr")
    return let(F.split(page, rf"(?i)(?={_TAG})"), lambda segs: let(
        F.transform(segs, lambda s, i: F.struct(i.cast("int").alias("i"), F.lower(F.regexp_extract(s, rf"(?i)^<(/?(?:table|tr|td|th))\b", 1)).alias("k"))),
        lambda marks: let(tables(segs, marks), lambda tabs: let(ended(marks, ("tr",), row_stops, tabs), lambda rows: let(
            ended(marks, cell_kinds, (*cell_kinds, "/td", "/th", *row_stops), tabs), lambda cells: let(
                counts(segs, cells), lambda upto: build(segs, tabs, rows, cells, upto)))))))


def tables(page: Column) -> Column:
    """All tables of a page in document order: array of (html, rows), rows being an array of the rows' HTML."""
    seen = visible(page)
    return F.element_at(F.transform(F.array(seen), lambda p: F.when(_is_nested(p), _nested_tables(p)).otherwise(_flat_tables(p))), 1)


def two_column_rates(pages: DataFrame, first_table_only: bool) -> DataFrame:
    """Rate tables: each table's header row skipped, rows with at least two ``td`` cells,
    (cell 0, cell 1) -> (date, usd_lkr); unparseable rows skipped.

    Per page one pass: the data rows of the first (or every) table are gathered
    with array functions and exploded once; no join, no shuffle."""
    tabs = tables(F.col("html"))
    if first_table_only:
        tabs = F.slice(tabs, 1, 1)
    data_rows = F.flatten(F.transform(tabs, lambda t: F.filter(t["rows"], lambda r, i: i > 0)))
    ex = pages.select("page_id", data_rows.alias("_rows")).select(
        "page_id", F.posexplode_outer("_rows").alias("row_pos", "row_html"))
    r = ex.select("page_id", "row_pos", _raw_cells(F.col("row_html"), ("td",)).alias("cells"))
    # cell texts get their own projection: the parsers refer to their input once per
    # date format, and an inlined cell_text would be re-evaluated in each of them
    # (rows of fewer cells get no rate; a filter by size would compute the cells twice)
    r = r.select(
        "page_id", "row_pos", cell_text(F.get("cells", 0)).alias("_d"), cell_text(F.get("cells", 1)).alias("_r"))
    return parse_then_filter(r, {"date": parse_rate_date("_d"), "usd_lkr": parse_rate("_r")},
                             keep=["page_id", "row_pos"])


def keyword_hit(text: Column, keywords: Sequence[str]) -> Column:
    """Whether a text holds one of the keywords, in any case; the text is computed once."""
    if not keywords:
        return F.lit(False)
    return F.rlike(F.lower(text), F.lit("|".join(re.escape(kw) for kw in keywords)))


def price_table(pages: DataFrame, keywords: Sequence[str] = FUEL_TABLE_KEYWORDS, source: str = "scrape",
                date_col_excluded: bool = False) -> DataFrame:
    """Wide price table -> long records (page_id, row_pos, col_pos, period, fuel_type, price_lkr, source, _pos).

    Per page: the first table whose text contains a keyword is chosen; its first
    row maps column index -> category (``map_category``); each later row gives
    the period from cell 0 and one record per mapped column present in the row
    with a parseable price.  The column map is an array carried with each row and
    looked up by cell index (the distributed form of the reference's dict
    lookup), so the whole unpivot is row-local: two explodes, no join."""
    # The explodes are outer ones (their null rows are filtered after): for an inner one Spark filters by the array's size, below
    # the projection that computes it, and so computes it twice.  Per-page columns are projected before the explode: expressions written next to a
    # generator are evaluated after it (once per generated row), which would redo the
    # table search and the header map for every table row.
    target = F.get(F.filter(tables(F.col("html")), lambda t: keyword_hit(spaced_text(t["html"]), keywords)), 0)
    per_page = pages.select("page_id", target["rows"].alias("_rows"))
    heads = F.transform(_cells(F.get("_rows", 0), ("th", "td")), lambda c: F.element_at(F.transform(F.array(c), lambda x: map_category(x)), 1))
    if date_col_excluded:
        heads = F.transform(heads, lambda h, i: F.when(i > 0, h))
    per_page = per_page.select("page_id", heads.alias("_heads"), "_rows")
    x = per_page.select("page_id", "_heads", F.posexplode_outer("_rows").alias("row_pos", "row_html"))
    x = x.where(F.col("row_pos") >= 1).select(
        "page_id", "_heads", "row_pos", _raw_cells(F.col("row_html"), ("th", "td")).alias("cells"))
    x = x.select("*", cell_text(F.get("cells", 0)).alias("_d"))
    x = parse_then_filter(x, {"period": parse_period("_d")}, keep=["page_id", "_heads", "row_pos", "cells"])
    y = x.select("page_id", "row_pos", "period", "_heads", F.posexplode_outer("cells").alias("col_pos", "cell"))
    y = y.withColumn("fuel_type", F.get("_heads", F.col("col_pos"))).where(F.col("fuel_type").isNotNull())
    pos = F.struct(F.lit("").alias("file"), F.col("page_id").cast("long").alias("a"), F.col("row_pos").cast("long").alias("b"),
                   F.col("col_pos").cast("long").alias("c"))
    y = y.select("page_id", "row_pos", "col_pos", "period", "fuel_type", pos.alias("_pos"), cell_text("cell").alias("_c"))
    out = parse_then_filter(y, {"price_lkr": clean_price("_c")},
                            keep=["page_id", "row_pos", "col_pos", "period", "fuel_type", "_pos"])
    return out.select("page_id", "row_pos", "col_pos", "period", "fuel_type", "price_lkr",
                      F.lit(source).alias("source"), "_pos")
