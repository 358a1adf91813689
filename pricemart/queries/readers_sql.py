"""DuckDB oracle SQL for the reader queries, computed directly from the source tables."""

from pricemart.queries.readers import (
    LOOKBACK_AS_OF, RATE_CENTS, benchmark_csv_text, price_cells, prices_csv_text,
    rates_csv_text,
)
from pricemart.queries.render import dfmt, money

DK = "duck"


def clean_price_sql(x: str) -> str:
    t = f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
    k = f"regexp_replace({t}, '[^0-9.,]', '', 'g')"
    u = (f"(CASE WHEN contains({k}, ',') AND contains({k}, '.') THEN replace({k}, ',', '') "
         f"WHEN contains({k}, ',') THEN replace({k}, ',', '.') ELSE {k} END)")
    v = f"TRY_CAST(regexp_extract({u}, '^[^.]*(\\.[^.]*)?', 0) AS DOUBLE)"
    return (f"(CASE WHEN {t} IS NULL OR {t} IN ('-', 'N/A', 'n/a', '–', '—', '') THEN NULL "
            f"WHEN {v} > 0 AND {v} <= 1500 THEN {v} END)")


def rate_sql(x: str) -> str:
    v = f"TRY_CAST(trim(replace({x}, ',', '')) AS DOUBLE)"
    return f"(CASE WHEN {v} > 0 AND {v} <= 1000 THEN {v} END)"


def rate_date_sql(x: str) -> str:
    t = f"trim({x})"
    return ("CAST(COALESCE(" + ", ".join(f"try_strptime({t}, '{f}')" for f in
                                         ("%Y-%m-%d", "%d/%m/%Y", "%d-%m-%Y", "%d.%m.%Y", "%m/%d/%Y")) + ") AS DATE)")


def period_sql(x: str) -> str:
    t = f"trim({x})"
    fmts = ("%d.%m.%Y", "%d/%m/%Y", "%d-%m-%Y", "%Y-%m-%d", "%b-%Y", "%b %Y", "%B-%Y", "%B %Y", "%m/%Y")
    ym, dmy = "([0-9]{4})[./-]([0-9]{2})", "([0-9]{2})[./-]([0-9]{2})[./-]([0-9]{4})"
    tries = [f"strftime(try_strptime({t}, '{f}'), '%Y-%m')" for f in fmts]
    tries.append(f"CASE WHEN regexp_matches({t}, '{ym}') THEN regexp_extract({t}, '{ym}', 1) || '-' || "
                 f"regexp_extract({t}, '{ym}', 2) END")
    tries.append(f"CASE WHEN regexp_matches({t}, '{dmy}') THEN regexp_extract({t}, '{dmy}', 3) || '-' || "
                 f"regexp_extract({t}, '{dmy}', 2) END")
    return "COALESCE(" + ", ".join(tries) + ")"


def _nz(x: str) -> str:
    return f"NULLIF(trim({x}), '')"


def _bench_csv() -> str:
    parts = []
    for lay, cols in benchmark_csv_text(DK).items():
        (p, _), (v, _) = cols
        parts.append(f"SELECT {p} AS p, {v} AS v FROM lineitem WHERE l_linenumber % 4 = {lay}")
    u = " UNION ALL ".join(parts)
    per = ("CASE WHEN contains(p, '/') THEN (CASE WHEN len(string_split(p, '/')) >= 3 THEN "
           "string_split(p, '/')[3] || '-' || CASE WHEN length(string_split(p, '/')[1]) < 2 "
           "THEN lpad(string_split(p, '/')[1], 2, '0') ELSE string_split(p, '/')[1] END END) ELSE p END")
    return f"""
WITH raw AS ({u}), k AS (SELECT trim(p) AS p, trim(v) AS v FROM raw WHERE {_nz('p')} IS NOT NULL AND {_nz('v')} IS NOT NULL)
SELECT substr({per}, 1, 7) AS period, TRY_CAST(replace(v, ',', '') AS DOUBLE) AS value, 'backup_csv' AS source
FROM k WHERE substr({per}, 1, 7) IS NOT NULL AND TRY_CAST(replace(v, ',', '') AS DOUBLE) IS NOT NULL"""


def _rates_csv_body() -> str:
    c = rates_csv_text(DK)
    a = c[0]
    b = c[1]
    cc = c[2]
    return f"""
SELECT upper(trim({a[0][0]})) AS cur, {a[1][0]} AS d, {a[2][0]} AS r FROM lineitem WHERE l_linenumber % 3 = 0
UNION ALL SELECT 'USD', {b[0][0]}, {b[1][0]} FROM lineitem WHERE l_linenumber % 3 = 1
UNION ALL SELECT 'USD', {cc[0][0]}, COALESCE(NULLIF({cc[3][0]}, ''), NULLIF({cc[2][0]}, '')) FROM lineitem
  WHERE l_linenumber % 3 = 2"""


def _rates_csv() -> str:
    return f"""
WITH raw AS ({_rates_csv_body()})
SELECT {rate_date_sql('d')} AS date, {rate_sql('r')} AS usd_lkr FROM raw
WHERE cur IN ('', 'USD') AND {_nz('d')} IS NOT NULL AND {_nz('r')} IS NOT NULL
  AND {rate_date_sql('d')} IS NOT NULL AND {rate_sql('r')} IS NOT NULL"""


def _prices_csv() -> str:
    parts = []
    for lay, cols in prices_csv_text(DK).items():
        named = {n.lstrip("﻿"): e for e, n in cols}
        d = named.get("period") or named.get("Date") or named.get("date")
        f = named.get("fuel_type") or named.get("Fuel Type") or named.get("fuel")
        p = named.get("price_lkr") or named.get("Price LKR") or named.get("price")
        parts.append(f"SELECT {d} AS d, {f} AS f, {p} AS p FROM orders WHERE o_orderkey % 3 = {lay}")
    u = " UNION ALL ".join(parts)
    return f"""
WITH raw AS ({u}), k AS (SELECT trim(d) AS d, trim(f) AS f, trim(p) AS p FROM raw
  WHERE {_nz('d')} IS NOT NULL AND {_nz('f')} IS NOT NULL AND {_nz('p')} IS NOT NULL)
SELECT {period_sql('d')} AS period, upper(replace(f, ' ', '_')) AS fuel_type, {clean_price_sql('p')} AS price_lkr,
       'history_csv' AS source
FROM k WHERE {period_sql('d')} IS NOT NULL AND {clean_price_sql('p')} IS NOT NULL"""


def _rates_html(first_only: bool) -> str:
    d = (f"CASE l_linenumber % 3 WHEN 0 THEN {dfmt('l_shipdate', 'ymd', DK)} "
         f"WHEN 1 THEN {dfmt('l_shipdate', 'dmy_slash', DK)} ELSE {dfmt('l_shipdate', 'dmy_dot', DK)} END")
    r = money(RATE_CENTS, thousands=True)
    cond = "AND l_linenumber <= 3" if first_only else ""
    return f"""
WITH raw AS (SELECT CAST(floor(l_orderkey / 8) AS BIGINT) AS page_id, {d} AS d, {r} AS r FROM lineitem
             WHERE (l_orderkey + l_linenumber) % 11 <> 0 {cond})
SELECT page_id, {rate_date_sql('d')} AS date, {rate_sql('r')} AS usd_lkr FROM raw
WHERE {rate_date_sql('d')} IS NOT NULL AND {rate_sql('r')} IS NOT NULL"""


def _price_html() -> str:
    c = price_cells(DK)
    cols = [("p1", "LP_95"), ("p2", "LP_92"), ("p3", "AUTO_DIESEL"), ("p4", "FURNACE_800")]
    parts = []
    for key, cat in cols:
        short = "" if key == "p1" else "WHERE o_orderkey % 7 <> 0"
        parts.append(f"SELECT CAST(floor(o_orderkey / 16) AS BIGINT) AS page_id, {c['date']} AS d, '{cat}' AS fuel_type, "
                     f"{c[key]} AS p FROM orders {short}")
    u = " UNION ALL ".join(parts)
    return f"""
WITH raw AS ({u})
SELECT page_id, {period_sql('d')} AS period, fuel_type, {clean_price_sql('p')} AS price_lkr, 'scrape' AS source
FROM raw WHERE {period_sql('d')} IS NOT NULL AND {clean_price_sql('p')} IS NOT NULL"""


_PAYLOAD = """
WITH it AS (
  SELECT CAST(floor(l_orderkey / 16) AS BIGINT) AS doc_id,
         CASE WHEN (l_orderkey * 8 + l_linenumber) % 10 = 1 THEN '' ELSE strftime(l_shipdate, '%Y-%m') END AS period,
         CASE WHEN (l_orderkey * 8 + l_linenumber) % 10 IN (0, 2) THEN NULL ELSE l_extendedprice / 1000 END AS value
  FROM lineitem),
rec AS (SELECT period, value, 'api' AS source FROM it
        WHERE period <> '' AND value IS NOT NULL)"""

SQL = {
    "scan_envelope": "SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS fetched_at FROM events",
    "scan_envelope_feeds": """
SELECT 'benchmark' AS feed, strftime(l_shipdate, '%Y-%m') AS period, 'a "quoted" }{ source' AS label, l_extendedprice / 1000 AS value,
       CASE WHEN (l_orderkey * 8 + l_linenumber) % 2 = 0 THEN DATE '2001-08-02' ELSE DATE '2001-08-03' END AS fetched_at FROM lineitem
UNION ALL SELECT 'rates', strftime(o_orderdate, '%Y-%m'), CAST(o_orderkey % 30 AS VARCHAR), o_totalprice / 1000,
       CASE WHEN o_orderkey % 2 = 0 THEN DATE '2001-08-02' ELSE DATE '2001-08-03' END FROM orders
UNION ALL SELECT 'prices', strftime(o_orderdate, '%Y-%m'), o_orderpriority, o_totalprice / 200,
       CASE WHEN o_orderkey % 2 = 0 THEN DATE '2001-08-02' ELSE DATE '2001-08-03' END FROM orders""",
    "snapshot_latest": """
SELECT period, fuel_type, price_lkr, fetched_at FROM (
  SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS fuel_type, o_totalprice / 200 AS price_lkr,
         CAST(CASE o_orderstatus WHEN 'F' THEN '2001-08-02' WHEN 'O' THEN '2001-08-03' ELSE '2001-08-04' END AS DATE)
           AS fetched_at,
         row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m'), o_orderpriority
           ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END DESC, o_orderkey) AS rn
  FROM orders) WHERE rn = 1""",
    "api_payload_records": _PAYLOAD + "\nSELECT * FROM rec",
    "json_path": """
WITH d AS (SELECT CAST(floor(l_orderkey / 16) AS BIGINT) AS doc_id FROM lineitem)
SELECT doc_id, COUNT(*) AS n_items FROM d GROUP BY doc_id
UNION ALL SELECT DISTINCT -1 - doc_id, 0 FROM d WHERE doc_id % 5 = 0""",
    "page_sorted": _PAYLOAD + "\nSELECT * FROM rec ORDER BY period, value, source LIMIT 5000 OFFSET 0",
    "csv_alias_benchmark": _bench_csv(),
    "csv_alias_rates": _rates_csv(),
    "csv_alias_prices": _prices_csv(),
    "html_first_table": _rates_html(True),
    "html_all_tables": _rates_html(False),
    "html_price_table": _price_html(),
    "source_cascade": _rates_csv().replace(
        "WHERE cur IN ('', 'USD')",
        "WHERE NOT EXISTS (SELECT 1 FROM pages WHERE regexp_matches(lower(html), '<table')) AND cur IN ('', 'USD')"),
    "lookback_filter": f"""
SELECT o_orderkey, o_orderdate, o_totalprice FROM orders
WHERE o_orderdate >= DATE '{LOOKBACK_AS_OF}' - INTERVAL 730 DAY AND o_orderdate < DATE '{LOOKBACK_AS_OF}' + INTERVAL 1 DAY""",
}
SQL["snapshot_latest_stream"] = SQL["snapshot_latest"]
SQL["insert_if_empty"] = "SELECT *, 'empty_target' AS tgt FROM (" + __import__(
    "pricemart.queries.star_sql", fromlist=["STAR_SQL"]).STAR_SQL["dim_date"] + ")"
