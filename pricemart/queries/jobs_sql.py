"""DuckDB oracle SQL for the job queries."""

from pricemart.queries.jobs import dirty_feeds
from pricemart.queries.readers import price_cells, prices_csv_text
from pricemart.queries.readers_sql import _PAYLOAD, _rates_html, clean_price_sql, period_sql
from pricemart.queries.star_sql import MEAN, R

DK = "duck"


def _scrape_ranked() -> str:
    c = price_cells(DK)
    cols = [("p1", "LP_95", 1), ("p2", "LP_92", 2), ("p3", "AUTO_DIESEL", 3), ("p4", "FURNACE_800", 4)]
    parts = []
    for key, cat, col in cols:
        short = "" if key == "p1" else "WHERE o_orderkey % 7 <> 0"
        parts.append(f"SELECT o_orderkey, {col} AS col, {c['date']} AS d, '{cat}' AS fuel_type, {c[key]} AS p "
                     f"FROM orders {short}")
    u = " UNION ALL ".join(parts)
    return f"""SELECT {period_sql('d')} AS period, fuel_type, {clean_price_sql('p')} AS price_lkr, 'scrape' AS source,
       0 AS prio, 0 AS lay, o_orderkey AS k, col FROM ({u}) raw
WHERE {period_sql('d')} IS NOT NULL AND {clean_price_sql('p')} IS NOT NULL"""


def _csv_ranked() -> str:
    parts = []
    for lay, cols in prices_csv_text(DK).items():
        named = {n.lstrip("﻿"): e for e, n in cols}
        d = named.get("period") or named.get("Date") or named.get("date")
        f = named.get("fuel_type") or named.get("Fuel Type") or named.get("fuel")
        p = named.get("price_lkr") or named.get("Price LKR") or named.get("price")
        parts.append(f"SELECT o_orderkey, {lay} AS lay, trim({d}) AS d, trim({f}) AS f, trim({p}) AS p FROM orders "
                     f"WHERE o_orderkey % 3 = {lay}")
    u = " UNION ALL ".join(parts)
    return f"""SELECT {period_sql('d')} AS period, upper(replace(f, ' ', '_')) AS fuel_type,
       {clean_price_sql('p')} AS price_lkr, 'history_csv' AS source, 1 AS prio, lay, o_orderkey AS k, 0 AS col
FROM ({u}) raw
WHERE d <> '' AND f <> '' AND p <> '' AND {period_sql('d')} IS NOT NULL AND {clean_price_sql('p')} IS NOT NULL"""


MERGED_PRICES = f"""
merged AS (
  SELECT period, fuel_type, price_lkr, source FROM (
    SELECT *, row_number() OVER (PARTITION BY period, fuel_type ORDER BY prio, lay, k, col) AS rn
    FROM ({_scrape_ranked()} UNION ALL {_csv_ranked()})) WHERE rn = 1)"""

_RATES_DAILY_HTML = _rates_html(False)

ETL = f"""
WITH {MERGED_PRICES.strip()},
bench AS (
  SELECT CAST(strptime(strftime(l_shipdate, '%Y-%m'), '%Y-%m') AS DATE) AS period,
         {MEAN('l_extendedprice / 1000', 4)} AS brent_usd_per_barrel
  FROM lineitem GROUP BY 1),
bench_ok AS (SELECT * FROM bench WHERE brent_usd_per_barrel > 0 AND brent_usd_per_barrel < 300),
rates AS (
  SELECT CAST(strptime(strftime(l_shipdate, '%Y-%m'), '%Y-%m') AS DATE) AS period,
         {MEAN('l_quantity', 4)} AS usd_lkr_rate
  FROM lineitem WHERE l_quantity <> 0 GROUP BY 1),
prices AS (
  SELECT CAST(try_strptime(period, '%Y-%m') AS DATE) AS period, upper(trim(fuel_type)) AS fuel_type, price_lkr
  FROM merged WHERE price_lkr > 0 AND price_lkr < 1500 AND try_strptime(period, '%Y-%m') IS NOT NULL),
fx AS (
  SELECT p.period, p.fuel_type, p.price_lkr, r.usd_lkr_rate,
         {R('p.price_lkr / NULLIF(r.usd_lkr_rate, 0)', 4)} AS price_usd
  FROM prices p LEFT JOIN rates r ON p.period = r.period),
fact AS (
  SELECT f.*, b.brent_usd_per_barrel,
         {R('(b.brent_usd_per_barrel / 159.0) / NULLIF(f.price_usd, 0) * 100', 2)} AS crude_cost_pct
  FROM fx f LEFT JOIN bench_ok b ON f.period = b.period)
SELECT row_number() OVER (ORDER BY period, fuel_type) AS fact_id, period, fuel_type,
       TRY_CAST(CAST(price_lkr AS VARCHAR) AS DECIMAL(10,2)) AS price_lkr,
       TRY_CAST(CAST(price_usd AS VARCHAR) AS DECIMAL(10,4)) AS price_usd,
       TRY_CAST(CAST(usd_lkr_rate AS VARCHAR) AS DECIMAL(10,4)) AS usd_lkr_rate,
       TRY_CAST(CAST(brent_usd_per_barrel AS VARCHAR) AS DECIMAL(8,2)) AS brent_usd_per_barrel,
       TRY_CAST(CAST(crude_cost_pct AS VARCHAR) AS DECIMAL(5,2)) AS crude_cost_pct
FROM fact"""

_DIRTY = dirty_feeds(DK)
DIRTY = f"""
WITH b0 AS ({_DIRTY['benchmark']}), r0 AS ({_DIRTY['rates']}), p0 AS ({_DIRTY['prices']}),
b1 AS (SELECT DISTINCT ON (period) * FROM b0 ORDER BY period, _pos),
r1 AS (SELECT DISTINCT ON (period) * FROM r0 ORDER BY period, _pos),
p1 AS (SELECT DISTINCT ON (period, fuel_type) * FROM p0 ORDER BY period, fuel_type, _pos),
u AS (SELECT 'benchmark' AS feed, period, NULL AS label, value, _pos, value > 0 AND value < 300 AS fits FROM b1
      UNION ALL SELECT 'rates', period, NULL, usd_lkr_avg, _pos, TRUE FROM r1
      UNION ALL SELECT 'prices', period, fuel_type, price_lkr, _pos, price_lkr > 0 AND price_lkr < 1500 FROM p1),
c AS (SELECT *, CASE WHEN value IS NULL THEN 'missing value' WHEN NOT fits THEN 'out of range'
                     WHEN period LIKE '%-13' THEN 'impossible month' END AS reason FROM u),
bench AS (SELECT CAST(strptime(period, '%Y-%m') AS DATE) AS period, value AS brent FROM c WHERE feed = 'benchmark' AND reason IS NULL),
rates AS (SELECT CAST(strptime(period, '%Y-%m') AS DATE) AS period, value AS rate FROM c WHERE feed = 'rates' AND reason IS NULL),
fx AS (SELECT CAST(strptime(period, '%Y-%m') AS DATE) AS period, upper(trim(label)) AS fuel_type, value AS price_lkr
       FROM c WHERE feed = 'prices' AND reason IS NULL),
usd AS (SELECT fx.*, rate, {R('price_lkr / NULLIF(rate, 0)', 4)} AS price_usd FROM fx LEFT JOIN rates USING (period)),
fact AS (SELECT usd.*, brent, {R('(brent / 159.0) / NULLIF(price_usd, 0) * 100', 2)} AS share FROM usd LEFT JOIN bench USING (period))
"""


def D(x: str, p: int, k: int) -> str:
    return f"TRY_CAST(CAST({x} AS VARCHAR) AS DECIMAL({p},{k}))"


SQL = {
    "etl_balance": DIRTY + """
SELECT feed, rows_in, rows_in - count(*) AS duplicates, count(reason) AS quarantined, 0::BIGINT AS rejected, count(*) - count(reason) AS loaded
FROM c JOIN (SELECT 'benchmark' AS feed, count(*) AS rows_in FROM b0 UNION ALL SELECT 'rates', count(*) FROM r0
             UNION ALL SELECT 'prices', count(*) FROM p0) USING (feed) GROUP BY feed, rows_in""",
    "etl_quarantine": DIRTY + f"""
SELECT feed, period AS period_text, label, upper(trim(label)) AS fuel_type, value, '2001-08-02' AS fetched_at, CAST(_pos AS VARCHAR) AS position, reason
FROM c WHERE reason IS NOT NULL""",
    "etl_summary": DIRTY + f"""
SELECT CAST(year(period) AS SMALLINT) AS year, CAST(month(period) AS SMALLINT) AS month, fuel_type,
       {D(MEAN('price_lkr', 2), 10, 2)} AS avg_price_lkr, {D(MEAN('brent', 2), 8, 2)} AS avg_brent_usd,
       {D(MEAN('rate', 4), 10, 4)} AS avg_usd_lkr, CAST(count(*) AS INTEGER) AS record_count
FROM fact GROUP BY 1, 2, 3""",
    "etl_view": DIRTY + f""",
f AS (SELECT period, fuel_type, {D('price_lkr', 10, 2)} AS price_lkr, {D('price_usd', 10, 4)} AS price_usd, {D('brent', 8, 2)} AS brent_usd_per_barrel,
             {D('rate', 10, 4)} AS usd_lkr_rate, {D('share', 5, 2)} AS crude_cost_pct FROM fact),
l AS (SELECT *, lag(price_lkr) OVER (PARTITION BY fuel_type ORDER BY period) AS prev_month_price_lkr FROM f)
SELECT period, CAST(year(period) AS SMALLINT) AS year, CAST(quarter(period) AS SMALLINT) AS quarter, strftime(period, '%b') AS month_name,
       year(period) = 1998 AS is_crisis_period, fuel_type, substr(fuel_type, 3) AS fuel_category, price_lkr, price_usd, brent_usd_per_barrel,
       usd_lkr_rate, crude_cost_pct, prev_month_price_lkr,
       CAST(round((price_lkr - prev_month_price_lkr)::DECIMAL(18,2) * 100 / NULLIF(prev_month_price_lkr, 0), 2) AS DOUBLE) AS mom_price_change_pct
FROM l""",
    "append_load": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "fact_month": DIRTY + f"""
SELECT period, fuel_type, {D('price_lkr', 10, 2)} AS price_lkr, TRUE AS most_files_skipped FROM fact WHERE period = DATE '1996-03-01'""",
    "append_once": """
SELECT row_number() OVER (ORDER BY CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey) AS fact_id, o_orderkey, o_orderstatus
FROM orders""",
    "refresh_load": """
SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, 'after a whole load' AS step FROM orders GROUP BY 1
UNION ALL SELECT o_orderstatus, count(*), CAST(sum(o_orderkey) AS BIGINT), 'after a broken load' FROM orders WHERE o_orderstatus = 'F' GROUP BY 1""",
    "conform_rejects": """
WITH o AS (SELECT CASE WHEN o_orderkey % 10 <> 0 THEN o_custkey END AS k, o_orderpriority AS label FROM orders),
f AS (SELECT *, CASE WHEN k IS NULL THEN 'null in NOT NULL column: k' WHEN length(label) > 12 THEN 'text too long: label' END AS reason FROM o)
SELECT reason, count(*) AS n FROM f WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT 'loaded', count(DISTINCT k) FROM f WHERE reason IS NULL
UNION ALL SELECT 'duplicate primary key', count(*) - count(DISTINCT k) FROM f WHERE reason IS NULL""",
    "ingest_benchmark": _PAYLOAD + """
SELECT period, value, source FROM rec
WHERE length(period) = 7 AND substr(period, 5, 1) = '-' AND value > 0 AND value < 300""",
    "ingest_rates": f"""
WITH daily AS ({_RATES_DAILY_HTML})
SELECT strftime(date, '%Y-%m') AS period, {MEAN('usd_lkr', 4)} AS usd_lkr_avg, COUNT(usd_lkr) AS sample_count
FROM daily WHERE NOT EXISTS (SELECT 1 FROM pages WHERE regexp_matches(lower(html), '<table'))
GROUP BY 1""",
    "ingest_prices": f"WITH {MERGED_PRICES.strip()}\nSELECT * FROM merged",
    "etl_job": ETL,
}
