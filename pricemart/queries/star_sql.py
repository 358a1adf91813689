"""DuckDB oracle SQL for the star queries (written independently of the Spark code)."""


def R(x: str, k: int) -> str:
    """HALF_UP rounding of the shortest decimal text of a double."""
    return f"CAST(TRY_CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,{k})) AS DOUBLE)"


def MEAN(x: str, k: int) -> str:
    """Mean rounded to ``k`` places, HALF_UP, in whole numbers of 10^-16, read from the values' texts (values of 0 or more)."""
    n, unit = f"COUNT({x})::HUGEINT", 10 ** 16
    units = f"replace(CAST(CAST(CAST(({x})::DOUBLE AS VARCHAR) AS DECIMAL(38,16)) AS VARCHAR), '.', '')"
    total = f"SUM(CAST({units} AS HUGEINT))::HUGEINT"
    return f"(CAST((2 * {total} * {10 ** k} + {n} * {unit}) // NULLIF(2 * {n} * {unit}, 0) AS DOUBLE) / {10 ** k})"


BASE = f"""
bench_raw AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS period, l_extendedprice / 1000 AS brent_usd_per_barrel,
         CAST(l_shipdate AS DATE) AS fetched_at, l_orderkey, l_partkey, l_suppkey, l_linenumber
  FROM lineitem),
bench_dedup AS (
  SELECT period, brent_usd_per_barrel, fetched_at FROM (
    SELECT *, row_number() OVER (PARTITION BY period ORDER BY fetched_at DESC NULLS LAST,
                                 l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rn
    FROM bench_raw) WHERE rn = 1),
bench AS (
  SELECT CAST(try_strptime(period, '%Y-%m') AS DATE) AS period, brent_usd_per_barrel FROM bench_dedup
  WHERE period IS NOT NULL AND brent_usd_per_barrel IS NOT NULL
    AND brent_usd_per_barrel > 0 AND brent_usd_per_barrel < 300),
rates_daily AS (SELECT strftime(l_shipdate, '%Y-%m-%d') AS date, l_quantity AS usd_lkr FROM lineitem),
rates_monthly AS (
  SELECT substr(date, 1, 7) AS period, {MEAN('usd_lkr', 4)} AS usd_lkr_avg, COUNT(usd_lkr) AS sample_count
  FROM rates_daily WHERE length(date) >= 7 AND usd_lkr IS NOT NULL AND usd_lkr <> 0 AND NOT isnan(usd_lkr)
  GROUP BY 1),
rates AS (
  SELECT CAST(try_strptime(period, '%Y-%m') AS DATE) AS period, usd_lkr_avg AS usd_lkr_rate FROM rates_monthly
  WHERE period IS NOT NULL AND usd_lkr_avg IS NOT NULL),
price_raw AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS fuel_type, o_totalprice / 200 AS price_lkr,
         o_orderstatus AS source, CAST(o_orderdate AS DATE) AS fetched_at, o_orderkey AS _pos
  FROM orders),
price_dedup AS (
  SELECT period, fuel_type, price_lkr, source, fetched_at FROM (
    SELECT *, row_number() OVER (PARTITION BY period, fuel_type ORDER BY fetched_at DESC NULLS LAST, _pos) AS rn
    FROM price_raw) WHERE rn = 1),
prices AS (
  SELECT CAST(try_strptime(period, '%Y-%m') AS DATE) AS period, upper(trim(fuel_type)) AS fuel_type, price_lkr
  FROM price_dedup
  WHERE period IS NOT NULL AND fuel_type IS NOT NULL AND price_lkr IS NOT NULL
    AND price_lkr > 0 AND price_lkr < 1500 AND try_strptime(period, '%Y-%m') IS NOT NULL),
with_fx AS (
  SELECT p.period, p.fuel_type, p.price_lkr, r.usd_lkr_rate,
         {R('p.price_lkr / NULLIF(r.usd_lkr_rate, 0)', 4)} AS price_usd
  FROM prices p LEFT JOIN rates r ON p.period = r.period),
fact AS (
  SELECT f.period, f.fuel_type, f.price_lkr, f.price_usd, f.usd_lkr_rate, b.brent_usd_per_barrel,
         {R('(b.brent_usd_per_barrel / 159.0) / NULLIF(f.price_usd, 0) * 100', 2)} AS crude_cost_pct
  FROM with_fx f LEFT JOIN bench b ON f.period = b.period),
summary AS (
  SELECT strftime(period, '%Y') AS year, strftime(period, '%m') AS month, fuel_type,
         {MEAN('price_lkr', 2)} AS avg_price_lkr, {MEAN('brent_usd_per_barrel', 2)} AS avg_brent_usd,
         {MEAN('usd_lkr_rate', 4)} AS avg_usd_lkr, COUNT(*) AS record_count
  FROM fact GROUP BY 1, 2, 3),
dd AS (
  SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
         CAST(month(d) AS SMALLINT) AS month, strftime(d, '%b') AS month_name,
         (CAST(d AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AS is_crisis_period
  FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH) t(d)),
cat AS (
  SELECT * FROM (VALUES ('1-URGENT', 'URGENT', 'priority 1'), ('2-HIGH', 'HIGH', 'priority 2'),
    ('3-MEDIUM', 'MEDIUM', 'priority 3'), ('4-NOT SPECIFIED', 'NOT SPECIFIED', 'priority 4'),
    ('5-LOW', 'LOW', 'priority 5')) v(fuel_type_key, fuel_category, description)),
lagged AS (
  SELECT f.*, LAG(f.price_lkr) OVER (PARTITION BY f.fuel_type ORDER BY f.period) AS prev_month_price_lkr FROM fact f),
vw AS (
  SELECT f.period, d.year, d.quarter, d.month_name, d.is_crisis_period, f.fuel_type, c.fuel_category,
         f.price_lkr, f.price_usd, f.brent_usd_per_barrel, f.usd_lkr_rate, f.crude_cost_pct, f.prev_month_price_lkr,
         {R('(f.price_lkr - f.prev_month_price_lkr) / NULLIF(f.prev_month_price_lkr, 0) * 100', 2)} AS mom_price_change_pct
  FROM lagged f JOIN dd d ON f.period = d.date_key JOIN cat c ON f.fuel_type = c.fuel_type_key),
records AS (SELECT period, price_lkr AS value, _pos FROM price_raw),
records_flag AS (
  SELECT *, COALESCE(length(period) = 7 AND substr(period, 5, 1) = '-' AND value IS NOT NULL
                     AND value > 0 AND value < 300 AND NOT isnan(value), FALSE) AS ok FROM records),
events_gaps AS (
  SELECT event_id, user_id, ts, CASE WHEN event_id % 3 <> 0 THEN value END AS value FROM events),
dense AS (
  SELECT s.fuel_type, CAST(g.m AS DATE) AS period
  FROM (SELECT fuel_type, min(period) AS lo, max(period) AS hi FROM prices GROUP BY fuel_type) s,
       LATERAL (SELECT unnest(generate_series(CAST(s.lo AS TIMESTAMP), CAST(s.hi AS TIMESTAMP), INTERVAL 1 MONTH)) AS m) g)
"""


def q(body: str) -> str:
    return f"WITH {BASE}\n{body}"


STAR_SQL = {
    "fact_prices": q("SELECT * FROM fact"),
    "monthly_summary": q("SELECT * FROM summary"),
    "dim_benchmark": q("SELECT * FROM bench"),
    "dim_rates": q("SELECT * FROM rates"),
    "normalise_currency": q("SELECT period, fuel_type, price_lkr, usd_lkr_rate, price_usd FROM with_fx"),
    "cost_share_pct": q("SELECT period, fuel_type, price_usd, brent_usd_per_barrel, crude_cost_pct FROM fact"),
    "inner_three_way": q("""SELECT b.period, b.brent_usd_per_barrel, r.usd_lkr_rate, p.fuel_type, p.price_lkr,
        p.price_lkr / NULLIF(r.usd_lkr_rate, 0) AS price_usd
        FROM bench b JOIN rates r ON b.period = r.period JOIN prices p ON b.period = p.period"""),
    "dedupe_single_key": q("SELECT period, brent_usd_per_barrel, fetched_at FROM bench_dedup"),
    "dedupe_composite_key": q("SELECT period, fuel_type, price_lkr, source, fetched_at FROM price_dedup"),
    "resample_monthly": q("SELECT * FROM rates_monthly"),
    "lag_previous": q("SELECT period, fuel_type, price_lkr, prev_month_price_lkr FROM lagged"),
    "mom_change_pct": q(f"""SELECT period, fuel_type, price_lkr, prev_month_price_lkr,
        {R('(price_lkr - prev_month_price_lkr) / NULLIF(prev_month_price_lkr, 0) * 100', 2)} AS mom_price_change_pct
        FROM lagged"""),
    "calendar_mom": q(f"""SELECT f.period, f.fuel_type, f.price_lkr, p.price_lkr AS prev_month_price_lkr,
        {R('(f.price_lkr - p.price_lkr) / NULLIF(p.price_lkr, 0) * 100', 2)} AS mom_price_change_pct
        FROM fact f LEFT JOIN fact p ON p.fuel_type = f.fuel_type
             AND p.period = CAST(f.period - INTERVAL 1 MONTH AS DATE)"""),
    "view_price_vs_benchmark": q("SELECT * FROM vw"),
    "latest_top20": q("SELECT * FROM vw ORDER BY period DESC, fuel_type ASC LIMIT 20"),
    "dim_date": """
        WITH span AS (SELECT date_trunc('month', min(o_orderdate)) AS lo, date_trunc('month', max(o_orderdate)) AS hi
                      FROM orders),
        g AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS d FROM span)
        SELECT CAST(d AS DATE) AS date_key, CAST(year(d) AS SMALLINT) AS year, CAST(quarter(d) AS SMALLINT) AS quarter,
               CAST(month(d) AS SMALLINT) AS month, strftime(d, '%b') AS month_name,
               (CAST(d AS DATE) BETWEEN DATE '1998-01-01' AND DATE '1998-12-31') AS is_crisis_period
        FROM g""",
    "surrogate_key": q("SELECT row_number() OVER (ORDER BY period, fuel_type) AS fact_id, * FROM fact"),
    "conform_schema": q("""SELECT CAST(year AS SMALLINT) AS year, CAST(month AS SMALLINT) AS month, fuel_type,
        CAST(avg_price_lkr AS DECIMAL(10,2)) AS avg_price_lkr, CAST(avg_brent_usd AS DECIMAL(8,2)) AS avg_brent_usd,
        CAST(avg_usd_lkr AS DECIMAL(10,4)) AS avg_usd_lkr, CAST(record_count AS INTEGER) AS record_count
        FROM summary"""),
    "row_counts": q("""SELECT 'dim_benchmark' AS tbl, COUNT(*) AS rows FROM bench
        UNION ALL SELECT 'dim_rates', COUNT(*) FROM rates
        UNION ALL SELECT 'fact_prices', COUNT(*) FROM fact
        UNION ALL SELECT 'monthly_summary', COUNT(*) FROM summary"""),
    "unmatched_keys": q("""SELECT f.* FROM fact f WHERE NOT EXISTS (
        SELECT 1 FROM cat c WHERE c.fuel_type_key = f.fuel_type AND c.fuel_type_key <> '5-LOW')"""),
    "range_filter": q("SELECT * FROM price_raw WHERE price_lkr > 0 AND price_lkr < 1500 AND NOT isnan(price_lkr)"),
    "validate_records": q("SELECT period, value, _pos FROM records_flag WHERE ok"),
    "quality_counts": q("""SELECT COUNT(*) FILTER (WHERE ok) AS kept, COUNT(*) FILTER (WHERE NOT ok) AS removed
        FROM records_flag"""),
    "priority_merge": q("""SELECT period, fuel_type, price_lkr, source FROM (
        SELECT *, row_number() OVER (PARTITION BY period, fuel_type ORDER BY prio, _pos) AS rn FROM (
          SELECT period, fuel_type, price_lkr, CASE WHEN source = 'F' THEN 'scrape' ELSE 'history_csv' END AS source,
                 CASE WHEN source = 'F' THEN 0 ELSE 1 END AS prio, _pos FROM price_raw)) WHERE rn = 1"""),
    "forward_fill": q("""SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
        FROM events_gaps"""),
    "forward_fill_global": q("""SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (
        ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value FROM events_gaps"""),
    "forward_fill_range": q("""SELECT event_id, user_id, ts, last_value(value IGNORE NULLS) OVER (
        PARTITION BY user_id ORDER BY ts RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS value
        FROM events_gaps"""),
    "calendar_fill": q("""SELECT d.period, d.fuel_type, last_value(p.price_lkr IGNORE NULLS) OVER (
        PARTITION BY d.fuel_type ORDER BY d.period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price_lkr
        FROM dense d LEFT JOIN prices p ON p.fuel_type = d.fuel_type AND p.period = d.period"""),
}
