"""DuckDB oracle SQL for the cleaning queries (independent SQL formulations)."""

from pricemart.queries.cleaning import HEADER_TEXT, LABEL_TEXT, PERIOD_TEXT, PRICE_TEXT, RATE_TEXT

_CLEAN = """
  CASE WHEN t IS NULL OR t IN ('-', 'N/A', 'n/a', '–', '—', '') THEN NULL
       WHEN v > 0 AND v <= 1500 THEN v END"""


def _clean_price_sql(src: str, text_col: str, keep: str) -> str:
    return f"""
WITH s0 AS (SELECT {keep}, {text_col} AS raw, regexp_replace({text_col}, '^\\s+|\\s+$', '', 'g') AS t FROM {src}),
s1 AS (SELECT *, regexp_replace(t, '[^0-9.,]', '', 'g') AS k FROM s0),
s2 AS (SELECT *, CASE WHEN contains(k, ',') AND contains(k, '.') THEN replace(k, ',', '')
                      WHEN contains(k, ',') THEN replace(k, ',', '.') ELSE k END AS u FROM s1),
s3 AS (SELECT *, TRY_CAST(CASE WHEN len(string_split(u, '.')) > 2
                               THEN string_split(u, '.')[1] || '.' || string_split(u, '.')[2] ELSE u END AS DOUBLE) AS v
       FROM s2)
SELECT {keep}, raw, {_CLEAN} AS price_lkr FROM s3"""


_PERIOD_SHAPES = """CASE o_orderkey % 12
  WHEN 0 THEN strftime(o_orderdate, '%d.%m.%Y') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
  WHEN 2 THEN strftime(o_orderdate, '%d-%m-%Y') WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
  WHEN 4 THEN lower(strftime(o_orderdate, '%b-%Y')) WHEN 5 THEN strftime(o_orderdate, '%b %Y')
  WHEN 6 THEN strftime(o_orderdate, '%B %Y') WHEN 7 THEN strftime(o_orderdate, '%m/%Y')
  WHEN 8 THEN 'Updated ' || strftime(o_orderdate, '%d.%m.%Y') WHEN 9 THEN strftime(o_orderdate, '%Y.%m')
  WHEN 10 THEN strftime(o_orderdate, '%-d.%-m.%Y') ELSE strftime(o_orderdate, '%m/%d/%Y') END"""

_RATE_DATE_SHAPES = """CASE (l_orderkey * 8 + l_linenumber) % 6
  WHEN 0 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 1 THEN strftime(l_shipdate, '%d/%m/%Y')
  WHEN 2 THEN strftime(l_shipdate, '%d-%m-%Y') WHEN 3 THEN strftime(l_shipdate, '%d.%m.%Y')
  WHEN 4 THEN strftime(l_shipdate, '%m/%d/%Y') ELSE strftime(l_shipdate, '%Y/%m/%d') END"""

_YM = "([0-9]{4})[./-]([0-9]{2})"
_DMY = "([0-9]{2})[./-]([0-9]{2})[./-]([0-9]{4})"

SQL = {
    "clean_price": f"""
WITH src AS (SELECT o_orderkey, {PRICE_TEXT} AS price_text FROM orders)
SELECT o_orderkey, raw AS price_text, price_lkr FROM ({_clean_price_sql('src', 'price_text', 'o_orderkey')})""",
    "parse_period": f"""
WITH src AS (SELECT o_orderkey, {_PERIOD_SHAPES} AS date_text FROM orders),
s AS (SELECT *, trim(date_text) AS t FROM src)
SELECT o_orderkey, date_text, COALESCE(
  strftime(try_strptime(t, '%d.%m.%Y'), '%Y-%m'), strftime(try_strptime(t, '%d/%m/%Y'), '%Y-%m'),
  strftime(try_strptime(t, '%d-%m-%Y'), '%Y-%m'), strftime(try_strptime(t, '%Y-%m-%d'), '%Y-%m'),
  strftime(try_strptime(t, '%b-%Y'), '%Y-%m'), strftime(try_strptime(t, '%b %Y'), '%Y-%m'),
  strftime(try_strptime(t, '%B-%Y'), '%Y-%m'), strftime(try_strptime(t, '%B %Y'), '%Y-%m'),
  strftime(try_strptime(t, '%m/%Y'), '%Y-%m'),
  CASE WHEN regexp_matches(t, '{_YM}') THEN regexp_extract(t, '{_YM}', 1) || '-' || regexp_extract(t, '{_YM}', 2) END,
  CASE WHEN regexp_matches(t, '{_DMY}') THEN regexp_extract(t, '{_DMY}', 3) || '-' || regexp_extract(t, '{_DMY}', 2) END
) AS period FROM s""",
    "parse_daily_rate": f"""
WITH src AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_RATE_DATE_SHAPES} AS raw_date,
                    {RATE_TEXT} AS raw_rate FROM lineitem),
p AS (SELECT *, CAST(COALESCE(try_strptime(trim(raw_date), '%Y-%m-%d'), try_strptime(trim(raw_date), '%d/%m/%Y'),
                               try_strptime(trim(raw_date), '%d-%m-%Y'), try_strptime(trim(raw_date), '%d.%m.%Y'),
                               try_strptime(trim(raw_date), '%m/%d/%Y')) AS DATE) AS date,
             TRY_CAST(trim(replace(raw_rate, ',', '')) AS DOUBLE) AS r FROM src)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, raw_date, raw_rate, date, r AS usd_lkr FROM p
WHERE date IS NOT NULL AND r > 0 AND r <= 1000""",
    "map_category": f"""
WITH src AS (SELECT p_partkey, {HEADER_TEXT} AS header FROM part),
s AS (SELECT *, lower(trim(header)) AS h FROM src)
SELECT p_partkey, header, CASE
  WHEN contains(h, 'date') OR h = '' THEN NULL
  WHEN contains(h, 'lp 95') THEN 'LP_95' WHEN contains(h, 'lp 92') THEN 'LP_92'
  WHEN contains(h, 'lad') THEN 'AUTO_DIESEL' WHEN contains(h, 'lsd') THEN 'SUPER_DIESEL'
  WHEN contains(h, ' lk') THEN 'KEROSENE' WHEN contains(h, 'lk') THEN 'KEROSENE'
  WHEN contains(h, 'lik') THEN 'ILO_KEROSENE' WHEN contains(h, 'fur. 800') THEN 'FURNACE_800'
  WHEN contains(h, 'fur 800') THEN 'FURNACE_800' WHEN contains(h, 'fur. 1500') THEN 'FURNACE_1500'
  WHEN contains(h, 'fur 1500') THEN 'FURNACE_1500'
  ELSE upper(replace(trim(header), ' ', '_')) END AS category FROM s""",
    "standardise_label": f"""
SELECT o_orderkey, label, upper(trim(label)) AS fuel_type FROM (SELECT o_orderkey, {LABEL_TEXT} AS label FROM orders)""",
    "period_to_date": f"""
SELECT o_orderkey, period_text,
  CASE WHEN regexp_full_match(period_text, '[0-9]{{4}}-[0-9]{{2}}') THEN CAST(try_strptime(period_text, '%Y-%m') AS DATE) END
  AS period FROM (SELECT o_orderkey, {PERIOD_TEXT} AS period_text FROM orders)""",
    "drop_nulls": f"""
WITH src AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS period, o_orderpriority AS fuel_type,
                    {PRICE_TEXT} AS price_text FROM orders),
c AS ({_clean_price_sql('src', 'price_text', 'o_orderkey, period, fuel_type')})
SELECT o_orderkey, period, fuel_type, price_lkr FROM c
WHERE period IS NOT NULL AND fuel_type IS NOT NULL AND price_lkr IS NOT NULL""",
}

SQL["quarantine_periods"] = f"""
WITH raw AS (SELECT {PERIOD_TEXT} AS period, o_orderpriority AS fuel_type, o_totalprice / 200 AS price_lkr,
                    CAST(o_orderdate AS DATE) AS fetched_at, o_orderkey AS _pos FROM orders),
d AS (SELECT period, fuel_type, price_lkr FROM (
        SELECT *, row_number() OVER (PARTITION BY period, fuel_type ORDER BY fetched_at DESC NULLS LAST, _pos) AS rn
        FROM raw) WHERE rn = 1)
SELECT upper(trim(fuel_type)) AS fuel_type, price_lkr FROM d
WHERE period IS NOT NULL AND fuel_type IS NOT NULL AND price_lkr IS NOT NULL
  AND price_lkr > 0 AND price_lkr < 1500
  AND NOT regexp_full_match(period, '[0-9]{{4}}-(0[1-9]|1[0-2])')"""
