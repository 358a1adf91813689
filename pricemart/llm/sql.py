"""DuckDB SQL for the queries that SQL can express."""

WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
b AS (SELECT coalesce(item_id::VARCHAR, '') AS item_id, {WORDS} AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS gram
      FROM (SELECT item_id, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
w AS (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS gram
      FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM g) WHERE len(ws) >= n)),
h AS (SELECT w.r, w.i, w.n, g.item_id FROM w JOIN g USING (n, gram)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

OP10 = r"""
WITH l AS (SELECT r, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i
           FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT r) >= 10)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f USING (key) GROUP BY r
"""

SQL = {"op4_decontaminate": OP4, "op10_line_dedup": OP10}

OP1 = r"""
WITH d AS (SELECT *, row_number() OVER () AS r, coalesce(doc_id::VARCHAR, '') AS id,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             greatest(0.05::DOUBLE, coalesce(p * p * p * p, 0.05::DOUBLE)) AS q
           FROM (SELECT doc_id, text, source, CASE WHEN length(text) > 0
                   THEN length(regexp_replace(text, '[#*$%&|<>!]+', '', 'g'))::DOUBLE / length(text) END AS p FROM documents)),
k AS (SELECT *, -ln((('0x' || substr(md5(id), 1, 13))::BIGINT::DOUBLE + 1) / 4503599627370496.0::DOUBLE) / q AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w
      FROM k GROUP BY source),
f AS (SELECT *, row_number() OVER o AS rank, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / w AS ratio,
        (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE - coalesce(sum(source_size * 2.0::DOUBLE) OVER b, 0.0::DOUBLE))
        / (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0::DOUBLE)) AS level
      FROM s WINDOW o AS (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST),
                    b AS (ORDER BY source_size * 2.0::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, rank) FROM f WHERE level < ratio) * w, cap)) AS target FROM f),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
g AS (SELECT source, key, id, size, count(*) * size AS mass FROM k GROUP BY source, key, id, size),
c AS (SELECT g.source, g.key, g.id, g.size, sum(mass) OVER (PARTITION BY g.source ORDER BY key, id, size ROWS UNBOUNDED PRECEDING) - mass / 2.0::DOUBLE
             <= target - epochs * source_size AND target - epochs * source_size > 0 AS inside
      FROM g JOIN e ON g.source IS NOT DISTINCT FROM e.source)
SELECT k.doc_id, k.size, e.source_size, e.target, (k.size * (e.epochs + c.inside::BIGINT))::BIGINT AS taken
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
JOIN c ON k.source IS NOT DISTINCT FROM c.source AND k.key = c.key AND k.id = c.id AND k.size = c.size
"""

OP7 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, i, array_to_string(ws[i:i + 7], chr(31)) AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM d WHERE len(ws) >= 9)),
m AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY r, gram) > 1),
rep AS (SELECT r, count(DISTINCT p)::BIGINT AS n FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM m) GROUP BY r),
l AS (SELECT r, count(*)::BIGINT AS n, (count(*) - count(DISTINCT line))::BIGINT AS dup
      FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
c AS (SELECT d.doc_id, d.source, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]+', '', 'g')))::BIGINT AS n_symbols, coalesce(l.n, 0) AS n_lines,
        coalesce(l.dup, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN l USING (r)),
x AS (SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repetitive, 100 * n_symbols > 10 * word_chars AS symbols,
        100 * n_dup_lines > 30 * n_lines AS lines FROM c),
h AS (SELECT source, count(*) AS n, sum(short::INT) AS f1, sum(repetitive::INT) AS f2, sum(symbols::INT) AS f3, sum(lines::INT) AS f4 FROM x GROUP BY source),
u AS (SELECT source, n, unnest([1, 2, 3, 4]) AS rule, unnest([f1, f2, f3, f4]) AS f FROM h),
p AS (SELECT rule, avg(f / n) AS mean, CASE WHEN var_pop(f / n) > 1e-12 THEN greatest(avg(f / n) * (1 - avg(f / n)) / var_pop(f / n) - 1, 0.01) ELSE 100.0 END AS k
      FROM u GROUP BY rule),
v AS (SELECT source, bool_or((f + mean * k) / (n + k) > 0.5) AS failed FROM u JOIN p USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
       NOT (short OR repetitive) AND NOT v.failed AS kept
FROM x JOIN v ON x.source IS NOT DISTINCT FROM v.source
"""

OP8 = r"""
WITH p AS (SELECT page_id, url, sha256(coalesce(html, '')) AS digest, length(html) AS size, coalesce(page_id, 0) AS n, unnest([0, 1, 2, 3, 4]) AS k FROM pages),
a AS (SELECT *, '"' || substr(digest, 1, 16) || '"' AS tag, n % 5000 * 60 + ([0, 600, 4200, 90000, 200000])[k + 1] AS sec,
        strftime(make_timestamp((1700000000 + n % 1000 * 60) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS lm FROM p WHERE k <> 3 OR n % 3 = 0),
b AS (SELECT *, strftime(make_timestamp((1700000000 + sec) * 1000000), '%a, %d %b %Y %H:%M:%S GMT') AS dt, k IN (1, 3) AS is_full FROM a),
r AS (SELECT 'urn:' || page_id || '-' || k AS record_id, is_full, make_timestamp((1710000000 + sec) * 1000000) AS t,
        CASE k WHEN 2 THEN url || '#again' WHEN 4 THEN regexp_replace(url, '^https?://([^/?#]*)', 'HTTP://\1:80') ELSE url END AS uri,
        CASE WHEN is_full OR n % 8 = 2 THEN 'sha256:' || digest END AS payload_digest,
        CASE WHEN is_full AND k = 3 THEN '"v2"' WHEN is_full THEN tag WHEN n % 4 IN (0, 1) THEN 'W/' || tag END AS etag,
        CASE WHEN is_full OR n % 4 = 3 THEN lm END AS lm, size, dt, n, tag FROM b),
m AS (SELECT *, regexp_extract(uri, '^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(?:\?([^#]*))?(?:#.*)?$',
                               ['host', 'port', 'path', 'query']) AS u FROM r),
c AS (SELECT *, regexp_replace(lower(u.host), '^www\.', '') || CASE WHEN u.port IN ('', '80', '443') THEN '' ELSE ':' || u.port END
        || CASE WHEN u.path = '' THEN '/' ELSE u.path END
        || CASE WHEN u.query = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(u.query, '&')), '&') END AS url FROM m),
j AS (SELECT v.*, f.record_id AS base_id, f.t AS base_date, f.payload_digest AS base_digest, f.etag AS base_etag, f.lm AS base_lm, f.size AS base_size,
        f.dt AS base_dt, f.n AS base_n
      FROM (SELECT * FROM c WHERE NOT is_full) v ASOF LEFT JOIN
           (SELECT url, t, unnest(max(x), recursive := true) FROM (SELECT url, t, {'record_id': record_id, 'payload_digest': payload_digest, 'etag': etag,
              'lm': lm, 'size': size, 'dt': dt, 'n': n} AS x FROM c WHERE is_full) GROUP BY url, t) f ON v.url = f.url AND v.t > f.t),
s AS (SELECT *, coalesce(regexp_replace(etag, '^W/', '') = base_etag, lm = base_lm, payload_digest = base_digest) AS same FROM j),
z AS (SELECT *, CASE WHEN base_id IS NULL THEN 'no_response' WHEN same THEN 'resolved' WHEN NOT same THEN 'mismatch' ELSE 'unverified' END AS verdict FROM s)
SELECT record_id, url, verdict, base_id, base_date, CASE WHEN verdict = 'resolved' THEN base_digest END AS payload_digest,
  CASE WHEN verdict <> 'resolved' THEN
    CASE n % 4 WHEN 3 THEN 'Date: ' || dt || chr(10) || 'last-modified: ' || lm || chr(10) || 'Connection: close'
               WHEN 2 THEN 'Date: ' || dt || chr(10) || 'Server: x'
               ELSE 'date: ' || dt || chr(10) || 'etag: ' || etag || chr(10) || 'Cache-Control: max-age=3600' || chr(10) || 'Set-Cookie: s=0' END
  ELSE 'Content-Type: text/html; charset=utf-8' || coalesce(chr(10) || 'Content-Length: ' || base_size, '') || chr(10)
    || CASE n % 4 WHEN 3 THEN 'ETag: ' || base_etag || chr(10) || 'Cache-Control: max-age=60' || chr(10) || 'Set-Cookie: s=' || base_n || chr(10)
                              || 'Date: ' || dt || chr(10) || 'last-modified: ' || lm
                  WHEN 2 THEN 'ETag: ' || base_etag || chr(10) || 'Last-Modified: ' || base_lm || chr(10) || 'Cache-Control: max-age=60' || chr(10)
                              || 'Set-Cookie: s=' || base_n || chr(10) || 'Date: ' || dt
                  ELSE 'Last-Modified: ' || base_lm || chr(10) || 'Set-Cookie: s=' || base_n || chr(10) || 'date: ' || dt || chr(10) || 'etag: ' || etag
                       || chr(10) || 'Cache-Control: max-age=3600' END END AS headers
FROM z
"""

SQL |= {"op1_mix_sources": OP1, "op7_host_rules": OP7, "op8_revisits": OP8}

OP3 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, {WORDS} AS ws FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ') AS gram
      FROM (SELECT r, ws, unnest(range(1, len(ws) - least(5, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
c AS (SELECT a.r AS x, b.r AS y, count(*) AS common FROM s a JOIN s b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL),
l AS (SELECT x, y FROM c JOIN n nx ON nx.r = x JOIN n ny ON ny.r = y WHERE 10 * common >= 8 * (nx.n + ny.n - common)),
reach AS (SELECT r AS x, r AS y FROM d UNION SELECT reach.x, l.y FROM reach JOIN l ON l.x = reach.y),
k AS (SELECT x, min(doc_id) AS class_id FROM reach JOIN d ON d.r = y GROUP BY x),
m AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT doc_id, class_id, coalesce(n_links, 0)::BIGINT AS n_links FROM d JOIN k ON k.x = d.r LEFT JOIN m ON m.x = d.r
"""

SQL["op3_ngram_join"] = OP3

OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, doc_id, i, md5(array_to_string(ws[i + 1:i + 50], ' ')) AS gram FROM (SELECT r, doc_id, ws, unnest(range(0, len(ws) - 49)) AS i FROM d WHERE len(ws) >= 50)),
m AS (SELECT r, doc_id, i, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) > 1 AS later FROM w QUALIFY count(*) OVER (PARTITION BY gram) > 1),
g AS (SELECT *, sum(gap) OVER (PARTITION BY r ORDER BY i) AS span FROM (SELECT *, (i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 50, -1))::INT AS gap FROM m)),
s AS (SELECT r, doc_id, min(i) AS a, max(i) + 50 AS b FROM g GROUP BY r, doc_id, span),
l AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 50)) AS p FROM m WHERE later) GROUP BY r)
SELECT doc_id, count(*)::BIGINT AS n_spans, sum(b - a)::BIGINT AS n_repeated, coalesce(any_value(l.n), 0)::BIGINT AS n_later,
       string_agg(a || '+' || (b - a), ',' ORDER BY a) AS spans
FROM s LEFT JOIN l USING (r) GROUP BY r, doc_id
"""

SQL["op6_suffix_dedup"] = OP6
