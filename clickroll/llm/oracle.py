"""DuckDB twins of the corpus queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('mix-1:' || doc_id) AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (ARRAY[3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT]::DOUBLE AS weight,
             source_size * 2.0::DOUBLE AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS pos,
             ((sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
             / (sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) AS level
      FROM w WINDOW o AS (ORDER BY cap / weight, source IS NULL, source)),
t AS (SELECT source, source_size, least(cap, coalesce(weight * (
        SELECT arg_min(level, pos) FROM l WHERE level * weight <= cap), cap)) AS target FROM l),
q AS (SELECT d.doc_id, d.size, d.h, t.source_size, t.target,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id::VARCHAR) AS done
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, coalesce((copy * source_size + done)::DOUBLE / nullif(target, 0.0), 0.0) AS finish
      FROM q, (VALUES (0), (1)) AS v(copy)),
r AS (SELECT *, sum(size) OVER (ORDER BY finish, h, doc_id::VARCHAR, copy ROWS UNBOUNDED PRECEDING) AS run FROM c)
SELECT doc_id, any_value(size) AS size, any_value(source_size) AS source_size, any_value(target) AS target,
       (any_value(size) * count(*) FILTER (WHERE run <= (SELECT round(sum(target), 3) FROM t)))::BIGINT AS taken
FROM r GROUP BY doc_id
"""


RULES = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
k AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS win FROM t, unnest(range(1, len(ws) - 1)) AS r(i)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM k) WHERE c > 1),
n AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM again, (VALUES (0), (1), (2)) AS v(o) GROUP BY doc_id),
c AS (SELECT t.doc_id, len(ws) AS n_words, list_sum(list_transform(ws, lambda w: length(w))) AS chars,
        length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls,
        coalesce(n_repeat_words, 0) AS n_repeat_words, length(regexp_replace(text, '[^A-Z!]+', '', 'g')) AS shouted
      FROM t LEFT JOIN n USING (doc_id)),
b AS (SELECT doc_id, n_words::BIGINT AS n_words, coalesce(chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
        (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, len(ls) AS n_lines, shouted
      FROM c),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_symbols > n_words
       OR 10 * n_dup_lines > 3 * n_lines OR 2 * shouted > word_chars) AS kept
FROM f
"""

WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes, sha1(h) AS payload_digest,
             max(page_id) OVER (PARTITION BY h) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM d
"""

# CRC-32 (fixed value: its reversed polynomial) of the decimal id, bit by bit; every tenth
# text made periodic; equal 16-grams on one diagonal joined to stretches; stretches inside
# a run of smaller period go
RUNS = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws,
             xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''),
               lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda acc, x: CASE WHEN x >= 0 THEN xor(acc, x) ELSE xor(acc >> 1, (acc & 1) * 3988292384) END), 4294967295::BIGINT) AS h
           FROM documents),
a AS (SELECT doc_id, ws, len(ws) AS n, h, h // 10 AS g, CASE WHEN len(ws) > 0 THEN (h // 10) % len(ws) END AS a FROM w),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
d AS MATERIALIZED (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
             THEN list_transform(range(0, n), lambda i: ws[CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1]) ELSE ws END AS ws FROM p),
k AS MATERIALIZED (SELECT doc_id, n, i, array_to_string(ws[i + 1:i + 16], ' ') AS gram FROM d, unnest(range(0, n - 15)) AS r(i) WHERE n >= 24),
j AS (SELECT x.doc_id, y.i - x.i AS q, x.i FROM k AS x JOIN k AS y ON x.doc_id = y.doc_id AND x.gram = y.gram AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length
      FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM j) GROUP BY doc_id, q, island),
c AS MATERIALIZED (SELECT * FROM s WHERE length >= greatest(24, 3 * q)),
r AS MATERIALIZED (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM c AS o WHERE o.doc_id = c.doc_id AND o.q < c.q
                     AND o.start <= c.start AND o.start + o.length >= c.start + c.length)),
gone AS (SELECT DISTINCT doc_id, i FROM r, unnest(range(start + q, start + length)) AS u(i)),
lost AS (SELECT doc_id, list(i) AS gone_at FROM gone GROUP BY doc_id),
best AS (SELECT doc_id, arg_min([start, length, q], rank) AS b, count(*) AS n_runs,
                sha256(string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q)) AS runs_sha256
         FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / q DESC, start, q) AS rank FROM r) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b[1]::BIGINT AS start, b[2]::BIGINT AS length, b[3]::BIGINT AS period,
       (1000 * b[2] // b[3])::BIGINT AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
       sha256(array_to_string(CASE WHEN gone_at IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone_at, i - 1)) END, ' ')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lost USING (doc_id)
"""


def _codes() -> str:
    """Lloyd's rounds written out: each assigns every part to its nearest entry and takes
    means rounded down."""
    nearest = """(SELECT v.*, (SELECT arg_min([b.k, list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) ** 2))::BIGINT],
        [list_sum(list_transform(range(1, len(v.x) + 1), lambda i: (v.x[i] - b.x[i]) ** 2))::BIGINT, b.k]) FROM b{0} AS b WHERE b.part = v.part) AS got FROM v)"""
    steps = [f"""
a{i} AS MATERIALIZED {nearest.format(i)},
m{i} AS (SELECT part, got[1] AS k, i, sum(x[i])::BIGINT AS s, count(*)::BIGINT AS c FROM a{i}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL),
n{i} AS (SELECT part, k, list(((s - ((s % c) + c) % c) // c)::BIGINT ORDER BY i) AS x FROM m{i} GROUP BY part, k),
b{i + 1} AS MATERIALIZED (SELECT b.part, b.k, coalesce(n.x, b.x) AS x FROM b{i} AS b LEFT JOIN n{i} AS n USING (part, k))""" for i in range(6)]
    return f"""
WITH f AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS z FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS MATERIALIZED (SELECT vec_id, label, part, z[part * (len(z) // 8) + 1:(part + 1) * (len(z) // 8)] AS x FROM f, unnest(range(0, 8)) AS p(part)),
b0 AS MATERIALIZED (SELECT part, dense_rank() OVER (ORDER BY vec_id) - 1 AS k, x FROM v WHERE vec_id IN (SELECT vec_id FROM f ORDER BY vec_id LIMIT 16)),
{",".join(steps)},
last AS MATERIALIZED {nearest.format(6)},
r AS (SELECT vec_id, label, string_agg(printf('%02x', got[1]), '' ORDER BY part) AS code, sum(got[2])::BIGINT AS error FROM last GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, k)) FROM b6) AS codebooks_sha256
FROM r
"""


def oracle_sql() -> dict[str, str]:
    return {"op12_periodic_runs": RUNS, "op13_vector_codes": _codes(), "op1_quality_rules": RULES, "op5_mixing": MIXING, "op8_warc": WARC}
