"""DuckDB SQL for the queries that SQL can express, written apart from the operators."""

from pagewright.llm.quality import STOP_WORDS

_W = r"[^\x20\x09-\x0D]+"

OP7 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
  length(text) + length(role) + length('<turn:></turn>') + 1
  + 2 * length(text) - length(replace(text, '\', '')) - length(replace(replace(text, '<', ''), '>', ''))
  + 2 * length(role) - length(replace(role, '\', '')) - length(replace(replace(role, '<', ''), '>', '')) AS fc FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY n), '')) AS loss_sha256,
  CAST(sum(fc) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{_W}') AS ws FROM documents),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM
  (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '{_W}') GROUP BY doc_id),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, range(5) t(k) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(ws) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(text) - length(translate(text, '#*$%&|<>', '')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
  coalesce(n_lines, 0) AS n_lines, len(list_filter(ws, lambda w: lower(w) IN ({', '.join(repr(w) for w in dict.fromkeys(STOP_WORDS))}))) AS n_stop_words
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id LEFT JOIN p ON d.doc_id = p.doc_id)
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 1000 * word_chars BETWEEN 2500 * n_words AND 15000 * n_words
  AND 1000 * n_symbols <= 300 * n_words AND 1000 * n_stop_words >= 20 * n_words AND 1000 * n_dup_lines <= 300 * n_lines AS kept
FROM m
"""

OP10 = r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS p0 FROM pages),
r AS (SELECT page_id, CASE WHEN p0 > 0 THEN substr(url, p0 + 3) ELSE '' END AS rest FROM u),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r),
x AS (SELECT *, CASE
  WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
  WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
  WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule FROM h)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM x
"""

OP6 = r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
  CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP2 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+2], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM documents UNION SELECT e.b, r.m FROM r JOIN e ON e.a = r.doc_id),
k AS (SELECT doc_id, min(m) AS component_id FROM r GROUP BY doc_id)
SELECT k.doc_id, coalesce(n, 0) AS n_shingles, component_id, k.doc_id = component_id AS kept FROM k LEFT JOIN n ON n.doc_id = k.doc_id
"""

OP3 = rf"""
WITH a AS (SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS raw, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p0 FROM documents),
l AS (SELECT doc_id, text, p0, trim(raw, ' ') AS line, row_number() OVER (PARTITION BY doc_id ORDER BY p0) AS n FROM a WHERE regexp_matches(raw, '{_W}')),
w AS (SELECT x.doc_id, x.n, x.line || chr(10) || y.line || chr(10) || z.line AS win FROM l x JOIN l y ON x.doc_id = y.doc_id AND y.n = x.n + 1 JOIN l z ON x.doc_id = z.doc_id AND z.n = x.n + 2),
later AS (SELECT doc_id, n FROM (SELECT *, row_number() OVER (PARTITION BY win ORDER BY doc_id, n) AS k FROM w) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, n + k AS n FROM later, range(3) t(k)),
lost AS (SELECT l.doc_id, l.p0 FROM l JOIN gone g ON l.doc_id = g.doc_id AND l.n = g.n),
c AS (SELECT doc_id, count(*) AS n FROM lost GROUP BY doc_id),
m AS (SELECT doc_id, count(*) AS n FROM l GROUP BY doc_id),
t AS (SELECT a.doc_id, string_agg(a.raw, chr(10) ORDER BY a.p0) AS text FROM a ANTI JOIN lost ON a.doc_id = lost.doc_id AND a.p0 = lost.p0 GROUP BY a.doc_id)
SELECT d.doc_id, coalesce(m.n, 0) AS n_lines, coalesce(c.n, 0) AS n_removed, sha256(CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(t.text, '') END) AS text_sha256
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
"""

SQL = {"op3_line_dedup": OP3, "op2_minhash_dedup": OP2, "op6_topk_search": OP6, "op7_chat_format": OP7, "op8_quality_rules": OP8, "op10_url_filter": OP10}
