"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op1_near_duplicates"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3
    THEN list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n_both
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
  SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
  WHERE 100 * n_both >= 85 * (nx.n + ny.n - n_both)),
arcs AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (
  SELECT doc_id AS node, doc_id AS root FROM documents
  UNION SELECT arcs.y, reach.root FROM reach JOIN arcs ON arcs.x = reach.node),
least AS (SELECT node, min(root) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN least ON least.node = d.doc_id
"""

ORACLES["op2_top_k"] = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 20
"""


def _url_rounds(rounds: int = 12) -> str:
    """The rounds of the two PageRanks, one common table expression each."""
    step = """
r{k} AS (
  SELECT host, 0.15 * good + 0.85 * coalesce(f.t, 0) AS t, 0.15 + 0.85 * coalesce(f.p, 0) AS p,
    0.15 * bad + 0.85 * coalesce(b.d, 0) AS d, 0.15 + 0.85 * coalesce(b.r, 0) AS r
  FROM nodes
  LEFT JOIN (SELECT dst, sum(t / n_out) AS t, sum(p / n_out) AS p
    FROM links JOIN n_out USING (src) JOIN r{j} ON host = src GROUP BY dst) f ON f.dst = host
  LEFT JOIN (SELECT src, sum(d / n_in) AS d, sum(r / n_in) AS r
    FROM links JOIN n_in USING (dst) JOIN r{j} ON host = dst GROUP BY src) b ON b.src = host)"""
    return ",".join(step.format(k=k, j=k - 1) for k in range(1, rounds + 1))


ORACLES["op7_url_verdicts"] = r"""
WITH u AS (
  SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
h AS (
  SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(rh, rp, rv) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
ruled AS (
  SELECT page_id, any_value(host) AS host, any_value(path) AS path, any_value(html) AS html,
    arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS ruled
  FROM h LEFT JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id),
links AS (
  SELECT DISTINCT host AS src, translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS dst
  FROM (SELECT host, unnest(regexp_extract_all(html,
    '(?i)href\s*=\s*["'']?\s*(?:https?:)?//([^/?#"''\s<>]+)', 1)) AS dst FROM ruled)
  WHERE host <> '' AND host <> translate(dst, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')),
n_out AS (SELECT src, count(*) AS n_out FROM links GROUP BY src),
n_in AS (SELECT dst, count(*) AS n_in FROM links GROUP BY dst),
seeds AS (
  SELECT host, avg(coalesce(ruled = 'allow', false)::INT) AS good, avg(coalesce(ruled = 'block', false)::INT) AS bad
  FROM ruled WHERE host <> '' GROUP BY host),
nodes AS (
  SELECT host, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad
  FROM (SELECT src AS host FROM links UNION SELECT dst FROM links UNION SELECT host FROM seeds) LEFT JOIN seeds USING (host)),
r0 AS (SELECT host, good AS t, 1.0::DOUBLE AS p, bad AS d, 1.0::DOUBLE AS r FROM nodes),
""" + _url_rounds() + r""",
blocked AS (
  SELECT host FROM r12 WHERE round(d / r, 9) >= 0.5 AND round(d / r, 9) > round(t / p, 9))
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN host IN (FROM blocked) THEN 'block' END, 'allow') AS verdict
FROM ruled
"""

ORACLES["op4_quality_rules"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
counts AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars FROM w),
windows AS (
  SELECT doc_id, unnest(range(1, len(ws) - 1)) AS i,
    unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))) AS win FROM w),
often AS (SELECT doc_id, win FROM windows GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS pos FROM windows JOIN often USING (doc_id, win)) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
lined AS (
  SELECT doc_id, sum(n)::BIGINT AS n_lines, sum(n - 1)::BIGINT AS n_dup_lines
  FROM (SELECT doc_id, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, n_words, word_chars, length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters
  FROM d JOIN counts USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN lined USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 5 * n_symbols > n_words
    OR word_chars < 2 * n_words OR word_chars > 20 * n_words OR 2 * n_dup_lines > n_lines OR 2 * n_upper > n_letters) AS kept
FROM m
"""

# Matches of each kind in order, with the pieces between them, give the offsets;
# a failing match keeps its place, as the scan does not search its characters again.
# CRC-32 is folded bit by bit (reflected polynomial 0xEDB88320).
_KEY = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_SECRET_KINDS = [
    ("assign", f"""({_KEY})["']?\\x20*[:=]\\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]+"),
    ("hex", "[0-9a-f]+"),
    ("token", "(gh[pousr]|npm)_[0-9A-Za-z]+"),
    ("private_key", "-----BEGIN [A-Z\\x20]*PRIVATE KEY-----[A-Za-z0-9+/=\\x20\\x09-\\x0D]+-----END [A-Z\\x20]*PRIVATE KEY-----"),
]
_MATCHES = "\n  UNION ALL ".join(
    f"SELECT r, '{kind}' AS kind, {i} AS o, regexp_extract_all(t, '{p}') AS ms, regexp_split_to_array(t, '{p}') AS ps FROM d"
    .replace("'(", "'(").replace("[\"']", "[\"'']") for i, (kind, p) in enumerate(_SECRET_KINDS))
_CRC = ("xor(list_reduce(range(240), lambda c, i: xor((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(b, i // 8 + 1, 1))) ELSE c END) >> 1, "
        "CASE WHEN ((CASE WHEN i % 8 = 0 THEN xor(c, ascii(substr(b, i // 8 + 1, 1))) ELSE c END) & 1) = 1 THEN 3988292384 ELSE 0 END), "
        "4294967295::BIGINT), 4294967295)")
_B62 = "'0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz'"
ORACLES["op11_secrets"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS r FROM documents),
m AS ({_MATCHES}),
u AS (SELECT r, kind, o, unnest(ms) AS mt, unnest(ps[1:len(ms)]) AS before, unnest(range(1, len(ms) + 1)) AS i FROM m),
p AS (SELECT r, kind, o, mt, sum(length(before) + length(mt)) OVER (PARTITION BY r, kind ORDER BY i) - length(mt) AS s FROM u),
tok AS (SELECT *, substr(mt, 5, 30) AS b, substr(mt, 35) AS tail FROM p WHERE kind = 'token' AND length(mt) = 40),
tok_ok AS (
  SELECT r, kind, o, s, s + length(mt) AS e FROM (SELECT *, {_CRC} AS crc FROM tok)
  WHERE tail = list_aggregate(list_transform(range(5, -1, -1), lambda k: substr({_B62}, (crc // (62::BIGINT ** k)::BIGINT) % 62 + 1, 1)), 'string_agg', '')),
pem AS (
  SELECT *, regexp_extract(mt, '^-----BEGIN ([A-Z\\x20]*)PRIVATE KEY-----', 1) AS l1,
    regexp_extract(mt, '-----END ([A-Z\\x20]*)PRIVATE KEY-----$', 1) AS l2,
    regexp_replace(regexp_extract(mt, 'KEY-----([^-]*)-----END', 1), '[\\x20\\x09-\\x0D]+', '', 'g') AS body
  FROM p WHERE kind = 'private_key'),
ok AS (
  SELECT r, kind, o, s, s + length(mt) AS e FROM p
  WHERE (kind = 'assign' AND length(regexp_extract(mt, '[:=]\\x20*["'']?([A-Za-z0-9+/_.=-]+)$', 1)) >= 6)
     OR (kind = 'access' AND length(mt) >= 20) OR (kind = 'hex' AND length(mt) >= 24)
  UNION ALL SELECT * FROM tok_ok
  UNION ALL SELECT r, kind, o, s, s + length(mt) FROM pem
  WHERE l1 = l2 AND regexp_full_match(body, '([A-Za-z0-9+/]{{4}})*([A-Za-z0-9+/]{{2}}==|[A-Za-z0-9+/]{{3}}=)?')
    AND 3 * length(body) // 4 - (length(body) - length(replace(body, '=', ''))) >= 64),
g AS (
  SELECT r, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
    count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (WHERE o < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
  FROM ok GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""
