"""DuckDB SQL for those training-data queries, or columns of them, that SQL can express."""

from __future__ import annotations

from plyforge.llm.url_filter import IP, TWO_LABEL_SUFFIXES

#: crc32 of an id as text: its bytes and eight shifts after each, folded from the left.
CRC32 = """xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split(CAST({id} AS VARCHAR), ''), lambda c: list_concat([ascii(c)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384::BIGINT * (c & 1)) END))"""

FINGERPRINT_EDITS = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS following, length(text) AS n FROM d)
SELECT doc_id, n AS n_chars, sha256(substr(text, 1, n - n // 3) || substr(following, 1, n // 3)) AS edited_sha256 FROM n
"""

ASSIGN = r"""(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found(name: str, text: str, pattern: str, kind: str, no: int, keep: str) -> str:
    """Matches of one kind with their places: the lengths of what lies before them."""
    return f"""
{name}_all AS (SELECT doc_id, regexp_extract_all({text}, '{pattern}') AS m, regexp_split_to_array({text}, '{pattern}') AS g, regexp_extract_all({text}, '{pattern}', {2 if kind == "assign" else 0}) AS v FROM d),
{name} AS (SELECT doc_id, unnest(list_transform(range(1, len(m) + 1), lambda i: {{'s': list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0), 'n': length(m[i]), 'v': v[i]}})) AS x FROM {name}_all),
{name}_kept AS (SELECT doc_id, x.s::BIGINT AS s, {no} AS no, (x.s + x.n)::BIGINT AS e, '{kind}' AS kind FROM {name} WHERE {keep})"""


SECRET_BASE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
{_found("assigned", "low", ASSIGN, "assign", 0, "length(x.v) >= 8")},
{_found("accesses", "text", "AKIA[A-Z0-9]{12,}", "access", 1, "x.n >= 16")},
{_found("hexes", "text", "[0-9a-f]{32,}", "hex", 2, "x.n >= 32")},
spans AS (SELECT * FROM assigned_kept UNION ALL SELECT * FROM accesses_kept UNION ALL SELECT * FROM hexes_kept),
by_doc AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, no) AS listed FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(listed, '')) AS base_sha256 FROM d LEFT JOIN by_doc USING (doc_id)
"""

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"list_filter(regexp_split_to_array({LOWERED}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"

LANGUAGE_MODEL_BASE = f"""
WITH d AS (SELECT doc_id, ({CRC32.format(id="doc_id")}) % 5 = 1 AS held_out, list_concat({WORDS}, ['']) AS words FROM documents),
t AS (SELECT doc_id, held_out, unnest(words) AS w FROM d),
c AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
n AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM c)
SELECT doc_id, any_value(held_out) AS held_out, count(*) AS n_tokens, count(c) AS n_known, any_value(n) AS train_tokens,
    round(sum(log10((coalesce(c, 0) + 0.5) / (n + 0.5 * (v + 1)))), 4) AS base_score
FROM t LEFT JOIN c USING (w) CROSS JOIN n GROUP BY doc_id
"""

OP7 = r"""
WITH u AS (SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path FROM u),
f AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM p),
q AS (SELECT *, CASE WHEN rule IS NULL THEN NULL WHEN rule IN ('www.example.com/en/', 'com/') THEN 0 ELSE 1 END AS bad, __DOMAIN__ AS domain, __SUFFIX__ AS suffix FROM f),
hosts AS (SELECT host, domain, suffix, count(bad) AS n, coalesce(sum(bad), 0) AS b FROM q GROUP BY ALL),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM domains GROUP BY ALL),
root AS (SELECT (sum(b) + 1) / (sum(n) + 2) AS root FROM suffixes),
s0 AS (SELECT suffix, n, b, root AS above FROM suffixes CROSS JOIN root),
sk AS (__K(s0)__),
s AS (SELECT suffix, CASE WHEN n > 0 THEN b / n END AS rate, (b + least(k, 1000.0) * above) / (n + least(k, 1000.0)) AS mean, n + least(k, 1000.0) AS weight FROM s0 CROSS JOIN sk),
d0 AS (SELECT d.domain, d.n, d.b, s.rate AS above, s.mean, s.weight FROM domains d JOIN s USING (suffix)),
dk AS (__K(d0)__),
e AS (SELECT domain, CASE WHEN n > 0 THEN b / n END AS rate, (b + least(k, weight) * mean) / (n + least(k, weight)) AS mean, n + least(k, weight) AS weight FROM d0 CROSS JOIN dk),
h0 AS (SELECT h.host, h.n, h.b, e.rate AS above, e.mean, e.weight FROM hosts h JOIN e USING (domain)),
hk AS (__K(h0)__),
r AS (SELECT host, (b + least(k, weight) * mean) / (n + least(k, weight)) AS mean, n + least(k, weight) AS weight FROM h0 CROSS JOIN hk)
SELECT page_id, q.host, path, rule, CASE WHEN bad = 1 THEN 'block' WHEN bad = 0 THEN 'allow' WHEN mean - 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) > 0.5 THEN 'block' ELSE 'allow' END AS verdict
FROM q JOIN r USING (host)
"""


def _concentration(table: str) -> str:
    """A beta prior's weight by the method of moments, from children (n, b) around the rate above."""
    return f"""SELECT CASE WHEN rho > 0 THEN least(1000.0, greatest(0.5, 1 / greatest(rho, 1e-9) - 1)) WHEN rho IS NULL THEN 1.0 ELSE 1000.0 END AS k FROM (
    SELECT CASE WHEN groups > 1 AND total > groups AND msb + (size - 1) * msw > 0 THEN (msb - msw) / (msb + (size - 1) * msw) END AS rho FROM (
    SELECT groups, total, among / nullif(groups - 1, 0) AS msb, within / nullif(total - groups, 0) AS msw, (total - squares / total) / nullif(groups - 1, 0) AS size FROM (
    SELECT count(*) AS groups, sum(n)::DOUBLE AS total, sum(n * n)::DOUBLE AS squares, sum(n * (b / n - above) * (b / n - above)) AS among, sum(n * (b / n) * (1 - b / n)) AS within FROM {table} WHERE n > 0)))"""


BARE = "regexp_replace(host, ':[0-9]*$', '')"
TWO = f"array_to_string(string_split({BARE}, '.')[-2:], '.')"
LONG, ADDRESS = f"{TWO} IN ({', '.join(map(repr, TWO_LABEL_SUFFIXES))})", f"regexp_matches({BARE}, '{IP}')"
OP7 = OP7.replace("__DOMAIN__", f"CASE WHEN {ADDRESS} THEN {BARE} WHEN {LONG} THEN array_to_string(string_split({BARE}, '.')[-3:], '.') ELSE {TWO} END")
OP7 = OP7.replace("__SUFFIX__", f"CASE WHEN {ADDRESS} THEN '(ip)' WHEN {LONG} THEN {TWO} ELSE string_split({BARE}, '.')[-1] END")
for _name in ("s0", "d0", "h0"):
    OP7 = OP7.replace(f"__K({_name})__", _concentration(_name))

#: Links on all pairs that share a shingle, then the smallest id that a walk reaches.
OP8 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS} AS w FROM documents),
s AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [hash(array_to_string(w, ' '))] ELSE list_transform(range(1, len(w) - 1), lambda i: hash(w[i], w[i + 1], w[i + 2])) END)) AS s FROM d),
t AS (SELECT doc_id, len(s) AS n, md5(array_to_string(s, ' ')) AS k, s FROM s),
g AS (SELECT min(doc_id) AS rep, k, any_value(s) AS s FROM t WHERE n > 0 GROUP BY k),
x AS (SELECT rep, len(s) AS n, unnest(s) AS h FROM g),
common AS (SELECT a.rep AS a, b.rep AS b, count(*) AS both_, any_value(a.n) AS na, any_value(b.n) AS nb FROM x a JOIN x b ON a.h = b.h AND a.rep < b.rep GROUP BY a.rep, b.rep),
link AS (SELECT a, b FROM common WHERE 100 * both_ >= 85 * (na + nb - both_)),
edge AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
walk AS (SELECT rep AS node, rep AS reached FROM g UNION SELECT w.node, e.b FROM walk w JOIN edge e ON w.reached = e.a),
least_ AS (SELECT node, min(reached) AS component FROM walk GROUP BY node),
named AS (SELECT t.doc_id, n AS n_shingles, coalesce(component, t.doc_id) AS component_id FROM t LEFT JOIN g USING (k) LEFT JOIN least_ ON node = rep)
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM named
"""

OP10 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, least(len(a.q), len(b.q)) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

SQL: dict[str, str] = {
    "op7_url_reputation": OP7, "op8_minhash_near_dup": OP8, "op10_exact_topk": OP10,
    "fingerprint_edits": FINGERPRINT_EDITS, "secret_base": SECRET_BASE, "language_model_base": LANGUAGE_MODEL_BASE,
}
