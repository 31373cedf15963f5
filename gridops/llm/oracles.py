"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

OP5_JACCARD_JOIN = r"""
WITH RECURSIVE
words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingle AS (
    SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + 3], ' ')) AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
overlap AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
    FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (
    SELECT x, y FROM overlap JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
    WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
edge AS (SELECT x, y FROM link UNION SELECT y, x FROM link),
reach AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION SELECT r.x, e.y FROM reach r JOIN edge e ON e.x = r.y)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, least(d.doc_id, min(r.y)) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN reach r ON r.x = d.doc_id
GROUP BY d.doc_id, s.n
"""

OP4_SUBSTRING_DEDUP = r"""
WITH
words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
one AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS pos FROM words),
win AS (SELECT doc_id, pos, hash(array_to_string(w[pos : pos + 49], ' ')) AS h FROM one WHERE pos + 49 <= len(w)),
earliest AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h),
hit AS (SELECT doc_id, pos FROM win JOIN earliest USING (h) WHERE first < doc_id),
edge AS (
    SELECT doc_id, pos, sum(d) AS d FROM (SELECT doc_id, pos, 1 AS d FROM hit UNION ALL SELECT doc_id, pos + 50, -1 FROM hit) GROUP BY ALL),
depth AS (
    SELECT one.doc_id, one.pos, one.w[one.pos] AS word, sum(coalesce(edge.d, 0)) OVER (PARTITION BY one.doc_id ORDER BY one.pos) AS n
    FROM one LEFT JOIN edge ON edge.doc_id = one.doc_id AND edge.pos = one.pos),
kept AS (
    SELECT doc_id, count(*) AS n_words, count(*) FILTER (n > 0) AS n_removed,
           coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (n = 0), '') AS text
    FROM depth GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""

OP10_IMPACT_INDEX = r"""
WITH
v AS (
    SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT row, vec_id, unnest(range(1, len(e) + 1)) AS d, unnest(e) AS x FROM v),
pair AS (  -- rows, not ids: a query's own row alone is no candidate
    SELECT q.row, q.vec_id AS query_id, p.row AS other, p.vec_id, CAST(sum(q.x * p.x) AS BIGINT) AS score
    FROM flat q JOIN flat p ON q.d = p.d AND q.vec_id % 50 = 0 AND q.row <> p.row GROUP BY ALL)
SELECT query_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM pair QUALIFY rank <= 5
"""

OP11_PREFIX_TRIE = r"""
WITH
own AS (
    SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS w,
           xor(list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)),
               lambda a, x: list_reduce(range(8), lambda b, i: CASE WHEN b & 1 = 1 THEN xor(b >> 1, 3988292384) ELSE b >> 1 END, xor(a, x)),
               4294967295), 4294967295) % 9 AS h
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
built AS (
    SELECT o.conv_id, list_concat(CASE WHEN b.w IS NULL THEN [] ELSE b.w[1 : o.h] END, o.w[o.h + 1 :]) AS s
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
member AS (SELECT conv_id, s[1 : d] AS k, d, len(s) = d AS ends FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM built)),
node AS (
    SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, CASE WHEN d = 0 THEN 0 ELSE strlen(k[d].text) END AS bytes,
           sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM member GROUP BY k, d),
child AS (SELECT k[1 : d - 1] AS k, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
one AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN child USING (k)),
under AS (
    SELECT k[1 : j] AS k, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((n_convs - 1) * bytes) AS BIGINT) AS saved_tokens
    FROM (SELECT k, n_children, n_convs, bytes, unnest(range(0, d + 1)) AS j FROM one) GROUP BY ALL)
SELECT one.conv_id, one.d AS depth, up.conv_id AS parent_conv_id, one.n_convs, one.n_children, n_leaves, saved_tokens, one.ends_sha256
FROM one JOIN under USING (k) LEFT JOIN node up ON one.d > 0 AND up.k = one.k[1 : one.d - 1]
"""

OP12_URL_RULES = r"""
WITH
entry (r_host, r_path, verdict) AS (
    VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (
    SELECT DISTINCT coalesce(url, '') AS url,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
listed AS (
    SELECT url, r_host || r_path AS rule, verdict FROM cut JOIN entry ON (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY length(r_host || r_path) DESC, r_host || r_path) = 1),
part AS (
    SELECT *, list_filter(string_split(host, '.'), lambda x: x <> '') AS labels,
           regexp_extract_all(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^/._~!$&()*+,;=:@%-]+') AS words,
           list_filter(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*[?]([^#]*)', 1), '&'), lambda x: x <> '') AS names,
           translate(split_part(url, '://', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS scheme
    FROM cut),
token AS (
    SELECT DISTINCT url, unnest(CASE WHEN contains(url, '://') THEN [':' || scheme] ELSE [] END || list_transform(labels, lambda x: '@' || x)
           || CASE WHEN len(labels) > 0 THEN ['.' || labels[-1]] ELSE [] END || list_transform(words, lambda x: '/' || x)
           || list_transform(names, lambda x: '?' || split_part(x, '=', 1))) AS token
    FROM part),
least AS (SELECT greatest(5, (count(*) * 5000 + 999999) // 1000000) AS least FROM listed),
common AS (
    SELECT token, list(url ORDER BY url) AS held_by FROM token JOIN listed USING (url) GROUP BY token HAVING count(*) >= (SELECT least FROM least)),
item AS (SELECT token, min(token) OVER (PARTITION BY held_by) AS item FROM common),
url_item AS (SELECT DISTINCT url, item AS token FROM token JOIN item USING (token)),
held AS (SELECT url, token, verdict FROM url_item JOIN listed USING (url)),
combo AS (
    SELECT url, verdict, [token] AS needed FROM held
    UNION ALL SELECT a.url, a.verdict, [a.token, b.token] FROM held a JOIN held b ON a.url = b.url AND a.token < b.token
    UNION ALL SELECT a.url, a.verdict, [a.token, b.token, x.token] FROM held a JOIN held b ON a.url = b.url AND a.token < b.token
        JOIN held x ON x.url = a.url AND b.token < x.token),
mined AS (
    SELECT needed, verdict, support, support / whole AS confidence
    FROM (SELECT needed, verdict, count(*) AS support, sum(count(*)) OVER (PARTITION BY needed) AS whole FROM combo GROUP BY needed, verdict)
    WHERE support >= (SELECT least FROM least) AND support / whole >= 0.8),
best AS (
    SELECT * FROM mined r WHERE NOT EXISTS (
        SELECT 1 FROM mined q WHERE q.verdict = r.verdict AND len(q.needed) < len(r.needed) AND list_has_all(r.needed, q.needed) AND q.confidence >= r.confidence)),
url_tokens AS (SELECT url, list(token) AS tokens FROM url_item GROUP BY url),
matched AS (
    SELECT url, verdict FROM url_tokens JOIN best ON list_has_all(tokens, needed)
    QUALIFY row_number() OVER (PARTITION BY url ORDER BY confidence DESC, support DESC, verdict <> 'block', needed, verdict) = 1)
SELECT page_id, host, path, l.rule, coalesce(l.verdict, m.verdict, 'allow') AS verdict,
       CASE WHEN l.verdict IS NOT NULL THEN 'list' WHEN m.verdict IS NOT NULL THEN 'mined' ELSE 'default' END AS how
FROM pages JOIN cut ON cut.url = coalesce(pages.url, '') LEFT JOIN listed l ON l.url = cut.url LEFT JOIN matched m ON m.url = cut.url
"""

OP13_SOURCE_DIVERGENCE = r"""
WITH
doc AS (
    SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents),
word AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM doc),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT i) >= 3),
whole AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM doc),
found AS (SELECT lang, source, term, count(*) AS n FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
total AS (SELECT lang, source, sum(n) AS n FROM found GROUP BY ALL),
p AS (
    SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n, 1 + (1000000000 * CAST(coalesce(f.n, 0) + 1 AS HUGEINT)) // (coalesce(t.n, 0) + w.v) AS p,
           1 + (1000000000 * (k.n + 1)) // (w.n + w.v) AS q
    FROM grp g JOIN whole w USING (lang) JOIN kept k USING (lang)
    LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term LEFT JOIN total t ON t.lang = g.lang AND t.source = g.source),
cost AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
answer AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(c.value, 0) AS BIGINT) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN cost c ON c.lang = a.lang AND c.source = a.source AND c.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM answer QUALIFY part = 'pair' OR rank <= 200
"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": OP4_SUBSTRING_DEDUP,
    "op5_jaccard_join": OP5_JACCARD_JOIN,
    "op10_impact_index": OP10_IMPACT_INDEX,
    "op11_prefix_trie": OP11_PREFIX_TRIE,
    "op12_url_rules": OP12_URL_RULES,
    "op13_source_divergence": OP13_SOURCE_DIVERGENCE,
}
