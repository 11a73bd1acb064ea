"""DuckDB twins of the operators that SQL can express."""

from __future__ import annotations

OP6 = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
             first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
             row_number() OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r"""

OP8 = r"""
WITH rules(rhost, rpath, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
       ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
m AS (SELECT page_id, max_by({'r': rhost || rpath, 'v': v}, length(rhost || rpath)) AS best
      FROM (SELECT DISTINCT page_id, host, path FROM p)
      JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT p.page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id IS NOT DISTINCT FROM m.page_id"""

OP1 = r"""
WITH rules(kind, k, pat, least) AS (VALUES
  ('assign', 0, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8),
  ('access', 1, '(AKIA[A-Z0-9]+)', 16), ('hex', 2, '([0-9a-f]+)', 32)),
d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (SELECT doc_id, kind, k, least, regexp_extract_all(text, pat, 0) AS whole, regexp_extract_all(text, pat, 1) AS val,
             string_split_regex(text, pat) AS parts FROM d, rules),
u AS (SELECT doc_id, kind, k, least, unnest(range(1, len(whole) + 1)) AS i, unnest(whole) AS w, unnest(val) AS v,
             unnest(parts[1:len(whole)]) AS piece FROM m),
s AS (SELECT *, sum(length(piece) + length(w)) OVER (PARTITION BY doc_id, kind ORDER BY i) AS stop FROM u),
kept AS (SELECT doc_id, kind, k, stop - length(w) AS start, stop FROM s WHERE length(v) >= least),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)"""

OP11 = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
             length(coalesce(text, '')) + len(regexp_extract_all(coalesce(text, ''),
               '[<\[]\\*(?:/?s>|/?INST\]|OUT\]|/?SYS\]|ROLE=|/ROLE\])')) AS size,
             CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 11 WHEN 'system' THEN 13
                  ELSE 17 + length(coalesce(role, '')) END AS marks FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, md5(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, md5(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (3 + sum(size + marks))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id"""

OP12 = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS id, b.label AS label,
             list_dot_product(a.v, b.v)::BIGINT AS score
      FROM e a JOIN e b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0 AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE label = own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INTEGER AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE label <> own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""

OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
grams AS (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w, range(1, 6) AS r(k)),
f AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM grams GROUP BY ALL),
often AS (SELECT * FROM f WHERE f >= 100),
cuts AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut FROM often WHERE k > 1),
scored AS (SELECT c.lang, c.k, c.phrase, c.a, c.cut, x.f AS l, y.f AS r, t.n,
                  (1000::HUGEINT * c.a * t.n) // (x.f::HUGEINT * y.f) AS score
           FROM cuts c JOIN total t USING (lang)
           JOIN often x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[:c.cut], ' ')
           JOIN often y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[c.cut + 1:], ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM often o WHERE o.lang = s.lang AND o.k > s.k
           AND 100 * o.f >= 100 * s.a AND contains(' ' || o.phrase || ' ', ' ' || s.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       score::BIGINT AS score
FROM kept QUALIFY rank <= 2000"""

ORACLE_SQL = {"op11_chat_format": OP11, "op12_hard_negatives": OP12, "op13_collocations": OP13, "op1_secret_scan": OP1, "op6_exact_dedup": OP6, "op8_url_filter": OP8}
