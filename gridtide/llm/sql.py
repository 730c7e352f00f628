"""SQL counterparts of the queries that SQL can express."""

from __future__ import annotations

URL_FILTERS = r"""
WITH RECURSIVE
page AS (
    SELECT page_id, url, html,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
parsed AS (
    SELECT page_id, html, rest,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1) AS query
    FROM page
),
named AS (
    SELECT *, CASE WHEN host <> '' THEN
        host || CASE WHEN path = '' THEN '/' ELSE path END || coalesce(query, '') END AS node
    FROM parsed
),
tags AS (
    SELECT node, host, path, unnest(regexp_extract_all(
        regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script>', ' ', 'g'), '(?i)<(?:link|meta)\b[^>]*>')) AS tag
    FROM named
),
found AS (
    SELECT node, host, path, replace(regexp_extract(tag, '(?i)\bhref\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&') AS t
    FROM tags
    WHERE regexp_matches(tag, '(?i)^<link\b') AND regexp_matches(tag, '(?i)\brel\s*=\s*["'']?\s*canonical\b')
    UNION ALL
    SELECT node, host, path, replace(regexp_extract(tag, '(?i)\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1), '&amp;', '&')
    FROM tags
    WHERE regexp_matches(tag, '(?i)^<meta\b') AND regexp_matches(tag, '(?i)\bhttp-equiv\s*=\s*["'']?\s*refresh\b')
),
aimed AS (
    SELECT node, CASE
        WHEN regexp_matches(t, '(?i)^https?://') THEN substr(t, strpos(t, '://') + 3)
        WHEN starts_with(t, '//') THEN substr(t, 3)
        WHEN starts_with(t, '/') THEN host || t
        WHEN t = '' OR regexp_matches(t, '^#|^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL
        WHEN starts_with(t, '?') THEN host || path || t
        ELSE host || CASE WHEN strpos(path, '/') > 0 THEN regexp_extract(path, '^(.*/)', 1) ELSE '/' END || t END AS rest
    FROM found
),
edge AS (
    SELECT node AS a,
        translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
        || CASE WHEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) END
        || coalesce(regexp_extract(rest, '^[^?#]*(\?[^#]*)?', 1), '') AS b
    FROM aimed WHERE node IS NOT NULL AND regexp_extract(rest, '^([^/?#]*)', 1) <> ''
),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach(a, b) AS (
    SELECT a, a FROM both_ways
    UNION
    SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b
),
rules(rule, host, start, allow) AS (
    VALUES ('net/', 'net', '/', 0), ('example.net/en/', 'example.net', '/en/', 1),
           ('example.com/de/', 'example.com', '/de/', 0), ('org/fr/', 'org', '/fr/', 1)
),
nodes AS (
    SELECT DISTINCT b AS node, regexp_extract(b, '^([^/?#]*)', 1) AS host,
        regexp_extract(b, '^[^/?#]*([^?#]*)', 1) AS path FROM reach
),
node_rule AS (
    SELECT n.node, arg_max(r.allow, length(r.rule)) AS allow
    FROM nodes n JOIN rules r ON (n.host = r.host OR n.host LIKE '%.' || r.host) AND starts_with(n.path, r.start)
    GROUP BY n.node
),
class AS (SELECT r.a AS node, max(x.allow) AS allow FROM reach r JOIN node_rule x ON x.node = r.b GROUP BY r.a),
page_rule AS (
    SELECT DISTINCT ON (n.host, n.path) n.host, n.path, r.rule, r.allow
    FROM (SELECT DISTINCT host, path FROM named) n
    JOIN rules r ON (n.host = r.host OR n.host LIKE '%.' || r.host) AND starts_with(n.path, r.start)
    ORDER BY n.host, n.path, length(r.rule) DESC
)
SELECT n.page_id, n.host, n.path, p.rule,
    CASE coalesce(p.allow, c.allow, 1) WHEN 1 THEN 'allow' ELSE 'block' END AS verdict
FROM named n
LEFT JOIN page_rule p ON p.host = n.host AND p.path = n.path
LEFT JOIN class c ON c.node = n.node
"""

MIX_SOURCES = """
WITH sizes AS (
    SELECT source, sum(coalesce(length(text), 0)) AS chars,
        CASE source WHEN 'src0' THEN 4.0 WHEN 'src1' THEN 3.0 WHEN 'src2' THEN 2.0 WHEN 'src3' THEN 0.5 ELSE 1.0 END::DOUBLE AS weight
    FROM documents GROUP BY source
),
whole AS (SELECT sum(chars)::DOUBLE AS chars, round(sum(weight), 9) AS weight FROM sizes WHERE chars > 0),
rates AS (
    SELECT s.source, CASE WHEN s.chars > 0 THEN round(s.weight / w.weight * w.chars / s.chars, 9) ELSE 1.0 END AS rate
    FROM sizes s CROSS JOIN whole w
),
parts AS (SELECT source, rate, greatest(1, ceil(rate / 256.0))::BIGINT AS parts FROM rates),
cumulated AS (
    SELECT p.source, k, sum(exp(k * ln(rate / parts) - rate / parts - lgamma(k + 1)))
        OVER (PARTITION BY p.source ORDER BY k) AS below
    FROM parts p, range(0, 600) AS t(k)
    WHERE rate > 0 AND k <= ceil(rate / parts + 12 * sqrt(rate / parts) + 24)
),
draws AS (
    SELECT d.doc_id, d.source, i,
        ('0x' || substr(md5('17:' || coalesce(d.doc_id::VARCHAR, '-') || ':' || i::VARCHAR), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM documents d JOIN parts p ON p.source IS NOT DISTINCT FROM d.source, unnest(range(1, p.parts + 1)) AS x(i)
),
counted AS (
    SELECT doc_id, source, i, (SELECT count(*) FROM cumulated c WHERE c.source IS NOT DISTINCT FROM d.source AND c.below <= d.u) AS n
    FROM draws d
),
copied AS (SELECT doc_id, source, sum(n)::INTEGER AS copies FROM counted GROUP BY doc_id, source),
exploded AS (SELECT doc_id, source, copies, x.copy::INTEGER AS copy FROM copied, unnest(range(0, copies)) AS x(copy))
SELECT doc_id, source, copies, copy,
    row_number() OVER (ORDER BY
        ('0x' || substr(md5('18:' || coalesce(doc_id::VARCHAR, '-') || ':' || copy::VARCHAR), 1, 13))::BIGINT,
        doc_id NULLS FIRST, copy) - 1 AS position
FROM exploded
"""

CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
sized AS (
    SELECT *, len(regexp_extract_all(role, '\\|<\|turn\|>|<\|text\|>|<s>|</s>|\[INST\]|\[/INST\]'))
        + len(regexp_extract_all(text, '\\|<\|turn\|>|<\|text\|>|<s>|</s>|\[INST\]|\[/INST\]'))
        + length(role) + length(text) + 21 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
    sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn NULLS FIRST, role, text)) AS loss_sha256,
    sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0))), 0)::BIGINT AS score
    FROM (SELECT DISTINCT vec_id, v FROM vectors WHERE vec_id % 50 = 0) q
    JOIN vectors c ON c.vec_id <> q.vec_id
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

COLLOCATIONS = r"""
WITH
piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
line AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM piece
),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM line GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM line WHERE len(w) > 0),
suffix AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS m FROM place),
counted AS (
    SELECT lang, w[i:i + m - 1] AS ws, m, count(*) AS f FROM suffix GROUP BY ALL HAVING count(*) >= 30
),
cut AS (
    SELECT c.lang, c.ws, c.m, c.f AS a, k, l.f AS l, r.f AS r,
        CAST((2000000::HUGEINT * c.f) // (l.f + r.f) AS BIGINT) AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM counted WHERE m > 1) c
    JOIN counted l ON l.lang = c.lang AND l.ws = c.ws[1:k]
    JOIN counted r ON r.lang = c.lang AND r.ws = c.ws[k + 1:]
),
lowest AS (
    SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ws ORDER BY score, k) = 1
),
inner_part AS (
    SELECT lang, ws[i:i + s - 1] AS ws, max(f) AS longer
    FROM (SELECT *, unnest(range(1, m - s + 2)) AS i
        FROM (SELECT *, unnest(range(2, m)) AS s FROM counted WHERE m > 2))
    GROUP BY ALL
),
kept AS (
    SELECT c.*, array_to_string(c.ws, ' ') AS phrase FROM lowest c
    LEFT JOIN inner_part p ON p.lang = c.lang AND p.ws = c.ws
    WHERE p.longer IS NULL OR 100 * p.longer < 80 * c.a
),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op2_url_filters": URL_FILTERS,
    "op3_mix_sources": MIX_SOURCES,
    "op6_chat_format": CHAT_FORMAT,
    "op8_top_k": TOP_K,
    "op12_collocations": COLLOCATIONS,
}
