"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force in tests/llm."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_RULES = """
rules(verdict, rule, host, path) AS (VALUES
    ('allow', 'org/', 'org', '/'), ('block', 'example.org/es/', 'example.org', '/es/'),
    ('block', 'example.org/en/1', 'example.org', '/en/1'), ('allow', 'com/fr/', 'com', '/fr/'), ('block', 'com/de/', 'com', '/de/'))
"""


def _host(url: str) -> str:
    return f"translate(coalesce(regexp_extract({url}, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _path(url: str) -> str:
    return f"coalesce(regexp_extract({url}, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '')"


def _longest(what: str) -> str:
    return (f"(SELECT {what} FROM rules r WHERE (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) "
            "ORDER BY length(r.rule) DESC LIMIT 1)")


# Links: canonical ones with a whole url, which the tests hold against the operator's other forms.
ORACLE["op1_url_filter"] = f"""
WITH RECURSIVE {_RULES},
tags AS (SELECT url, unnest(regexp_extract_all(html, '(?i)<link\\s[^>]*canonical[^>]*>')) AS tag FROM pages WHERE contains(url, '://')),
edges AS (
    SELECT regexp_replace(url, '#.*$', '', 's') AS a, regexp_replace(regexp_extract(tag, '(?i)href\\s*=\\s*"([^"]*)"', 1), '#.*$', '', 's') AS b FROM tags),
links AS (SELECT a, b FROM edges WHERE b LIKE '%://%' UNION SELECT b, a FROM edges WHERE b LIKE '%://%'),
reach(a, b) AS (SELECT a, a FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
blocked AS (
    SELECT DISTINCT a FROM (SELECT a, {_host('b')} AS host, {_path('b')} AS path FROM reach) u WHERE {_longest('r.verdict')} = 'block'),
judged AS (
    SELECT page_id, regexp_replace(url, '#.*$', '', 's') AS node, {_host('url')} AS host, {_path('url')} AS path FROM pages)
SELECT page_id, host, path, {_longest('r.rule')} AS rule,
    coalesce({_longest('r.verdict')}, CASE WHEN node IN (SELECT a FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM judged u
"""

ORACLE["op3_block_names"] = """
WITH n AS (
    SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
    row_number() OVER w = 1 AS kept, sha256(norm) AS text_sha256
FROM n WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id)
"""

ORACLE["op5_uniform_topk"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::HUGEINT) AS vec FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

_H = "CAST('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), {0}, 8) AS BIGINT)"

ORACLE["op11_fill_middle"] = f"""
WITH t AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, {_H.format(1)} AS h1, {_H.format(9)} AS h2,
        {_H.format(17)} AS h3, {_H.format(25)} AS h4 FROM documents),
c AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
            WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM t),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM p
"""

_BYTES = "list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)"
_CRC32 = f"""xor(4294967295, list_reduce(list_concat([4294967295], {_BYTES}), lambda a, b:
    list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))))"""

ORACLE["op12_prefix_trie"] = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT DISTINCT conv_id, {_CRC32} % 4 AS h FROM t),
rebuilt AS (
    SELECT c.conv_id, 0 AS part, t.pos, t.role, t.text FROM convs c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.pos <= c.h
    UNION ALL SELECT c.conv_id, 1, t.pos, t.role, t.text FROM convs c JOIN t USING (conv_id) WHERE t.pos > c.h),
paths AS (
    SELECT conv_id, list([length(role)::VARCHAR, role, text] ORDER BY part, pos) AS path FROM rebuilt GROUP BY conv_id
    UNION ALL SELECT conv_id, [] FROM convs WHERE conv_id NOT IN (SELECT conv_id FROM rebuilt)),
members AS (SELECT conv_id, len(path) AS total, unnest(range(len(path) + 1)) AS depth, path FROM paths),
prefixes AS (SELECT conv_id, total, depth, sha256(path[1:depth]::VARCHAR) AS name, sha256(path[1:depth - 1]::VARCHAR) AS above, path[depth][3] AS last FROM members),
nodes AS (
    SELECT name, depth, min(conv_id) AS conv_id, CASE WHEN depth > 0 THEN any_value(above) END AS above, count(*) AS n_convs,
        max(total) = depth AS leaf, coalesce(len(list_filter(regexp_split_to_array(any_value(last), '[\x20\x09-\x0D]+'), lambda w: w <> '')), 0) AS words,
        sha256(coalesce(string_agg(CASE WHEN total = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256
    FROM prefixes GROUP BY name, depth),
below AS (
    SELECT p.name, p.depth, sum(v.leaf::INT) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
    FROM nodes v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.name, p.depth)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs,
    (SELECT count(*) FROM nodes k WHERE k.above = n.name AND k.depth = n.depth + 1) AS n_children, b.n_leaves::BIGINT AS n_leaves,
    b.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN below b ON b.name = n.name AND b.depth = n.depth LEFT JOIN nodes u ON u.name = n.above AND u.depth = n.depth - 1
"""

ORACLE["op13_pca_tiles"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS vec FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.vec) = len(y.vec)
    WHERE list_cosine_similarity(x.vec, y.vec) >= 0.93),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
tops AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, t.component_id, e.vec_id = t.component_id AS kept
FROM embeddings e JOIN tops t ON t.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""
