"""DuckDB SQL that computes the same rows as the registered queries.

Independent of the operators' code: the texts below restate the contracts.
Queries that SQL cannot express are absent and tested against brute force.
"""

from __future__ import annotations

OP9 = r"""
WITH a AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) AS path FROM a),
c AS (SELECT *, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                     WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                     WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                     WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM b)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM c
"""

#: Eight-word windows of the whole text; the line rules are those of quality_rules.py, restated.
OP2 = r"""
WITH l AS (SELECT doc_id, doc_id AS rid, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS ln
           FROM documents),
w AS (SELECT rid, ln, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws,
             length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars,
             length(regexp_replace(line, '[^#*$%&|<>]', '', 'g')) AS syms FROM l),
f AS (SELECT *, len(ws) AS n, len([x FOR x IN ws IF x IN ('|', '>', '/', '::', '·', '•', '»', '›')]) AS parted,
             translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
             row_number() OVER (PARTITION BY rid, line ORDER BY ln) > 1 AS again FROM w),
j AS (SELECT *, n > 0 AND ((syms * 100 > 10 * chars AND 4 * parted < n)
             OR 2 * len([x FOR x IN ws IF regexp_matches(x, '[!?]{2,}$')]) >= n
             OR (n >= 40 AND NOT regexp_matches(line, '\p{P}'))
             OR (parted >= 2 AND 4 * parted >= n)
             OR (n >= 8 AND 2 * len([x FOR x IN range(1, n) IF ws[x] = ws[x + 1]]) > n)
             OR (n <= 6 AND regexp_matches(low, '^(home|menu|log in|login|sign in|sign up|skip to content|next page|previous page|back to top|site map|sitemap)([^0-9a-z]|$)'))
             OR (n <= 20 AND regexp_matches(low, 'all rights reserved|terms of use|terms of service|privacy policy|cookie policy|uses cookies|enable javascript|lorem ipsum|subscribe to our newsletter|click here|follow us on|share this page|powered by'))) AS bad FROM f),
s AS (SELECT rid, sum(n)::BIGINT AS n_words, sum(chars)::BIGINT AS word_chars, sum(syms)::BIGINT AS n_symbols,
             count(*) FILTER (n > 0 AND again) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
             coalesce(sum(n) FILTER (NOT bad), 0)::BIGINT AS n_kept_words FROM j GROUP BY rid),
u AS (SELECT rid, unnest(x) AS word, unnest(range(len(x))) AS i
      FROM (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS x FROM (SELECT *, doc_id AS rid FROM documents))),
g AS (SELECT rid, i, CASE WHEN count(*) OVER v = 8 THEN list(word) OVER v END AS gram FROM u
      WINDOW v AS (PARTITION BY rid ORDER BY i ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
h AS (SELECT rid, i, gram IS NOT NULL AND count(*) OVER (PARTITION BY rid, gram) > 1 AS hit FROM g),
r AS (SELECT rid, count(*) FILTER (c) AS n_repeat_words
      FROM (SELECT rid, coalesce(bool_or(hit) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW), false) AS c FROM h) GROUP BY rid),
t AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars, coalesce(n_symbols, 0) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(n_kept_words, 0) AS n_kept_words
      FROM (SELECT doc_id, doc_id AS rid FROM documents) d LEFT JOIN s USING (rid) LEFT JOIN r USING (rid))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * (n_words - n_kept_words) <= 50 * n_words AS kept FROM t
"""

#: kind, pattern, group whose length counts, least length.
_SECRETS = [
    ("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", "(AKIA[A-Z0-9]+)", 1, 18),
    ("hex", "([0-9a-f]+)", 1, 16),
    # DuckDB's patterns cannot look ahead: where a key has no END line and a later one has, this takes both as one
    ("private_key", "(-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----(?:(?s:.*?)-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----)?)", 1, 1),
    ("git_token", "(gh[pousr]_[A-Za-z0-9]+)", 1, 40),
    ("chat_token", "(xox[abprs]-[A-Za-z0-9-]+)", 1, 20),
    ("cloud_key", "(AIza[A-Za-z0-9_-]+)", 1, 39),
    ("pay_key", "([sr]k_(?:live|test)_[A-Za-z0-9]+)", 1, 24),
    # nor back: a token right after a hyphen counts here
    ("web_token", r"\b(eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,})", 1, 1),
    ("url_login", r"(://[^\s/:@]+:[^\s/:@]{3,}@)", 1, 1),
]


def _secrets_sql() -> str:
    """Offsets of all matches: lengths of the pieces between matches and of the matches, summed up."""
    kinds = []
    for n, (kind, pattern, group, least) in enumerate(_SECRETS):
        p = pattern.replace("'", "''")
        kinds.append(f"""
SELECT doc_id, {n} AS k, '{kind}' AS kind,
       list_sum(between[1:i]) + coalesce(list_sum(size[1:i - 1]), 0) AS a, list_sum(between[1:i]) + list_sum(size[1:i]) AS b
FROM (SELECT doc_id, m, g, [len(x) FOR x IN string_split_regex(text, '{p}')] AS between, [len(x) FOR x IN m] AS size, unnest(range(1, len(m) + 1)) AS i
      FROM (SELECT doc_id, text, regexp_extract_all(text, '{p}', 0) AS m, regexp_extract_all(text, '{p}', {group}) AS g
            FROM documents WHERE regexp_matches(text, '{p}')))
WHERE len(g[i]) >= {least}""")
    return f"""
WITH s AS ({" UNION ALL ".join(kinds)}),
t AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
             coalesce(string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, k) FILTER (k < 3), '') AS base,
             string_agg(kind || ':' || a::BIGINT || ':' || b::BIGINT, ',' ORDER BY a, k) AS spans FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN t USING (doc_id)
"""


OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(w[i:least(i + 12, len(w))], ' ') AS gram, least(13, len(w)) AS n
      FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n),
h AS (SELECT doc_id, i, p.n, item_id FROM p JOIN g ON g.n = p.n AND g.gram = array_to_string(w[i:i + p.n - 1], ' ')),
c AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM h) GROUP BY doc_id)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""

#: The CRC-32 runs over a list of the id's bytes, each followed by eight bit steps (-1).
OP11 = r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 5 AS base,
             xor(list_reduce(flatten([[ascii(x), -1, -1, -1, -1, -1, -1, -1, -1] FOR x IN string_split(conv_id::VARCHAR, '')]),
                             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x::BIGINT) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, 4294967295::BIGINT),
                 4294967295::BIGINT) % 9 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos < c.h
      UNION ALL SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h),
s AS (SELECT c.conv_id, coalesce(list({'role': r.role, 'text': r.text} ORDER BY r.pos) FILTER (r.pos IS NOT NULL), []) AS said
      FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
p AS (SELECT conv_id, said, unnest(range(0, len(said) + 1)) AS d FROM s),
n AS (SELECT said[1:d] AS path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(said) = d), '')) AS ends_sha256
      FROM p GROUP BY ALL),
k AS (SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(n.path[depth].text) ELSE 0 END AS own
      FROM n LEFT JOIN k ON k.path = n.path),
u AS (SELECT path[1:i] AS path, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens
      FROM (SELECT path, n_children, own, unnest(range(0, depth + 1)) AS i FROM f) GROUP BY ALL)
SELECT f.conv_id, f.depth, b.conv_id AS parent_conv_id, f.n_convs, f.n_children, u.n_leaves, u.saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM f JOIN u ON u.path = f.path LEFT JOIN n b ON f.depth > 0 AND b.path = f.path[1:f.depth - 1]
"""

SQL = {
    "op11_conversation_trie": OP11,
    "op4_decontaminate": OP4,
    "op2_quality_rules": OP2,
    "op6_secret_scan": _secrets_sql(),
    "op9_url_filter": OP9,
}
