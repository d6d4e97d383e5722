"""The same results as DuckDB SQL, where SQL can express them."""

from candlewick.llm import licenses, quality_rules

ORACLE_SQL: dict[str, str] = {}

_WORDS = r"'[^\x20\x09-\x0D]+'"

ORACLE_SQL["op3_quality_rules"] = rf"""
WITH d AS (
 SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, {_WORDS}) AS ws FROM d),
trigrams AS (
 SELECT r, unnest(range(1, len(ws) - 1)) AS i, ws FROM w WHERE len(ws) >= 3),
keyed AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM trigrams),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM keyed) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
lines AS (SELECT r, line FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_WORDS})),
line_counts AS (SELECT r, count(*) AS n, count(DISTINCT line) AS u FROM lines GROUP BY r),
m AS (
 SELECT doc_id, len(ws)::BIGINT AS n_words,
  length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  coalesce(lc.n - lc.u, 0)::BIGINT AS n_dup_lines, coalesce(lc.n, 0)::BIGINT AS n_lines,
  coalesce(c.n, 0)::BIGINT AS n_repeat_words,
  (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_upper,
  (length(t) - length(regexp_replace(t, '[A-Za-z]', '', 'g')))::BIGINT AS n_letters
 FROM d JOIN w USING (r) LEFT JOIN line_counts lc USING (r) LEFT JOIN covered c USING (r)),
b AS (
 SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > 2 * n_words)::INT
  + 8 * (n_letters > 0 AND 2 * n_upper > n_letters)::INT + 16 * (word_chars < 2 * n_words)::INT
  + 32 * (word_chars > 20 * n_words)::INT + 64 * (10 * n_dup_lines > 5 * n_lines)::INT)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
 failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""

_RULE_ROWS = ", ".join(f"('{rule}', {1 << quality_rules.RULES.index(rule)})" for rule in quality_rules.PRODUCTION.rules)

ORACLE_SQL["rule_ablation"] = f"""
WITH ledger AS ({ORACLE_SQL["op3_quality_rules"]}), rules(rule, bit) AS (VALUES {_RULE_ROWS})
SELECT rule, count(*) FILTER (failed_bits & bit <> 0) AS n_failed, count(*) FILTER (failed_bits & {quality_rules.PRODUCTION.mask} = bit) AS n_only
FROM rules CROSS JOIN ledger GROUP BY rule
"""


_TEMPLATES = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(licenses.TEMPLATES))
_ROWS = "(SELECT row_number() OVER () AS r, * FROM documents)"

ORACLE_SQL["op7_license_scan"] = rf"""
WITH files AS MATERIALIZED (
 SELECT r, doc_id, concat_ws('/', source, lang, doc_id) AS path, coalesce(text, '') AS t FROM {_ROWS}),
placed AS (
 SELECT *, CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS dir,
  regexp_matches(regexp_extract(path, '[^/]*$'), '{licenses.LICENCE_NAME}') AS named FROM files),
templates(template, licence, body) AS (VALUES {_TEMPLATES}),
template_terms AS (
 SELECT template, licence, term, count(*) AS n FROM (SELECT template, licence, unnest(regexp_extract_all(lower(body), '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL),
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM templates)) / (1 + count(*))) + 1 AS idf FROM template_terms GROUP BY term),
template_weights AS (
 SELECT template, licence, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS w FROM template_terms JOIN idf USING (term)),
units AS (
 SELECT r, false AS whole, unnest(list_distinct(string_split(t, chr(10)) || string_split_regex(t, '{licenses.BLANK}'))) AS u FROM files
 UNION ALL SELECT r, true, t FROM files),
numbered AS (SELECT row_number() OVER () AS k, r, whole, u FROM units),
counted AS (
 SELECT k, r, whole, term, count(*) AS n FROM (SELECT k, r, whole, unnest(regexp_extract_all(lower(u), '[a-z0-9]+')) AS term FROM numbered) GROUP BY ALL),
weighted AS (
 SELECT k, r, whole, term, n * coalesce(idf, ln(1 + (SELECT count(*) FROM templates)) + 1) AS x FROM counted LEFT JOIN idf USING (term)),
norms AS (SELECT k, sqrt(sum(x * x)) AS norm FROM weighted GROUP BY k),
cosines AS (
 SELECT r, whole, licence, round(sum(x * w) / any_value(norm), 6) AS c
 FROM weighted JOIN template_weights USING (term) JOIN norms USING (k) GROUP BY k, r, whole, template, licence),
own AS (
 SELECT r, first(licence ORDER BY c DESC, licence) AS own, max(c) AS c, max(CASE WHEN whole THEN c END) AS wc
 FROM cosines WHERE c >= {licenses.THRESHOLD} GROUP BY r),
rows AS (SELECT * FROM placed LEFT JOIN own USING (r)),
by_dir AS (
 SELECT dir, first(own ORDER BY c DESC, own) AS licence, max(c) AS c FROM rows
 WHERE own IS NOT NULL AND (named OR coalesce(wc, 0) >= {licenses.FILE_THRESHOLD}) GROUP BY dir),
near AS (
 SELECT d.dir, b.dir AS directory, b.licence, b.c FROM (SELECT DISTINCT dir FROM placed) d
 JOIN by_dir b ON b.dir = d.dir OR b.dir = '' OR starts_with(d.dir, b.dir || '/')),
nearest AS (
 SELECT dir, first(directory ORDER BY length(directory) DESC) AS directory, first(licence ORDER BY length(directory) DESC) AS licence,
  first(c ORDER BY length(directory) DESC) AS c FROM near GROUP BY dir)
SELECT doc_id, path, coalesce(own, n.licence) AS licence, coalesce(rows.c, n.c) AS cosine,
 CASE WHEN own IS NOT NULL THEN 'own' WHEN n.dir IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
 CASE WHEN own IS NULL THEN n.directory END AS directory
FROM rows LEFT JOIN nearest n ON n.dir = rows.dir
"""


ORACLE_SQL["op12_maxscore"] = r"""
WITH v AS (
 SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x FROM embeddings
 WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (
 SELECT q.r, q.vec_id AS query_id, v.vec_id, list_inner_product(q.x, v.x)::BIGINT AS score
 FROM v AS q JOIN v ON q.vec_id % 50 = 0 AND v.vec_id IS DISTINCT FROM q.vec_id)
SELECT query_id, rank, vec_id, score FROM (
 SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored) WHERE rank <= 5
"""


# crc32 of the id's digits: every digit goes in, then eight times a bit out; 3988292384 is the polynomial.
ORACLE_SQL["op11_prefix_trie"] = r"""
WITH named AS (
 SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
 FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY i) AS turns FROM named GROUP BY conv_id),
crc AS (
 SELECT conv_id, turns, list_reduce(
  list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(conv_id::VARCHAR, ''), lambda c: [ord(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c FROM own),
lent AS (SELECT conv_id, turns, (xor(c, 4294967295) % 4)::BIGINT AS h FROM crc),
rebuilt AS (
 SELECT a.conv_id, list_concat(coalesce(b.turns[1:a.h], a.turns[1:0]), a.turns[a.h + 1:]) AS turns
 FROM lent AS a LEFT JOIN own AS b ON b.conv_id = a.conv_id - a.conv_id % 20),
member AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM rebuilt),
node AS (
 SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
 FROM member GROUP BY ALL),
children AS (SELECT path[1:depth - 1] AS path, count(*) AS n FROM node WHERE depth > 0 GROUP BY ALL),
valued AS (
 SELECT node.*, coalesce(n, 0) AS n_children,
  CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
 FROM node LEFT JOIN children USING (path)),
above AS (SELECT path, (n_children = 0)::BIGINT AS leaf, saved, unnest(range(0, depth + 1)) AS d FROM valued),
sums AS (SELECT path[1:d] AS path, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM above GROUP BY ALL)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, s.n_leaves, s.saved_tokens, sha256(v.ends) AS ends_sha256
FROM valued AS v JOIN sums AS s USING (path) LEFT JOIN node AS p ON v.depth > 0 AND p.path = v.path[1:v.depth - 1]
"""
