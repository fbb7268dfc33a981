"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Measures of every document, by row; ``{docs}`` is a table with rid, doc_id, source and text.
MEASURES = rf"""
q_words AS (
  SELECT rid, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM {{docs}}
), q_grams AS (
  SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM q_words WHERE len(ws) >= 3)
), q_starts AS (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS following
  FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM q_grams) WHERE n > 1
), q_repeats AS (
  SELECT rid, sum(least(3, coalesce(following - i, 3)))::BIGINT AS n FROM q_starts GROUP BY rid
), q_lines AS (
  SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS lines FROM q_words
), q_measures AS (
  SELECT w.rid, w.doc_id, w.source, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(r.n, 0)::BIGINT AS n_repeat_words
  FROM q_words w JOIN q_lines USING (rid) LEFT JOIN q_repeats r USING (rid)
)"""

_RULES = {
    "short": "n_words < 50",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "repeats": "100 * n_repeat_words > 50 * n_words",
}
_RATE = " OR ".join(
    f"""(f_{r} + pf_{r} / pd * s_{r}) / (n + s_{r}) > 0.5""" for r in _RULES
)
#: Verdicts by document on top of MEASURES.
VERDICTS = f"""
q_hosts AS (
  SELECT source, count(*)::DOUBLE AS n, {', '.join(f'(count(*) FILTER ({c}))::DOUBLE AS f_{r}' for r, c in _RULES.items())}
  FROM q_measures WHERE source IS NOT NULL GROUP BY source
), q_sums AS (
  SELECT sum(n) AS pd, {', '.join(f'sum(f_{r}) AS pf_{r}, sum(f_{r} * f_{r} / n) AS pq_{r}' for r in _RULES)} FROM q_hosts
), q_prior AS (
  SELECT *, {', '.join(f'''CASE WHEN pq_{r} / pd - (pf_{r} / pd) ** 2 > 0
    THEN greatest(1.0, least(1000000.0, (pf_{r} / pd) * (1 - pf_{r} / pd) / (pq_{r} / pd - (pf_{r} / pd) ** 2) - 1))
    ELSE 1000000.0 END AS s_{r}''' for r in _RULES)} FROM q_sums
), q_rejected AS (
  SELECT source FROM q_hosts, q_prior WHERE {_RATE}
), q_judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM q_measures
)"""

#: Spans of a pattern: positions follow from what stands between the matches.
_PATTERNS = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
    ("live", "[A-Za-z0-9+/_=-]{20,}", 0, 20),
)


def _spans(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""
    SELECT rid, {number} AS k, '{kind}' AS kind, begins AS s, begins + n AS e, value FROM (
      SELECT rid, value, n, (sum(gap) OVER w + coalesce(sum(n) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS begins
      FROM (SELECT rid, i, length(p[i]) AS gap, length(m[i]) AS n, v[i] AS value FROM (
        SELECT rid, p, m, v, unnest(range(1, len(m) + 1)) AS i FROM (
          SELECT rid, string_split_regex(t, '{pattern}') AS p, regexp_extract_all(t, '{pattern}', 0) AS m, regexp_extract_all(t, '{pattern}', {group}) AS v
          FROM s_docs WHERE regexp_matches(t, '{pattern}'))))
      WINDOW w AS (PARTITION BY rid ORDER BY i)
    ) WHERE length(value) >= {least}"""


SECRETS = f"""
WITH s_docs AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
s_base AS ({' UNION ALL '.join(_spans(k, *x) for k, x in enumerate(_PATTERNS[:3]))}),
s_tokens AS (
  SELECT * FROM ({_spans(3, *_PATTERNS[3])}) x
  WHERE regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND len(list_distinct(string_split(value, ''))) >= 10
    AND NOT EXISTS (SELECT 1 FROM s_base b WHERE b.rid = x.rid AND b.s <= x.s AND b.e >= x.e)
),
s_all AS (SELECT * FROM s_base UNION ALL SELECT * FROM s_tokens),
s_owned AS (
  SELECT value, count(DISTINCT coalesce(source, chr(0))) <= 2 AND count(DISTINCT (coalesce(source, chr(0)), doc_id)) <= 20 AS live FROM s_all JOIN s_docs USING (rid) GROUP BY value
),
s_marks AS (SELECT a.*, live, kind || ':' || s || ':' || e AS name FROM s_all a JOIN s_owned USING (value)),
s_sums AS (
  SELECT rid, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
    coalesce(string_agg(name, ',' ORDER BY s, k) FILTER (k < 3), '') AS base,
    coalesce(string_agg(name, ',' ORDER BY s, k) FILTER (k < 3 OR live), '') AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
  FROM s_marks GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM s_docs LEFT JOIN s_sums USING (rid)"""

JACCARD = rf"""
WITH RECURSIVE j_docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), j_words AS (
  SELECT rid, doc_id, regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS ws FROM j_docs
), j_sets AS (
  SELECT DISTINCT rid, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM j_words WHERE len(ws) >= 3)
  UNION ALL SELECT rid, array_to_string(ws, ' ') FROM j_words WHERE len(ws) IN (1, 2)
), j_sizes AS (
  SELECT rid, count(*) AS n FROM j_sets GROUP BY rid
), j_links AS (
  SELECT x.a, x.b FROM (
    SELECT l.rid AS a, r.rid AS b, count(*) AS c FROM j_sets l JOIN j_sets r ON l.gram = r.gram AND l.rid <> r.rid GROUP BY 1, 2
  ) x JOIN j_sizes p ON p.rid = a JOIN j_sizes q ON q.rid = b WHERE 100 * c >= 90 * (p.n + q.n - c)
), j_reach AS (
  SELECT rid, rid AS other FROM j_words UNION SELECT r.rid, l.b FROM j_reach r JOIN j_links l ON l.a = r.other
)
SELECT w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM j_words w LEFT JOIN j_sizes USING (rid)
JOIN (SELECT r.rid, min(o.doc_id) AS component_id FROM j_reach r JOIN j_docs o ON o.rid = r.other GROUP BY r.rid) USING (rid)"""

REPEATS = """
WITH r_docs AS (
  SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), r_bytes AS (
  SELECT *, length(h) // 2 AS n FROM r_docs
), r_windows AS (
  SELECT rid, pos, md5(substr(h, 2 * pos + 1, 400)) AS window_hash FROM (SELECT rid, h, unnest(range(0, n - 199)) AS pos FROM r_bytes WHERE n >= 200)
), r_twice AS (
  SELECT window_hash FROM r_windows GROUP BY 1 HAVING count(*) > 1
), r_starts AS (
  SELECT rid, pos, pos - lag(pos) OVER (PARTITION BY rid ORDER BY pos) AS step FROM r_windows JOIN r_twice USING (window_hash)
), r_numbered AS (
  SELECT rid, pos, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY pos) AS span FROM r_starts
), r_spans AS (
  SELECT rid, min(pos) AS a, max(pos) + 200 AS z FROM r_numbered GROUP BY rid, span
), r_pieces AS (
  SELECT rid, a, z, lag(z, 1, 0) OVER (PARTITION BY rid ORDER BY a) AS since FROM r_spans
), r_cut AS (
  SELECT rid, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last, string_agg(substr(h, 2 * since + 1, 2 * (a - since)), '' ORDER BY a) AS head
  FROM r_pieces JOIN r_bytes USING (rid) GROUP BY rid
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE head || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM r_bytes LEFT JOIN r_cut USING (rid)"""

COPIES = """
WITH c_docs AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
  row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
FROM c_docs"""

#: CRC-32 goes byte by byte through its table; of two near words one is the other, or both are the same, without a letter.
VARIANTS = """
WITH RECURSIVE v_table AS (
  SELECT list_transform(range(256), lambda k: list_reduce(list_concat([k], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_table
), v_runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS head, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), v_long AS (
  SELECT head, run, count(*) AS n FROM v_runs WHERE length(run) >= 6 GROUP BY ALL
), v_heads AS (
  SELECT head, list_reduce(list_concat([4294967295], list_transform(string_split(head, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])) AS start
  FROM (SELECT DISTINCT head FROM v_long), v_table
), v_bytes AS (
  SELECT run, flatten(list_transform(string_split(run, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT]
    ELSE [192 + (unicode(x)::BIGINT >> 6), 128 + (unicode(x)::BIGINT & 63)] END)) AS codes FROM (SELECT DISTINCT run FROM v_long)
), v_hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(list_concat([start], codes), lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) AS h
  FROM v_long JOIN v_heads USING (head) JOIN v_bytes USING (run), v_table
), v_words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM v_hashed
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), v_cuts AS (
  SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v_words)
), v_near AS (
  SELECT x.word, y.word AS other FROM v_cuts x JOIN v_cuts y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word AND length(x.word) = length(y.word)
  UNION SELECT word, rest FROM v_cuts WHERE rest IN (SELECT word FROM v_words)
  UNION SELECT rest, word FROM v_cuts WHERE rest IN (SELECT word FROM v_words)
), v_best AS (
  SELECT v.word, v.n, count(*) AS n_near, max(o.n) AS best_n, (list(other ORDER BY o.n DESC, other))[1] AS best
  FROM v_near JOIN v_words v USING (word) JOIN v_words o ON o.word = other GROUP BY v.word, v.n
), v_forms AS (
  SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN best_n >= 5 * v.n THEN best END AS form, CASE WHEN best_n >= 5 * v.n THEN best_n END AS form_n
  FROM v_words v LEFT JOIN v_best USING (word)
), v_ways AS (
  SELECT word, word AS root, 0 AS step FROM v_forms
  UNION ALL SELECT w.word, f.form, step + 1 FROM v_ways w JOIN v_forms f ON f.word = w.root WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n
FROM v_forms JOIN (SELECT word, arg_max(root, step) AS root FROM v_ways GROUP BY word) USING (word)"""

TRIE = """
WITH t_table AS (
  SELECT list_transform(range(256), lambda k: list_reduce(list_concat([k], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS crc_table
), t_turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS t,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), t_convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
    xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1]))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t_turns), t_table
), t_rebuilt AS (
  SELECT c.conv_id, 0 AS part, pos, role, t FROM t_convs c JOIN t_turns o ON o.conv_id = c.base AND pos <= h
  UNION ALL SELECT conv_id, 1, pos, role, t FROM t_convs JOIN t_turns USING (conv_id) WHERE pos > h
), t_paths AS (
  SELECT conv_id, row_number() OVER w AS depth, strlen(t) AS bytes, string_agg(md5(length(role) || ':' || role || t), '') OVER w AS path
  FROM t_rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT conv_id, 0, 0, '' FROM t_convs
), t_nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes FROM t_paths GROUP BY depth, path
), t_kids AS (
  SELECT left(path, length(path) - 32) AS path, count(*) AS n_children FROM t_nodes WHERE depth > 0 GROUP BY 1
), t_ends AS (
  SELECT path, string_agg(conv_id, ',' ORDER BY conv_id) AS ids FROM (SELECT conv_id, arg_max(path, depth) AS path FROM t_paths GROUP BY conv_id) GROUP BY path
), t_sums AS (
  SELECT left(n.path, 32 * up) AS path, count(*) FILTER (n_children IS NULL) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS up FROM t_nodes) n LEFT JOIN t_kids k ON k.path = n.path GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM t_nodes n JOIN t_sums s ON s.path = n.path LEFT JOIN t_kids k ON k.path = n.path LEFT JOIN t_ends e ON e.path = n.path
LEFT JOIN t_nodes p ON n.depth > 0 AND p.path = left(n.path, length(n.path) - 32)"""

SQL: dict[str, str] = {
    "op3_lyndon_suffix_dedup": REPEATS,
    "op8_host_quality_rules": f"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, source, text FROM documents),
{MEASURES.format(docs='numbered')},
{VERDICTS}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND (source IS NULL OR source NOT IN (SELECT source FROM q_rejected)) AS kept
FROM q_judged""",
    "op7_count_tree_jaccard": JACCARD,
    "op10_secret_ownership": SECRETS,
    "op11_banded_list_variants": VARIANTS,
    "op12_block_prefix_trie": TRIE,
    "op13_chunk_recipe_dedup": COPIES,
}
