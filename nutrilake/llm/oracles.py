"""DuckDB SQL for the queries that SQL can express."""
from __future__ import annotations

OP1 = r"""
WITH lines AS (
  SELECT d.rowid AS r, d.doc_id, u.i, u.line,
         translate(trim(u.line, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT row_number() OVER () AS rowid, doc_id, coalesce(text, '') AS text FROM documents) d,
       LATERAL (SELECT unnest(string_split(d.text, chr(10))) AS line,
                       generate_subscripts(string_split(d.text, chr(10)), 1) AS i) u),
common AS (
  SELECT k, max(doc_id) AS keeper FROM lines WHERE length(k) >= 20
  GROUP BY k HAVING count(DISTINCT r) >= 3)
SELECT l.doc_id, count(*)::BIGINT AS n_lines,
       count(c.k) FILTER (WHERE c.keeper <> l.doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i)
              FILTER (WHERE c.k IS NULL OR c.keeper = l.doc_id), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.k = c.k GROUP BY l.r, l.doc_id
"""

OP6 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d)),
words AS (SELECT r, count(*)::BIGINT AS n_words, sum(length(w))::BIGINT AS word_chars FROM w GROUP BY r),
win AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n
  FROM (SELECT r, i, w AS a, lead(w) OVER o AS b, lead(w, 2) OVER o AS c FROM w
        WINDOW o AS (PARTITION BY r ORDER BY i)) WHERE c IS NOT NULL),
rep AS (
  SELECT r, count(DISTINCT p)::BIGINT AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM win WHERE n >= 2) GROUP BY r),
ln AS (
  SELECT r, len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines
  FROM (SELECT r, list_filter(string_split(t, chr(10)),
                              lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d)),
m AS (
  SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, n_lines
  FROM d JOIN ln USING (r) LEFT JOIN words USING (r) LEFT JOIN rep USING (r)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words)
           THEN 16 ELSE 0 END)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits & 31 = 0 AS kept, fail_bits FROM f
"""

OP7 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1, 2, 3][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w
  FROM d GROUP BY source),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
         sum(3 * source_size) OVER k AS capped, sum(w) OVER k AS capped_w
  FROM s WINDOW k AS (ORDER BY source_size::DOUBLE / w, source IS NULL, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT arg_min(level, k) AS level
  FROM (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / w, source IS NULL, source) AS k,
               (total - coalesce(capped, 0))::DOUBLE / (all_w - coalesce(capped_w, 0)) AS level FROM o)
  WHERE level * w <= 3 * source_size),
t AS (
  SELECT source, source_size,
         least(coalesce((SELECT level FROM l), 0) * w, (3 * source_size)::DOUBLE) AS target FROM s),
r AS (
  SELECT d.doc_id, size, source_size, target,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
           / 4503599627370496.0 AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r
"""

OP4 = r"""
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, e.vec_id, list_dot_product(q.v, e.v)::BIGINT AS score
  FROM e AS q JOIN e ON q.vec_id % 100 = 0 AND e.vec_id <> q.vec_id AND len(q.v) = len(e.v)),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank,
         vec_id, score FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

OP5 = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
g AS (
  SELECT r, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s
  FROM w),
t AS (SELECT r, len(s) AS n, unnest(s) AS x FROM g),
l AS (
  SELECT a.r AS p, b.r AS q FROM t a JOIN t b ON a.x = b.x AND a.r <> b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
c(r, q) AS (SELECT r, r FROM g UNION SELECT c.r, l.q FROM c JOIN l ON c.q = l.p)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, min(o.doc_id) AS component_id
FROM g JOIN c ON c.r = g.r JOIN g o ON o.r = c.q GROUP BY g.r, g.doc_id, g.s
"""

OP9 = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS r, conv_id, turn::BIGINT AS turn, role, coalesce(text, '') AS text
  FROM conversations),
x AS (
  SELECT r, conv_id, turn, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS i FROM m),
l AS (
  SELECT *, len(mark) - len(replace(mark, '>', '')) AS level,
         translate(trim(regexp_replace(regexp_replace(line, '^[\x20\x09]*>[\x20\x09>]*', ''),
                                       '[\x20\x09-\x0D]+', ' ', 'g')),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS passage
  FROM (SELECT *, regexp_extract(line, '^[\x20\x09]*>[\x20\x09>]*') AS mark FROM x)),
q AS (
  SELECT a.r, a.i, a.conv_id, a.turn, a.level, max(b.turn) AS src
  FROM l a LEFT JOIN l b ON a.conv_id IS NOT DISTINCT FROM b.conv_id AND a.passage = b.passage
       AND b.level = 0 AND b.turn < a.turn
  WHERE a.level > 0 AND a.passage <> '' GROUP BY ALL),
v AS (SELECT conv_id, turn, level, src, count(*) AS n FROM q WHERE src IS NOT NULL GROUP BY ALL),
p AS (
  SELECT conv_id, turn, arg_max(src, (-level, n, src)) AS parent, sum(n)::BIGINT AS n_linked
  FROM v GROUP BY ALL),
t(conv_id, turn, root, depth) AS (
  SELECT conv_id, turn, parent, 1::BIGINT FROM p
  UNION ALL
  SELECT t.conv_id, t.turn, p.parent, t.depth + 1
  FROM t JOIN p ON p.conv_id IS NOT DISTINCT FROM t.conv_id AND p.turn = t.root),
th AS (SELECT conv_id, turn, min(root) AS thread, max(depth) AS depth FROM t GROUP BY ALL),
s AS (
  SELECT r, count(*) FILTER (WHERE level > 0 AND passage <> '')::BIGINT AS n_quoted,
         bool_or(level > 0) AS any_quoted,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE level = 0 AND NOT (nxt > 0 AND
           regexp_matches(line, '(?i)(wrote|writes|said|schrieb|a écrit|escribió)[\x20\x09]*:[\x20\x09\x0D]*$'))), '') AS body
  FROM (SELECT *, coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) AS nxt FROM l) GROUP BY r),
o AS (
  SELECT m.conv_id, m.turn, m.role,
         CASE WHEN any_quoted THEN trim(body, chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)) ELSE m.text END AS text,
         p.parent AS parent_turn, coalesce(th.thread, m.turn) AS thread_turn,
         coalesce(th.depth, 0)::BIGINT AS depth, s.n_quoted, coalesce(p.n_linked, 0)::BIGINT AS n_linked
  FROM m JOIN s USING (r)
  LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM m.conv_id AND p.turn = m.turn
  LEFT JOIN th ON th.conv_id IS NOT DISTINCT FROM m.conv_id AND th.turn = m.turn)
SELECT *, (row_number() OVER (PARTITION BY conv_id ORDER BY thread_turn NULLS LAST, turn, role, text) - 1)::BIGINT
         AS position, '<|' || coalesce(role, '') || '|>' || chr(10) || text AS formatted
FROM o
"""

ORACLES = {"op9_chat_formatting": OP9, "op5_jaccard_join": OP5, "op1_line_dedup": OP1, "op4_exact_top_k": OP4, "op6_quality_rules": OP6, "op7_source_mix": OP7}
