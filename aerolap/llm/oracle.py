"""DuckDB SQL for the queries that SQL can express.

Written from the operators' definitions, not from their methods: all pairs,
whole windows, recursion. Fixed values are written out again.
"""

from __future__ import annotations

from aerolap.llm.licenses import TEMPLATES

_WORD = r"'[^\x20\x09-\x0D]+'"
_ASCII_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _text(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


OP2_LICENSE_SCAN = rf"""
WITH t AS (
  SELECT i, name, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b
  FROM (SELECT i, name, string_split(trim(regexp_replace(lower(x), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')), ' ') AS w
        FROM (VALUES {", ".join(f"({i}, {_text(n)}, {_text(x)})" for i, (n, x) in enumerate(TEMPLATES))}) v(i, name, x))),
d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
p AS (SELECT *, string_split(text, chr(10)) AS l,
             string_split_regex(text, '\n[\x20\x09-\x0D]*\n') AS g FROM d),
u AS (SELECT r, unnest(x) AS u, generate_subscripts(x, 1) - 1 AS pos
      FROM (SELECT r, l || CASE WHEN len(g) > 1 THEN g ELSE [] END
                        || CASE WHEN len(l) > 1 THEN [text] ELSE [] END AS x FROM p WHERE text IS NOT NULL)),
b AS (SELECT r, pos, list_distinct(list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS b
      FROM (SELECT r, pos, string_split(trim(regexp_replace(lower(u), '[^\p{{L}}\p{{M}}\p{{N}}]+', ' ', 'g')), ' ') AS w FROM u)
      WHERE len(w) BETWEEN 2 AND 2000),
s AS (SELECT r, pos, i, name, 2.0::DOUBLE * len(list_intersect(b.b, t.b)) / (len(b.b) + len(t.b)) AS dice
      FROM b JOIN t ON len(b.b) BETWEEN 0.5 * len(t.b) AND 2 * len(t.b)),
m AS (SELECT r, count(DISTINCT pos) AS n_matches, arg_max(name, {{'d': dice, 'a': -pos, 'i': -i}}) AS license,
             max(dice) AS dice, arg_max(pos, {{'d': dice, 'a': -pos, 'i': -i}}) AS unit_no
      FROM s WHERE dice >= 0.75 GROUP BY r)
SELECT doc_id, license, dice, unit_no::INT AS unit_no, coalesce(n_matches, 0)::INT AS n_matches
FROM d LEFT JOIN m USING (r)
"""

OP8_QUALITY_RULES = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, {_WORD}) AS ws FROM d),
g AS (SELECT r, i, ws[i:i + 2] AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
c AS (SELECT r, count(DISTINCT p) AS n FROM (
        SELECT r, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS k FROM g) WHERE k >= 2) GROUP BY r),
l AS (SELECT r, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS b,
             len(regexp_extract_all(line, {_WORD})) AS n
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d)),
f AS (SELECT r, line, n,
             (n < 8 AND NOT regexp_matches(b, '[.!?:;…。！？]["''”’»)\]]*$'))
             OR 5 * len(regexp_extract_all(b, '[#*$%&|<>{{}}~^=\\_]')) > n
             OR 10 * len(regexp_extract_all(b, '!!|\?\?')) > 3 * n
             OR (len(regexp_extract_all(b, '[|»›•·]')) >= 3
                 AND n <= 4 * (len(regexp_extract_all(b, '[|»›•·]')) + 1))
             OR (n <= 20 AND regexp_matches({_ASCII_LOWER.format('b')},
                 'all rights reserved|privacy policy|terms of (use|service)|cookie|javascript|subscribe|sign in|sign up|log in|click here|read more|lorem ipsum|licensed under|powered by|share this|copyright|©'))
             AS fails
      FROM l WHERE n > 0),
x AS (SELECT r, count(*) - count(DISTINCT line) AS dup, coalesce(sum(n) FILTER (WHERE fails), 0) AS lost,
             count(*) FILTER (WHERE fails) AS lost_lines FROM f GROUP BY r),
q AS (SELECT doc_id, len(ws)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(ws, lambda s: length(s))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             coalesce(dup, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             coalesce(lost, 0)::BIGINT AS n_lost_words, coalesce(lost_lines, 0)::BIGINT AS n_lost_lines
      FROM d JOIN w USING (r) LEFT JOIN c USING (r) LEFT JOIN x USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
       AND 100 * n_lost_words <= 30 * n_words AS kept
FROM q
"""

OP9_NGRAM_JACCARD = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, {_WORD}) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1),
               lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
             WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
                        FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL)
      JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * o >= 90 * (na.n + nb.n - o)),
reach(id, root) AS (SELECT doc_id, doc_id FROM documents
                    UNION SELECT p.b, reach.root FROM reach JOIN p ON reach.id = p.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
       (SELECT min(root) FROM reach WHERE id = d.doc_id) AS component_id,
       (SELECT count(*) FROM p WHERE a = d.doc_id) AS n_links
FROM documents d LEFT JOIN n USING (doc_id)
"""

OP10_EMBEDDING_COPIES = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
      WHERE len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93),
reach(id, root) AS (SELECT vec_id, vec_id FROM embeddings
                    UNION SELECT p.b, reach.root FROM reach JOIN p ON reach.id = p.a)
SELECT vec_id, (SELECT count(*) FROM p WHERE a = d.vec_id) AS n_links,
       (SELECT min(root) FROM reach WHERE id = d.vec_id) AS component_id,
       vec_id = (SELECT min(root) FROM reach WHERE id = d.vec_id) AS kept
FROM embeddings d
"""
