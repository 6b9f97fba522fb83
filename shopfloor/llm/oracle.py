"""DuckDB SQL for the queries that SQL can express."""

from shopfloor.llm.license_texts import TEMPLATES
from shopfloor.llm.licenses import THRESHOLD, bigrams_of, longest, markers_of


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


TOP_K = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, min(v) AS v FROM whole GROUP BY vec_id),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored)
SELECT * FROM ranked WHERE rank <= 10
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
classes AS MATERIALIZED (SELECT min(doc_id) AS member, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
items AS MATERIALIZED (SELECT member, len(s) AS n, unnest(s) AS x FROM classes),
frequent AS (SELECT x, count(*) AS c FROM items GROUP BY x HAVING count(*) > 1),
common AS (
  SELECT a.member AS a, b.member AS b, a.n AS na, b.n AS nb, count(*) AS c
  FROM items a JOIN frequent USING (x) JOIN items b USING (x)
  WHERE a.member < b.member AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM common WHERE 100 * c >= 75 * (na + nb - c)
  UNION SELECT b, a FROM common WHERE 100 * c >= 75 * (na + nb - c)),
reach AS (
  SELECT member AS start, member AS reached FROM classes
  UNION SELECT reach.start, links.b FROM reach JOIN links ON links.a = reach.reached),
labels AS (SELECT start AS member, min(reached) AS label FROM reach GROUP BY start)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(l.label, d.doc_id) AS component_id,
       coalesce(l.label, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN labels l ON l.member = c.member
"""

def _list(values) -> str:
    return f"CAST([{', '.join(map(_text, values))}] AS VARCHAR[])"


_TABLE = ", ".join(
    f"({i}, {_text(name)}, {_list(bigrams_of(text))}, {_list(has)}, {_list(decide)})"
    for i, ((name, text), (has, decide)) in enumerate(zip(TEMPLATES, markers_of(TEMPLATES)))
    if bigrams_of(text)
)
# All lines and all runs of lines, without the words that the query looks for first.
LICENSES = rf"""
WITH templates(id, license, grams, has, decide) AS (VALUES {_TABLE}),
docs AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT doc_id, text, list_transform(string_split(text, chr(10)),
         lambda l: trim(lower(regexp_replace(l, '[^A-Za-z0-9]+', ' ', 'g')))) AS l FROM docs),
starts AS (SELECT doc_id, text, l, unnest(range(1, len(l) + 1)) AS first FROM lines),
runs AS (
  SELECT doc_id, text, first, last, string_split(array_to_string(l[first:last], ' '), ' ') AS w
  FROM (SELECT *, unnest(range(first, least(first + {longest(TEMPLATES, THRESHOLD)}, len(l) + 1))) AS last FROM starts)
  WHERE NOT list_contains(l[first:last], '')),
grams AS (
  SELECT doc_id, text, first, last, w, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
  FROM runs WHERE len(w) > 1 AND (first = last OR len(w) <= {longest(TEMPLATES, THRESHOLD)})),
scored AS (
  SELECT doc_id, text, first, last, array_to_string(w, ' ') AS p, license,
         2.0::DOUBLE * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
  FROM grams JOIN templates ON list_has_any(g, grams) AND list_sort(list_intersect(list_distinct(w), decide)) = has),
best_of AS (
  SELECT * FROM scored WHERE dice >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id, text, first, last ORDER BY dice DESC, license) = 1),
begun AS (
  SELECT *, coalesce(first > max(last) OVER (PARTITION BY doc_id, text ORDER BY first, last
                                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE) AS begins FROM best_of),
numbered AS (SELECT *, sum(CAST(begins AS INT)) OVER (PARTITION BY doc_id, text ORDER BY first, last) AS part FROM begun),
kept AS (
  SELECT * FROM numbered
  QUALIFY row_number() OVER (PARTITION BY doc_id, text, part, license ORDER BY dice DESC, last - first, first) = 1),
matches AS (SELECT doc_id, p, license, max(dice) AS dice FROM kept GROUP BY ALL),
summary AS (
  SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses, max(dice) AS best_dice
  FROM matches GROUP BY doc_id),
best AS (SELECT m.doc_id, min(license) AS best_license FROM matches m JOIN summary s ON m.doc_id = s.doc_id AND m.dice = s.best_dice GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_matches, licenses, best_license, best_dice
FROM (SELECT DISTINCT doc_id FROM documents) d
LEFT JOIN summary s ON s.doc_id IS NOT DISTINCT FROM d.doc_id LEFT JOIN best b ON b.doc_id IS NOT DISTINCT FROM d.doc_id
"""

CHAT = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, len('<|im_start|>') + len('<|im_end|>') + 2 + len(replace(replace(text, '\', '\\'), '<|', '<\|'))
       + len(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n')) AS size
  FROM rows_)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

HARD_NEGATIVES = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, min({'label': label, 'v': v}) AS r FROM whole GROUP BY vec_id),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.r.label = b.r.label AS same,
         CAST(list_sum(list_transform(range(1, len(a.r.v) + 1), lambda i: a.r.v[i] * b.r.v[i])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.r.v) = len(b.r.v)),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other_id AS negative_id, positive_score,
       score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
QUALIFY row_number() OVER w <= 5
"""

FILTER_INTERACTIONS = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM words GROUP BY text),
marks AS (SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
docs AS MATERIALIZED (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, [
    len(w) < 200,
    100 * len(list_distinct(w)) < 50 * len(w),
    100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text),
    regexp_matches(text, '[#$%&*|]'),
    coalesce(first < doc_id, false)] AS fails
  FROM words LEFT JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)),
patterns AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INTEGER) AS step FROM orders),
tried AS (
  SELECT part, filter_order, step, n, good, toxic,
         list_transform(string_split(filter_order, ''), lambda f: fails[ascii(f) - 64]) AS failed
  FROM patterns, steps),
counted AS (
  SELECT part, filter_order, step, filter_order[step] AS f,
         coalesce(sum(n) FILTER (NOT list_bool_or(failed[1:step])), 0) AS kept,
         coalesce(sum(n) FILTER (failed[step] AND NOT list_bool_or([false] || failed[1:step - 1])), 0) AS removed,
         coalesce(sum(n) FILTER (failed[step] AND list_bool_or([false] || failed[1:step - 1])), 0) AS redundant,
         coalesce(sum(n) FILTER (failed[step] AND len(list_filter(failed, lambda x: x)) = 1), 0) AS unique_fails,
         coalesce(sum(good) FILTER (failed[step] AND NOT list_bool_or([false] || failed[1:step - 1])), 0) AS good_lost,
         coalesce(sum(toxic) FILTER (failed[step] AND NOT list_bool_or([false] || failed[1:step - 1])), 0) AS toxic_lost
  FROM tried GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""

ORACLE_SQL: dict[str, str] = {
    "op1_top_k_search": TOP_K,
    "op5_minhash_near_dedup": NEAR_DUPLICATES,
    "op6_license_scan": LICENSES,
    "op9_chat_formatting": CHAT,
    "op12_hard_negatives": HARD_NEGATIVES,
    "op13_filter_interactions": FILTER_INTERACTIONS,
}
