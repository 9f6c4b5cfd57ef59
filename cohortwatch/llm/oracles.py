"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from cohortwatch.llm.license_scan import DRIFT, NOTICES, PHRASES, SHARE

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

QUALITY = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS g FROM w, unnest(range(1, len(ws) - 3)) AS u(i)),
again AS (SELECT doc_id, g FROM g GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g JOIN again USING (doc_id, g), unnest(range(0, 5)) AS v(j) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '{_WORD}') GROUP BY doc_id),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words,
  length(t) - length(replace(t, chr(10), '')) + 1 AS n_lines, length(regexp_replace(t, '[^A-Za-z\x{{80}}-\x{{10FFFF}}]', '', 'g')) AS n_letters
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars >= 3 * n_words AND word_chars <= 10 * n_words AND 10 * n_symbols <= n_words AND 10 * n_dup_lines <= 3 * n_lines AND 2 * n_letters >= word_chars AS kept
FROM f
"""

NGRAM_JOIN = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i+4], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.y, reach.c FROM reach JOIN e ON e.x = reach.id)
SELECT id AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(c) AS component_id FROM reach LEFT JOIN n ON n.doc_id = id GROUP BY id
"""

DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(ws), 13) AS l, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS g FROM b, unnest(range(1, greatest(len(ws) - 11, 2))) AS u(i) WHERE len(ws) > 0),
dw AS (SELECT doc_id, l, i, array_to_string(ws[i:i + l - 1], ' ') AS g FROM d, (SELECT DISTINCT l FROM bw) AS x, unnest(range(1, len(ws) - l + 2)) AS u(i)),
h AS (SELECT doc_id, l, i, item_id FROM dw JOIN bw USING (l, g)),
hit AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM h, unnest(range(0, l)) AS v(j) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM h) AS q GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hit.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(it.n, 0) AS BIGINT) AS n_items, coalesce(it.s, sha256('')) AS items_sha256,
  coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
QUALIFY rank <= 5
"""

COLLOCATIONS = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
f AS MATERIALIZED (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g, count(*) AS f FROM w, (VALUES (1), (2), (3)) AS s(k), unnest(range(1, len(ws) - k + 2)) AS u(i) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
cut AS MATERIALIZED (SELECT lang, g, f AS a, j, array_to_string(ws[:j], ' ') AS one, array_to_string(ws[j + 1:], ' ') AS two FROM (SELECT *, string_split(g, ' ') AS ws FROM f WHERE k >= 2 AND f >= 10) AS q, (VALUES (1), (2)) AS s(j) WHERE j < k),
cuts AS (SELECT cut.lang, cut.g, a, x.f AS l, y.f AS r, CAST(1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS BIGINT) AS score, j
  FROM cut JOIN f AS x ON x.lang = cut.lang AND x.g = one JOIN f AS y ON y.lang = cut.lang AND y.g = two),
c AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
longer AS (SELECT lang, part, max(f) AS f FROM (SELECT lang, unnest([array_to_string(string_split(g, ' ')[1:2], ' '), array_to_string(string_split(g, ' ')[2:3], ' ')]) AS part, f FROM f WHERE k = 3 AND f >= 10) AS q GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN longer ON longer.lang = c.lang AND part = g WHERE longer.f IS NULL OR 100 * longer.f < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000
"""


def license_scan() -> str:
    """SQL for the license scan, by grams of three words as text."""
    values = ", ".join(f"({i}, '{t.label}', {t.exact}, '{t.text}')" for i, t in enumerate([*PHRASES, *NOTICES]))
    return rf"""
WITH t AS (SELECT id, label, exact, regexp_extract_all(lower(text), '{_ALNUM}') AS ws FROM (VALUES {values}) AS v(id, label, exact, text)),
tg AS (SELECT id, p, array_to_string(ws[p:p + 2], ' ') AS g FROM t, unnest(range(1, len(ws) - 1)) AS u(p)),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
h AS (SELECT doc_id, id, i - p AS diagonal, p, i FROM (SELECT doc_id, i, array_to_string(ws[i:i + 2], ' ') AS g FROM d, unnest(range(1, len(ws) - 1)) AS u(i)) AS q JOIN tg USING (g)),
n AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER w <= CASE WHEN exact THEN 0 ELSE {DRIFT} END THEN 0 ELSE 1 END AS new FROM h JOIN t USING (id) WINDOW w AS (PARTITION BY doc_id, id ORDER BY diagonal, p)),
s AS (SELECT *, sum(new) OVER (PARTITION BY doc_id, id ORDER BY diagonal, p) AS span FROM n),
v AS (SELECT doc_id, label, exact, min(i) - 1 AS first, CAST(count(DISTINCT p) AS DOUBLE) / (len(any_value(ws)) - 2) AS score FROM s GROUP BY doc_id, id, label, exact, span
  HAVING CASE WHEN exact THEN count(DISTINCT p) = len(any_value(ws)) - 2 ELSE 100 * count(DISTINCT p) >= {SHARE} * (len(any_value(ws)) - 2) AND max(i) - min(i) + 3 <= 2 * len(any_value(ws)) END),
a AS (SELECT doc_id, count(*) FILTER (WHERE exact) AS n_base, min(first) FILTER (WHERE exact) AS first_word, max(first) FILTER (WHERE exact) AS last_word,
  string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE exact) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score FROM v GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM d LEFT JOIN a USING (doc_id)
"""
