"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(body) AS text_sha256
FROM n WINDOW w AS (PARTITION BY body)
"""

QUALITY = r"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT doc_id, i, words[i : i + 2] AS gram
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY 1),
m AS (SELECT w.doc_id, lang, source, len(words)::BIGINT AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines
      FROM w LEFT JOIN rep USING (doc_id)),
v AS (SELECT *, 1000 * n_symbols // greatest(word_chars, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS dup_lines,
             1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 10 * word_chars // greatest(n_words, 1) AS word_tenths FROM m),
l AS (UNPIVOT (SELECT doc_id, coalesce(lang, chr(1)) AS lang, coalesce(source, chr(1)) AS source, symbols, dup_lines, repeats, word_tenths FROM v)
      ON symbols, dup_lines, repeats, word_tenths INTO NAME metric VALUE value),
b AS (SELECT *, CASE WHEN value < 1000 THEN value ELSE 1000 + floor(50 * ln(value / 1000.0)) END::BIGINT AS bucket FROM l),
q AS (SELECT lang, source, metric, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3
      FROM b GROUP BY GROUPING SETS ((lang, source, metric), (lang, metric), (metric))),
t AS (SELECT *, CASE metric WHEN 'symbols' THEN 100 WHEN 'dup_lines' THEN 300 WHEN 'repeats' THEN 250 ELSE 40 END AS slack FROM q),
u AS (SELECT lang, source, metric, n, q3 + greatest(3 * (q3 - q1), slack) AS hi,
             CASE WHEN metric = 'word_tenths' THEN q1 - greatest(3 * (q3 - q1), slack) ELSE -1 END AS lo FROM t),
x AS (SELECT b.doc_id, bool_and(value <= CASE WHEN u2.n >= 50 THEN u2.hi WHEN u1.n >= 50 THEN u1.hi ELSE u0.hi END
                            AND value >= CASE WHEN u2.n >= 50 THEN u2.lo WHEN u1.n >= 50 THEN u1.lo ELSE u0.lo END) AS inside
      FROM b JOIN u u2 ON u2.lang = b.lang AND u2.source = b.source AND u2.metric = b.metric
             JOIN u u1 ON u1.lang = b.lang AND u1.source IS NULL AND u1.metric = b.metric
             JOIN u u0 ON u0.lang IS NULL AND u0.source IS NULL AND u0.metric = b.metric
      GROUP BY 1)
SELECT v.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND inside AS kept
FROM v JOIN x USING (doc_id)
"""

LINE_DEDUP = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
l AS (SELECT doc_id, generate_subscripts(lines, 1) AS i, unnest(lines) AS line FROM (SELECT *, string_split(body, chr(10)) AS lines FROM d)),
t AS (SELECT *, list_filter(regexp_split_to_array(regexp_replace(line, '[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS tokens FROM l),
p AS (SELECT *, array_to_string(tokens, ' ') AS path FROM t),
k AS (SELECT path, tokens, [len(tokens)::VARCHAR, tokens[1], coalesce(tokens[2], '')] AS leaf, count(DISTINCT doc_id) AS n FROM p WHERE path <> '' GROUP BY ALL),
s AS (SELECT leaf, sum(n) AS support FROM k GROUP BY 1),
u AS (SELECT path, leaf, n, generate_subscripts(tokens, 1) AS place, unnest(tokens) AS token FROM k),
c AS (SELECT leaf, place, token FROM u JOIN s USING (leaf) GROUP BY leaf, place, token, support HAVING sum(n) >= 5 AND 100 * sum(n) >= support),
f AS (SELECT u.path, array_to_string(list(CASE WHEN u.token = '<*>' OR c.token IS NOT NULL THEN u.token ELSE '<word>' END ORDER BY u.place), ' ') AS template,
             count(*) AS m, count(*) FILTER (u.token <> '<*>' AND c.token IS NULL) AS fields,
             count(*) FILTER (u.place > 2 AND u.token <> '<*>' AND c.token IS NOT NULL) AS beyond
      FROM u LEFT JOIN c ON c.leaf = u.leaf AND c.place = u.place AND c.token = u.token GROUP BY 1),
n AS (SELECT path, CASE WHEN fields > 0 AND 2 * fields <= m AND beyond > 0 THEN template ELSE path END AS template FROM f),
o AS (SELECT n.template FROM p JOIN n USING (path) GROUP BY 1 HAVING count(DISTINCT p.doc_id) >= 5)
SELECT p.doc_id, count(*) AS n_lines, count(o.template) AS n_dropped,
       sha256(coalesce(string_agg(p.line, chr(10) ORDER BY p.i) FILTER (o.template IS NULL), '')) AS text_sha256
FROM p LEFT JOIN n USING (path) LEFT JOIN o ON o.template = n.template GROUP BY p.doc_id
"""
