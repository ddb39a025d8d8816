"""The same results in DuckDB SQL, where SQL can express an operator (source mixing has its SQL beside it).

They go by definition: all windows of all texts, all variants of all lines. Ids are unique in the tables they are run on, and
no text has a million lines.
"""

LINE_DEDUP = r"""
WITH split AS (SELECT doc_id, string_split(text, chr(10)) AS x FROM documents),
numbered AS (SELECT doc_id, unnest(range(len(x))) AS no, unnest(x) AS line FROM split),
lines AS (
  SELECT doc_id, no, doc_id * 1000000 + no AS o, w, array_to_string(w, ' ') AS s
  FROM (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM numbered) WHERE len(w) > 0),
firsts AS (SELECT s, any_value(w) AS w, min(o) AS o FROM lines GROUP BY s),
long AS (SELECT * FROM firsts WHERE len(w) >= 5),
variants AS (
  SELECT s, o, p, md5(array_to_string(list_concat(w[1:p - 1], w[p + 1:]), ' ')) AS v
  FROM (SELECT *, unnest(range(1, len(w) + 1)) AS p FROM long)),
same_place AS (SELECT v, p, min(o) AS least FROM variants GROUP BY v, p),
shorter AS (SELECT v, min(o) AS least FROM variants GROUP BY v),
near AS (
  SELECT s FROM variants JOIN same_place USING (v, p) WHERE least < o
  UNION SELECT x.s FROM variants x JOIN long y ON x.v = md5(y.s) WHERE y.o < x.o
  UNION SELECT y.s FROM long y JOIN shorter x ON x.v = md5(y.s) WHERE x.least < y.o),
judged AS (
  SELECT l.doc_id, l.no, l.o > f.o AS exact, l.o = f.o AND l.s IN (SELECT s FROM near) AS near
  FROM lines l JOIN firsts f USING (s)),
by_doc AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (exact) AS n_exact, count(*) FILTER (near) AS n_near,
         coalesce(string_agg(no::VARCHAR, ',' ORDER BY no) FILTER (exact OR near), '') AS dropped
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_exact, 0) AS n_exact, coalesce(n_near, 0) AS n_near, coalesce(dropped, '') AS dropped
FROM documents d LEFT JOIN by_doc USING (doc_id)
"""

SUFFIX_DEDUP = r"""
WITH bytes AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS (SELECT *, (length(h) // 2)::BIGINT AS n FROM bytes),
windows AS (
  SELECT r, p, md5(h[2 * p + 1 : 2 * p + 400]) AS k
  FROM (SELECT r, h, unnest(range(n - 199)) AS p FROM sized WHERE n >= 200)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
starts AS (SELECT r, p FROM windows SEMI JOIN twice USING (k)),
marked AS (SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200, true)::INT AS new FROM starts),
runs AS (
  SELECT r, min(p) AS s, max(p) + 200 AS e
  FROM (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p ROWS UNBOUNDED PRECEDING) AS g FROM marked) GROUP BY r, g),
gaps AS (
  SELECT r, coalesce(lag(e) OVER w, 0) AS a, s AS b FROM runs WINDOW w AS (PARTITION BY r ORDER BY s)
  UNION ALL SELECT r, max(e), NULL FROM runs GROUP BY r),
kept AS (
  SELECT g.r, string_agg(h[2 * a + 1 : 2 * coalesce(b, n)], '' ORDER BY a) AS h
  FROM gaps g JOIN sized USING (r) GROUP BY g.r),
cut AS (SELECT r, count(*) AS n_spans, sum(e - s)::BIGINT AS n_removed FROM runs GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept.h, sized.h))) AS kept_sha256
FROM sized LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)
"""

#: Spans of at most 13 words of which at most a fifth are substituted: the Hamming distance of every pair of windows that have
#: one of errors + 1 runs of places in common (with that many errors at most, one run has none), whatever masks there are.
DECONTAMINATION = r"""
WITH folded AS (
  SELECT doc_id, list_transform(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+'),
           lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM documents),
items AS (
  SELECT *, least(13, len(w)) AS span, least(13, len(w)) // 5 AS errors FROM (
    SELECT item_id, list_transform(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+'),
             lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS w FROM benchmark)
  WHERE len(w) >= 5),
runs AS (
  SELECT span, errors, run, span * run // (errors + 1) + 1 AS a, span * (run + 1) // (errors + 1) AS b
  FROM (SELECT DISTINCT span, errors FROM items), range(3) r(run) WHERE run <= errors),
item_windows AS (SELECT item_id, span, errors, unnest(range(len(w) - span + 1)) AS q, w FROM items),
item_keys AS (
  SELECT item_id, span, errors, run, w[q + 1 : q + span] AS v, array_to_string(w[q + a : q + b], ' ') AS k
  FROM item_windows JOIN runs USING (span, errors)),
doc_windows AS (
  SELECT doc_id, span, errors, run, unnest(range(len(w) - span + 1)) AS p, w, a, b FROM folded, runs WHERE len(w) >= span),
doc_keys AS (SELECT doc_id, span, run, w[p + 1 : p + span] AS v, array_to_string(w[p + a : p + b], ' ') AS k FROM doc_windows),
hits AS (
  SELECT DISTINCT d.doc_id, i.item_id FROM doc_keys d JOIN item_keys i USING (span, run, k)
  WHERE list_sum(list_transform(range(1, i.span + 1), lambda j: (d.v[j] <> i.v[j])::INT)) <= i.errors),
by_doc AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS item_ids FROM hits GROUP BY doc_id)
SELECT doc_id, n_items IS NOT NULL AS contaminated, coalesce(n_items, 0) AS n_items, coalesce(item_ids, '') AS item_ids
FROM documents LEFT JOIN by_doc USING (doc_id)
"""

#: The counts of the quality rules and the base verdict.
RULE_COUNTS = r"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM documents),
windows AS (SELECT doc_id, p, array_to_string(w[p + 1 : p + 5], ' ') AS v FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS p FROM w WHERE len(w) >= 5)),
twice AS (SELECT doc_id, v FROM windows GROUP BY doc_id, v HAVING count(*) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM windows SEMI JOIN twice USING (doc_id, v), range(5) r(k) GROUP BY doc_id),
counts AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts
"""

#: Token counts, the hold-out rule (CRC-32 of the id's digits, bit by bit) and base scores of the language model.
TOKEN_SCORES = r"""
WITH tokens AS (
  SELECT doc_id, list_reduce(list_prepend(4294967295, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: unicode(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda c, _: xor(c >> 1, 3988292384 * (c & 1)))) AS crc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
docs AS (SELECT doc_id, xor(crc, 4294967295) % 10 = 0 AS held_out, w, len(w) + 1 AS n_tokens FROM tokens),
counts AS (SELECT x, count(*) AS c FROM (SELECT unnest(w) AS x FROM docs WHERE NOT held_out) GROUP BY x),
ends AS (SELECT count(*) AS c FROM docs WHERE NOT held_out),
totals AS (SELECT coalesce((SELECT sum(c) FROM counts), 0) + c AS n, (SELECT count(*) FROM counts) + (c > 0)::INT AS v FROM ends),
of_words AS (
  SELECT doc_id, count(*) FILTER (c IS NOT NULL) AS known, sum(log10((coalesce(c, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1)))) AS score
  FROM (SELECT doc_id, unnest(w) AS x FROM docs) LEFT JOIN counts USING (x), totals GROUP BY doc_id)
SELECT doc_id, held_out, n_tokens::BIGINT AS n_tokens, (coalesce(known, 0) + (c > 0)::INT)::BIGINT AS n_known, n::BIGINT AS train_tokens,
       round(coalesce(score, 0) + log10((c + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1))), 4) + 0 AS base_score
FROM docs LEFT JOIN of_words USING (doc_id), ends, totals
"""
