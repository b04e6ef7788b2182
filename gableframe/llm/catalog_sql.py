"""SQL of the vector codes, the likelihood ratio and the spelling variants."""

from __future__ import annotations

# --- vector codes -----------------------------------------------------------

_PARTS = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // 16) + 1 : (p + 1) * (len(v) // 16)] AS x FROM kept, range(16) r(p)),
book0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 64)"""


def _assigned(turn: int) -> str:
    return f"""
near{turn} AS MATERIALIZED (
  SELECT vec_id, label, p, x, e, d FROM (
    SELECT vec_id, label, parts.p, x, e,
           list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
    FROM parts JOIN book{turn} b ON b.p = parts.p)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) = 1)"""


def _moved(turn: int) -> str:
    return f"""
sums{turn} AS (
  SELECT p, e, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS m
  FROM near{turn}, range(1, (SELECT max(len(x)) + 1 FROM parts)) r(i) GROUP BY p, e, i),
book{turn + 1} AS MATERIALIZED (
  SELECT b.p, b.e, coalesce(m.c, b.c) AS c
  FROM book{turn} b LEFT JOIN (SELECT p, e, list(m ORDER BY i) AS c FROM sums{turn} GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""


_CODES = ",".join([_PARTS, _assigned(0), _moved(0), _assigned(1), _moved(1), _assigned(2)]) + """,
coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error
  FROM near2 GROUP BY vec_id, label)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) FROM book2, range(1, (SELECT max(len(c)) + 1 FROM book0)) r(i)) AS codebooks_sha256
FROM coded"""

# --- likelihood ratio -------------------------------------------------------

_LIKELIHOOD = r"""
WITH lowered AS (
  SELECT doc_id, coalesce(text, '') AS text,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents),
tokens AS (
  SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(low, '[0-9A-Za-z\x{80}-\x{10FFFF}]+|[!-/:-@\[-`{-~]+') AS t FROM lowered)),
known AS (SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT AS h FROM (SELECT DISTINCT token FROM tokens)),
hashed AS MATERIALIZED (SELECT doc_id, i, h, lead(h) OVER (PARTITION BY doc_id ORDER BY i) AS after FROM tokens JOIN known USING (token)),
grams AS MATERIALIZED (
  SELECT doc_id, h % 16384 AS bucket FROM hashed
  UNION ALL SELECT doc_id, (h * 1000003 + after) % 16384 FROM hashed WHERE after IS NOT NULL),
trusted AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(toxic) = 0),
counted AS (
  SELECT bucket, count(*) AS raw, count(t.doc_id) AS good FROM grams g LEFT JOIN trusted t ON g.doc_id = t.doc_id GROUP BY bucket),
total AS (SELECT sum(raw)::DOUBLE AS raws, sum(good)::DOUBLE AS goods FROM counted),
weights AS (
  SELECT bucket, round_even(1e6 * ln((good + 4) / (raw * (goods / raws) + 4)), 0)::BIGINT AS w FROM counted, total),
ratio AS (SELECT doc_id, count(*) AS n_grams, sum(w)::BIGINT AS ratio_micro FROM grams JOIN weights USING (bucket) GROUP BY doc_id),
words AS (
  SELECT doc_id, w AS word, i FROM (
    SELECT doc_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS t FROM lowered))),
windows AS (
  SELECT doc_id, i, row(word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS five,
         lead(i, 4) OVER o AS last FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
again AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS n FROM windows WHERE last IS NOT NULL) WHERE n > 1),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + k AS at FROM again, range(5) r(k)) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM lowered)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
counts AS (SELECT doc_id, count(*) AS n, sum(length(word))::BIGINT AS chars FROM words GROUP BY doc_id),
measured AS (
  SELECT l.doc_id, coalesce(c.n, 0) AS n_words, coalesce(c.chars, 0) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(v.n, 0) AS n_repeat_words,
         coalesce(r.n_grams, 0) AS n_grams, coalesce(r.ratio_micro, 0) AS ratio_micro
  FROM lowered l LEFT JOIN counts c USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN covered v USING (doc_id) LEFT JOIN ratio r USING (doc_id))
SELECT *, base_failed IS FALSE AND ratio_micro >= -300000 * n_grams AS kept
FROM (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured)"""

# --- spelling variants ------------------------------------------------------

_SPELLING = r"""
WITH RECURSIVE steps(i, k, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM steps WHERE k < 8),
bytewise AS (SELECT list(v ORDER BY i) AS table_of FROM steps WHERE k = 8),
lowered AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+') AS t
  FROM documents WHERE text IS NOT NULL),
runs AS (
  SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes
  FROM (SELECT doc_id, unnest(t) AS run FROM lowered) WHERE length(run) >= 5 GROUP BY doc_id, run),
summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(bytes), 2), lambda i: ('0x' || substr(bytes, i, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, table_of[(xor(c, b) & 255) + 1]))) AS h
  FROM runs, bytewise),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM words, range(1, (SELECT max(length(word)) + 1 FROM words)) r(i) WHERE i <= length(word)),
pairs AS MATERIALIZED (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (
  SELECT word, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, encode(near)) = 1),
named AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best USING (word)),
walk(word, root, step) AS (
  SELECT word, word, 0 FROM named
  UNION ALL SELECT w.word, f.form, step + 1 FROM walk w JOIN named f ON f.word = w.root WHERE f.form IS NOT NULL)
SELECT word, n, n_near, form, form_n, (SELECT root FROM walk w WHERE w.word = named.word ORDER BY step DESC LIMIT 1) AS root FROM named"""

ORACLE_SQL: dict[str, str] = {
    "op11_adaptive_codes": _CODES,
    "op12_target_likelihood": _LIKELIHOOD,
    "op13_spelling_variants": _SPELLING,
}
