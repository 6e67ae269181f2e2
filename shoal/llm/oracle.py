"""DuckDB SQL of the corpus queries that SQL can express.

Hashed fingerprints (op1), byte repeats (op2), packing (op6), drawn copies (op4),
latent vectors (op7) and trained models (op8, op9, op10) are beyond it; tests
compare those with brute force or held-out labels.
"""

from __future__ import annotations

OP5 = """
WITH parts AS (
  SELECT page_id, coalesce(url, '') AS url,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
listed AS (
  SELECT host FROM parts GROUP BY host
  HAVING count(*) FILTER (WHERE contains(url, '?')) * 100 > count(*) * 40),
rules(verdict, host, path) AS (VALUES
  ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM fits WHERE k = 1
"""

#: The sketch's buckets and fences as in ``quality_rules``: (ratio, numerator, denominator, lower fence?, tail, slack).
_RATIOS = (("symbol_ratio", "n_symbols", "word_chars", False, 0.75, 0.02), ("dup_line_ratio", "n_dup_lines", "n_lines", False, 0.99, 0.1),
           ("repeat_ratio", "n_repeat_words", "n_words", False, 0.99, 0.1), ("word_length", "word_chars", "n_words", True, 0.75, 0.5))


def _op3() -> str:
    values = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS ratio, CAST({n} AS double) / {d} AS x FROM base WHERE NOT base_failed"
                                for k, n, d, *_ in _RATIOS)
    fence = ", ".join(
        f"max(CASE WHEN ratio = '{k}' THEN greatest(q3 + 3.0::DOUBLE * (q3 - q1), qt) + {slack}::DOUBLE END) AS {k}_hi"
        + (f", max(CASE WHEN ratio = '{k}' THEN q1 - 3.0::DOUBLE * (q3 - q1) - {slack}::DOUBLE END) AS {k}_lo" if below else "")
        for k, _, _, below, _, slack in _RATIOS)
    tails = "CASE ratio " + " ".join(f"WHEN '{k}' THEN {tail}::DOUBLE" for k, _, _, _, tail, _ in _RATIOS) + " END"
    names = [f"{k}_hi" for k, *_ in _RATIOS] + [f"{k}_lo" for k, _, _, below, *_ in _RATIOS if below]
    picked = ", ".join(f"CASE WHEN g.rows >= 100 THEN g.{c} WHEN l.rows >= 100 THEN l.{c} ELSE e.{c} END AS {c}" for c in names)
    inside = " AND ".join(f"CAST({n} AS double) / nullif({d}, 0) <= {k}_hi" + (f" AND CAST({n} AS double) / nullif({d}, 0) >= {k}_lo" if below else "")
                          for k, n, d, below, *_ in _RATIOS)
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
lines AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT k, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY k),
windows AS (
  SELECT k, i, array_to_string(words[i + 1:i + 8], ' ') AS w FROM (SELECT k, words, unnest(range(len(words) - 7)) AS i FROM docs)),
repeats AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words FROM (
    SELECT k, unnest(range(i, i + 8)) AS p FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS c FROM windows) WHERE c > 1) GROUP BY k),
counts AS (
  SELECT k, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM docs LEFT JOIN lines USING (k) LEFT JOIN repeats USING (k)),
base AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counts),
fine AS (
  SELECT lang, source, ratio, CASE WHEN x > 0 THEN CAST(ceil(ln(x) / ln(1.02)) AS integer) END AS bucket, count(*) AS n
  FROM ({values}) GROUP BY ALL),
sketch AS (
  SELECT 0 AS level, lang, source, ratio, bucket, n FROM fine
  UNION ALL SELECT 1, lang, NULL, ratio, bucket, sum(n) FROM fine GROUP BY ALL
  UNION ALL SELECT 2, NULL, NULL, ratio, bucket, sum(n) FROM fine GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, ratio ORDER BY bucket NULLS FIRST ROWS UNBOUNDED PRECEDING) AS upto,
         sum(n) OVER (PARTITION BY level, lang, source, ratio) AS rows,
         CASE WHEN bucket IS NULL THEN 0.0 ELSE 2 * pow(1.02::DOUBLE, bucket) / 2.02::DOUBLE END AS v FROM sketch),
quartiles AS (
  SELECT level, lang, source, ratio, max(rows) AS rows, min(v) FILTER (WHERE upto >= 0.25 * rows) AS q1,
         min(v) FILTER (WHERE upto >= 0.75 * rows) AS q3, min(v) FILTER (WHERE upto >= {tails} * rows) AS qt
  FROM running GROUP BY level, lang, source, ratio),
fences AS (SELECT level, lang, source, max(rows) AS rows, {fence} FROM quartiles GROUP BY level, lang, source),
limits AS (
  SELECT g.lang, g.source, {picked} FROM (SELECT * FROM fences WHERE level = 0) g
  LEFT JOIN (SELECT * FROM fences WHERE level = 1) l ON g.lang IS NOT DISTINCT FROM l.lang
  LEFT JOIN (SELECT * FROM fences WHERE level = 2) e ON true)
SELECT b.doc_id, b.lang, b.source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, base_failed,
       NOT base_failed AND coalesce({inside}, true) AS kept
FROM base b LEFT JOIN limits t ON b.lang IS NOT DISTINCT FROM t.lang AND b.source IS NOT DISTINCT FROM t.source
"""


UPPER, LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"

OP11 = f"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT k, doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {UPPER}, {LOWER}) AS key FROM lines),
repeated AS (SELECT key AS r FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT k) >= 10)
SELECT doc_id, count(*) AS n_lines, count(r) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (r IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated ON key = r GROUP BY k, doc_id
"""

#: CRC-32 by its table of 256 registers, which the rule below makes.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]),
    lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384::UBIGINT) ELSE c // 2 END)) AS t)"""


def _crc(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a text, beside the table ``crc_table``."""
    return (f"xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode({text})), '..'), "
            "lambda b: ('0x' || b)::UBIGINT)), lambda c, b: xor(c // 256, t[(xor(c, b) % 256 + 1)::BIGINT])))::BIGINT")


OP12 = f"""
WITH RECURSIVE {_CRC_TABLE},
found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')), {UPPER}, {LOWER}) AS run
  FROM documents),
runs AS (SELECT doc, run, count(*) AS n FROM found WHERE length(run) >= 5 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc("doc || ':' || run")} AS h FROM runs, crc_table),
thinned AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM thinned WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
holes AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word)::BIGINT)) AS i FROM words)),
pairs AS (
  SELECT DISTINCT a.word AS a, b.word AS b, a.n AS a_n, b.n AS b_n FROM holes a JOIN holes b ON a.rest = b.rest AND a.i = b.i AND a.word < b.word
  UNION SELECT DISTINCT a.word, b.word, a.n, b.n FROM holes a JOIN words b ON a.rest = b.word),
both_ways AS (SELECT a AS w, b AS near, b_n AS near_n FROM pairs UNION SELECT b, a, a_n FROM pairs),
best AS (
  SELECT w, near, near_n, count(*) OVER (PARTITION BY w) AS n_near,
         row_number() OVER (PARTITION BY w ORDER BY near_n DESC, encode(near)) AS k FROM both_ways),
forms AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best ON word = w AND k = 1),
walk AS (
  SELECT word, word AS at FROM forms
  UNION ALL SELECT walk.word, f.form FROM walk JOIN forms f ON walk.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, w.at AS root, f.n, f.n_near, f.form_n
FROM forms f JOIN walk w ON f.word = w.word JOIN forms e ON w.at = e.word AND e.form IS NULL
"""

OP13 = f"""
WITH {_CRC_TABLE},
texts AS (
  SELECT true AS doc, row_number() OVER () AS k, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
split AS (
  SELECT doc, k, doc_id, regexp_extract_all(translate(coalesce(text, ''), {UPPER}, {LOWER}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM texts),
grams AS (
  SELECT doc, k, unnest(list_concat(w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2]),
                                    list_transform(range(len(w) - 2), lambda i: w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))) AS g
  FROM split),
codes AS (SELECT g, {_crc("g")} % 10000 AS bucket FROM (SELECT DISTINCT g FROM grams), crc_table),
counted AS (SELECT doc, k, bucket, count(*) AS n FROM grams JOIN codes USING (g) GROUP BY ALL),
sums AS (
  SELECT bucket, coalesce(sum(n) FILTER (doc), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (NOT doc), 0)::DOUBLE AS t FROM counted GROUP BY bucket),
totals AS (SELECT sum(s) AS s_all, sum(t) AS t_all FROM sums),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000))))::BIGINT AS gain FROM sums, totals),
weighed AS (SELECT k, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM counted JOIN gains USING (bucket) WHERE doc GROUP BY k),
scored AS (
  SELECT doc_id, len(w) >= 20 AS fit, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 8))::UBIGINT::DOUBLE + 0.5)
                                                    / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weighed USING (k) WHERE doc),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY fit ORDER BY score DESC, doc_id NULLS LAST) AS r, 5 * count(*) OVER (PARTITION BY fit) // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN fit AND r <= drawn THEN r END AS rank FROM ranked
"""


def oracles() -> dict[str, str]:
    return {"op3_quality_rules": _op3(), "op5_url_filters": OP5, "op11_line_dedup": OP11, "op12_spelling_variants": OP12,
            "op13_importance_resampling": OP13}
