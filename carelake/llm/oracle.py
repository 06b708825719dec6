"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"[^\x20\x09-\x0D]+"

OP3 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS words,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), line AS (
  SELECT rid, line, count(*) AS n FROM (SELECT rid, unnest(lines) AS line FROM d) GROUP BY rid, line
), dup AS (
  SELECT rid, sum(n - 1) AS n_dup_lines FROM line WHERE regexp_matches(line, '{_WORDS}') GROUP BY rid
), starts AS (
  SELECT rid, words, unnest(range(1, len(words) - 6)) AS i FROM d WHERE len(words) >= 8
), wins AS (
  SELECT rid, i, list_slice(words, i, i + 7) AS w FROM starts
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, w) AS n FROM wins) WHERE n > 1
), rep AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY rid
), m AS (
  SELECT d.doc_id, d.source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(lines) AS n_lines
  FROM d LEFT JOIN dup USING (rid) LEFT JOIN rep USING (rid)
), f AS (
  SELECT *, n_words < 20 AS f1, 100 * n_repeat_words > 30 * n_words AS f2, 100 * n_symbols > 50 * n_words AS f3,
         100 * n_dup_lines > 50 * n_lines AS f4
  FROM m
), rule AS (
  SELECT source, k, count(*) AS n, sum(CASE WHEN x THEN 1 ELSE 0 END) AS f
  FROM (SELECT source, unnest([1, 2, 3, 4]) AS k, unnest([f1, f2, f3, f4]) AS x FROM f WHERE source IS NOT NULL)
  GROUP BY source, k
), fit AS (
  SELECT k, sum(f) / CAST(sum(n) AS DOUBLE) AS m,
         sum(f * f / CAST(n AS DOUBLE)) / sum(n) - (sum(f) / CAST(sum(n) AS DOUBLE)) ** 2 AS v
  FROM rule GROUP BY k
), prior AS (
  SELECT k, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1000000.0) ELSE 1000000.0 END AS w FROM fit
), bad AS (
  SELECT source FROM rule JOIN prior USING (k) GROUP BY source HAVING max((f + m * w) / (n + w)) > 0.5
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
       NOT (f1 OR f2) AND NOT coalesce(source IN (SELECT source FROM bad), FALSE) AS kept
FROM f
"""

OP4 = rf"""
WITH d AS (
  SELECT doc_id, coalesce('s' || source, 't') AS skey,
         CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORDS}')) AS BIGINT) AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS okey
  FROM documents
), s AS (
  SELECT skey, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(1 + (row_number() OVER (ORDER BY skey) - 1) % 3 AS BIGINT) AS w
  FROM d GROUP BY skey
), c AS (SELECT *, 3 * source_size AS cap, CAST(3 * source_size AS DOUBLE) / w AS full_at FROM s
), l AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY full_at, skey
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
         / CAST(sum(w) OVER (ORDER BY full_at, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM c
), t AS (
  SELECT skey, source_size, cap, total,
         least(w * (SELECT max(level) FROM l WHERE level <= full_at), CAST(cap AS DOUBLE)) AS target
  FROM l
), p AS (
  SELECT doc_id, skey, size, source_size, cap, total, target,
         CAST(sum(size) OVER (PARTITION BY skey ORDER BY okey, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size
           AS start
  FROM d JOIN t USING (skey)
), r AS (
  SELECT skey, start, start + e * source_size AS place,
         least(size, least(CAST(ceil(target) AS BIGINT), cap) - (start + e * source_size)) AS words, target, total
  FROM p, (SELECT unnest([0, 1, 2]) AS e) WHERE size > 0
), q AS (
  SELECT skey, start, words, total,
         sum(words) OVER (ORDER BY CAST(place + words AS DOUBLE) / target, skey, place ROWS UNBOUNDED PRECEDING) - words AS before
  FROM r WHERE words > 0
), g AS (
  SELECT skey, start, sum(least(words, greatest(0, total - before))) AS served FROM q GROUP BY skey, start
)
SELECT doc_id, size, source_size, target, CAST(CASE WHEN size > 0 THEN coalesce(served, 0) ELSE 0 END AS BIGINT) AS taken
FROM p LEFT JOIN g USING (skey, start)
"""

OP5 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(doc_id, -9223372036854775808) AS doc,
         string_split(coalesce(text, ''), chr(10)) AS lines
  FROM documents
), l AS (
  SELECT rid, doc, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), c AS (
  SELECT key, max(doc) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc) >= 3
), v AS (SELECT k.*, c.key IS NOT NULL AND k.doc <> c.top AS gone FROM k LEFT JOIN c USING (key)
), a AS (
  SELECT rid, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS kept
  FROM v GROUP BY rid
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM d JOIN a USING (rid)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_quality_rules": OP3, "op4_mix_sources": OP4, "op5_line_dedup": OP5}
