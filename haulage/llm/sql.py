"""DuckDB SQL for the rows of operators whose SQL is long."""

from __future__ import annotations

#: Windows of 100 bytes, put together from shorter ones as hexadecimal text.
SUFFIXES = """
WITH ranked AS (
  SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, text) AS d, doc_id, coalesce(text, '') AS text FROM documents
), bytes AS (
  SELECT d, unnest(range(octet_length(encode(text)))) AS pos, unnest(regexp_extract_all(hex(encode(text)), '..')) AS s1 FROM ranked
), w2 AS (SELECT *, s1 || lead(s1, 1) OVER w AS s2 FROM bytes WINDOW w AS (PARTITION BY d ORDER BY pos)
), w4 AS (SELECT *, s2 || lead(s2, 2) OVER w AS s4 FROM w2 WINDOW w AS (PARTITION BY d ORDER BY pos)
), w12 AS (SELECT d, pos, s1, s4, s4 || lead(s4, 4) OVER w || lead(s4, 8) OVER w AS s12 FROM w4 WINDOW w AS (PARTITION BY d ORDER BY pos)
), w48 AS (SELECT d, pos, s1, s4, s12 || lead(s12, 12) OVER w || lead(s12, 24) OVER w || lead(s12, 36) OVER w AS s48 FROM w12 WINDOW w AS (PARTITION BY d ORDER BY pos)
), w100 AS (SELECT d, pos, s1, md5(s48 || lead(s48, 48) OVER w || lead(s4, 96) OVER w) AS s100 FROM w48 WINDOW w AS (PARTITION BY d ORDER BY pos)
), marked AS (
  SELECT d, pos, s1, s100 IS NOT NULL AND row_number() OVER (PARTITION BY s100 ORDER BY d, pos) > 1 AS late FROM w100
), covered AS (
  SELECT d, pos, s1, max(CAST(late AS INT)) OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) = 1 AS gone FROM marked
), spans AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY d ORDER BY pos), false) AS begins FROM covered
), left_over AS (
  SELECT d, count(*) AS n_bytes, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
         string_agg(s1, '' ORDER BY pos) FILTER (NOT gone) AS kept
  FROM spans GROUP BY d
)
SELECT doc_id, coalesce(n_bytes, 0) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM ranked LEFT JOIN left_over USING (d)
"""
#: Windows of 35 words.
PASSAGES = """
WITH texts AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), places AS (
  SELECT d, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM texts
), windows AS (
  SELECT d, pos, word, CASE WHEN lead(pos, 34) OVER w IS NOT NULL THEN md5(string_agg(word, ' ') OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) END AS phrase
  FROM places WINDOW w AS (PARTITION BY d ORDER BY pos)
), counted AS (
  SELECT *, phrase IS NOT NULL AND count(*) OVER (PARTITION BY phrase) > 1 AS again FROM windows
), covered AS (
  SELECT d, pos, word, max(CAST(again AS INT)) OVER (PARTITION BY d ORDER BY pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) = 1 AS gone FROM counted
), left_over AS (
  SELECT d, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM covered GROUP BY d
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN left_over USING (d)
"""
#: All pairs of documents that share a shingle, and what they reach.
NEAR = """
WITH RECURSIVE lowered AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), shingles AS (
  SELECT DISTINCT d, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 4], ' ') END AS shingle
  FROM (SELECT d, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM lowered WHERE len(words) > 0)
), sizes AS (
  SELECT d, count(*) AS n FROM shingles GROUP BY d
), links AS (
  SELECT x.d AS a, y.d AS b FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.d <> y.d
  GROUP BY x.d, y.d, (SELECT n FROM sizes WHERE d = x.d), (SELECT n FROM sizes WHERE d = y.d)
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes WHERE d = x.d) + (SELECT n FROM sizes WHERE d = y.d) - count(*))
), reached AS (
  SELECT d, d AS other FROM lowered UNION SELECT r.d, l.b FROM reached r JOIN links l ON l.a = r.other
)
SELECT x.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y.doc_id) AS component_id, x.doc_id = min(y.doc_id) AS kept
FROM lowered x JOIN reached r ON r.d = x.d JOIN lowered y ON y.d = r.other LEFT JOIN sizes s ON s.d = x.d GROUP BY x.d, x.doc_id
"""
