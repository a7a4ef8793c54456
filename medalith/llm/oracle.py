"""The queries of this subpackage that SQL can express, as DuckDB statements over the given tables."""

from __future__ import annotations

STATEMENTS: dict[str, str] = {
    "op9_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 GROUP BY key
), judged AS (
  SELECT doc_id, pos, line, coalesce(first_doc < doc_id, false) AS dropped FROM keyed LEFT JOIN firsts USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op10_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT shared.a, shared.b FROM shared JOIN sizes x ON x.doc_id = shared.a JOIN sizes y ON y.doc_id = shared.b
  WHERE 100 * shared.n >= 75 * (x.n + y.n - shared.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT documents.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM documents JOIN reach ON reach.a = documents.doc_id LEFT JOIN sizes ON sizes.doc_id = documents.doc_id
GROUP BY documents.doc_id, sizes.n""",
    "op12_phrase_collocations": r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), totals AS (
  SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang
), counts AS (
  SELECT lang, k, w[i:i + k - 1] AS p, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (VALUES (1), (2), (3)) AS lengths(k) WHERE len(w) >= k)
  GROUP BY ALL
), candidates AS (
  SELECT lang, k, p, f AS a FROM counts WHERE k > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.k, c.p, c.a, cut, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM candidates) c
  JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:cut] JOIN counts y ON y.lang = c.lang AND y.p = c.p[cut + 1:c.k]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1
), covered AS (
  SELECT DISTINCT s.lang, s.p FROM candidates s JOIN (
    SELECT lang, unnest([p[1:2], p[2:3]]) AS p, a FROM candidates WHERE k = 3
  ) longer ON longer.lang = s.lang AND longer.p = s.p WHERE 100 * longer.a >= 50 * s.a
), ranked AS (
  SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(p, ' '))) AS rank
  FROM lowest ANTI JOIN covered USING (lang, p)
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""",
}
