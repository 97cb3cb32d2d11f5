"""DuckDB SQL for the training-data queries that SQL can express."""

from __future__ import annotations

OP3 = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM texts
), windows AS (
  SELECT doc_id, pos, list(word) OVER (PARTITION BY doc_id ORDER BY pos
    ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS seq FROM words
), numbered AS (
  SELECT doc_id, pos, row_number() OVER (
    PARTITION BY array_to_string(seq, ' ') ORDER BY doc_id, pos) AS nth
  FROM windows WHERE len(seq) = 20
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM numbered WHERE nth > 1
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT t.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

OP4 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    md5('42:' || doc_id) AS key FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight,
    row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sums
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / weight, rank
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (ORDER BY 2 * source_size / weight, rank
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM ranked
), targets AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * coalesce(
    max(CASE WHEN 2 * source_size / weight > level THEN level END) OVER (), 0::DOUBLE)) AS target
  FROM levels
), shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole
  FROM targets
), placed AS (
  SELECT d.*, s.source_size, s.target, s.whole, s.target - s.whole * s.source_size AS more,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (size * (whole + CASE WHEN before < more AND 2 * before + size <= 2 * more THEN 1 ELSE 0 END)
  )::BIGINT AS taken FROM placed
"""

OP6 = r"""
WITH RECURSIVE fine AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM fine a JOIN fine b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), least_ids AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(l.b, vec_id)) AS component_id,
  vec_id <= coalesce(l.b, vec_id) AS kept
FROM embeddings e LEFT JOIN counts c ON c.a = e.vec_id LEFT JOIN least_ids l ON l.a = e.vec_id
"""

OP7 = r"""
WITH texts AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY t)
"""

OP12 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), totals AS (
  SELECT count(*) FILTER (len(terms) > 0)::BIGINT AS n_docs, sum(len(terms))::BIGINT AS length FROM docs
), tfs AS (
  SELECT doc_id, term, len(terms) AS n, count(*) AS tf
  FROM (SELECT doc_id, terms, unnest(terms) AS term FROM docs) GROUP BY doc_id, term, terms
), dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
asked AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY item_id, term
), scores AS (
  SELECT item_id, doc_id, sum(repeats
      * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
      * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // length))))::BIGINT AS score
  FROM asked JOIN dfs USING (term) JOIN tfs USING (term), totals GROUP BY item_id, doc_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
  FROM scores WHERE score > 0
)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20
"""

ORACLE = {
    "op3_substring_dedup": OP3,
    "op4_source_mixing": OP4,
    "op6_embedding_near_dedup": OP6,
    "op7_exact_dedup": OP7,
    "op12_ranked_search": OP12,
}
