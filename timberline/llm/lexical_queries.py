"""The query of lexical search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timberline.llm.lexical_search import ranked_documents
from timberline.llm.registry import given, query


@query(
    """WITH lowered AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
sizes AS (SELECT row_number() OVER () AS r, doc_id, w, len(w)::BIGINT AS n FROM lowered WHERE len(w) > 0),
whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
counts AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(w) AS term FROM sizes) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS weight
  FROM counts, whole GROUP BY term, docs),
wanted AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)),
scored AS (
  SELECT i, item_id, r, doc_id,
    CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (r), whole
  GROUP BY i, item_id, r, doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS INT) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10"""
)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_documents(given(spark, folder, "documents"), given(spark, folder, "benchmark"))
