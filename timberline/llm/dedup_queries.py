"""Queries of the deduplication operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.llm.exact_dedup import exact_groups
from timberline.llm.minhash_dedup import near_components
from timberline.llm.registry import given, query
from timberline.llm.substring_dedup import without_repeated_passages


@query(
    """SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(normal) AS text_sha256 FROM (
  SELECT doc_id, normal,
    first_value(doc_id) OVER (PARTITION BY normal ORDER BY points DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY normal) AS group_size
  FROM (SELECT doc_id, length(coalesce(text, '')) AS points,
      regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS normal FROM documents))"""
)
def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(given(spark, folder, "documents"))


@query(
    """WITH tokens AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, sha256(array_to_string(w[i : i + 34], ' ')) AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM tokens WHERE len(w) >= 35)),
repeated AS (
  SELECT doc_id, i FROM windows WHERE passage IN (SELECT passage FROM windows GROUP BY passage HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, i + j AS p FROM repeated, unnest(range(0, 35)) AS t(j)),
words AS (SELECT doc_id, p, w[p] AS word FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM tokens)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM tokens LEFT JOIN kept USING (doc_id)"""
)
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = without_repeated_passages(given(spark, folder, "documents"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


@query(
    """WITH RECURSIVE tokens AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM tokens WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reached AS (
  SELECT doc_id AS x, doc_id AS y FROM documents
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""
)
def op10_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_components(given(spark, folder, "documents"))
