"""Queries of the operators on vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timberline.llm.embedding_dedup import linked_vectors
from timberline.llm.registry import given, query


@query(
    """WITH RECURSIVE given AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
units AS (
  SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS norm FROM given
  WHERE v IS NOT NULL AND len(v) > 0 AND len([x FOR x IN v IF x IS NULL OR NOT isfinite(x)]) = 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM units a JOIN units b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND a.norm > 0 AND b.norm > 0
    AND list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
reached AS (
  SELECT vec_id AS x, vec_id AS y FROM given UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x),
least AS (SELECT x AS vec_id, min(y) AS component_id FROM reached GROUP BY x),
counts AS (SELECT x AS vec_id, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM least LEFT JOIN counts USING (vec_id)"""
)
def op9_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linked_vectors(given(spark, folder, "embeddings"))
