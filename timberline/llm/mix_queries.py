"""Queries of mixing and packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timberline.llm.mixing import mixed_documents
from timberline.llm.packing import packed_documents
from timberline.llm.registry import given, query


@query(
    """WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    -ln((('0x' || substr(md5('mix-1|' || CAST(doc_id AS VARCHAR) || '|' || coalesce(text, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / (0.1::DOUBLE + 0.9::DOUBLE * length(regexp_replace(coalesce(text, ''), '[^\\p{L}]+', '', 'g')) / greatest(length(coalesce(text, '')), 1)) AS place
  FROM documents),
sources AS (
  SELECT source, source_size, 3 * source_size AS cap,
    [1, 2, 3][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1]::DOUBLE AS weight
  FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM rows GROUP BY source)),
levels AS (
  SELECT *, ((SELECT sum(source_size) FROM sources) - coalesce(sum(cap) OVER earlier, 0))::DOUBLE
      / ((SELECT sum(weight) FROM sources) - coalesce(sum(weight) OVER earlier, 0)) AS level
  FROM sources
  WINDOW earlier AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT max(level) FROM levels WHERE cap >= level * weight)) AS target FROM levels),
epochs AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM targets)
SELECT doc_id, r.source, size, source_size, target, epochs,
  CAST(epochs * size + CASE WHEN sum(size) OVER (PARTITION BY r.source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING)
    - size / 2.0::DOUBLE <= target - epochs * source_size THEN size ELSE 0 END AS BIGINT) AS taken
FROM rows r JOIN epochs e ON r.source IS NOT DISTINCT FROM e.source"""
)
def op5_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_documents(given(spark, folder, "documents"))


@query()
def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(given(spark, folder, "documents"))
