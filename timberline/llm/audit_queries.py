"""The query of the filter audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from timberline.llm.filter_audit import filter_audit
from timberline.llm.registry import given, query


@query(
    """WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails
  FROM texts LEFT JOIN marks USING (doc_id)),
counts AS (SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY part, fails, good, toxic),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
  FROM orders, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
seen AS (
  SELECT part, filter_order, step, f, fails, good, toxic, n, contains(fails, f) AS here,
    translate(fails, earlier, '') <> fails AS gone
  FROM counts, steps),
summed AS (
  SELECT part, filter_order, step, any_value(f) AS f,
    coalesce(sum(n) FILTER (NOT gone AND NOT here), 0) AS kept,
    coalesce(sum(n) FILTER (here AND NOT gone), 0) AS removed,
    coalesce(sum(n) FILTER (here AND gone), 0) AS redundant,
    coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
    coalesce(sum(n) FILTER (here AND NOT gone AND good), 0) AS good_lost,
    coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0) AS toxic_lost
  FROM seen GROUP BY part, filter_order, step)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
  CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM summed"""
)
def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit(given(spark, folder, "documents"), given(spark, folder, "labels"))
