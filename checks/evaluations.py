"""Quality of results and encoders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData, SEARCH_DIMENSION, cosine_sql, hashed_ctes, mean_sql, rounded_sql
from checks.messages import KNN_SQL, all_neighbours
from checks.registry import over_logs, query
from checks.searches import LOG_KEYWORD, LOG_SEARCH
from timberline.fixed_values import MODEL_ALIASES
from timberline.operators.encoders import HashingEncoder, full_model_name
from timberline.operators.quality import top_k_quality
from timberline.plans import evaluation
from timberline.session import settled


def _quality_ctes(rows: str, queries: str, by: str = "query_id") -> str:
    """CTE ``quality`` from ranked ``rows``, with zeros for ``queries`` without rows."""
    join = " AND ".join(f"q.{key} = t.{key}" for key in by.split(", "))
    event_join = " AND ".join(f"q.{key} = d.{key}" for key in by.split(", "))
    keys = ", ".join(f"q.{key}" for key in by.split(", "))
    return f"""named AS (SELECT *, coalesce(nullif(event_id, ''), 'UNKNOWN') AS event FROM {rows}),
per_event AS (SELECT {by}, event, count(*) AS n, min(rank) AS first_rank FROM named GROUP BY ALL),
dominant AS (SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY n DESC, first_rank) AS place FROM per_event) WHERE place = 1),
totals AS (SELECT {by}, {mean_sql('similarity')} AS mean, count(DISTINCT event) AS events, count(*) AS results FROM named GROUP BY ALL),
quality AS (
  SELECT {keys}, {rounded_sql('coalesce(t.mean, 0) * 0.65e0 + coalesce(d.n / t.results, 0) * 0.35e0', 4)} AS score,
    {rounded_sql('coalesce(t.mean, 0)', 4)} AS average_similarity, d.event AS dominant_event_id,
    {rounded_sql('coalesce(d.n / t.results, 0)', 4)} AS dominant_event_share,
    coalesce(t.events, 0) AS distinct_events, coalesce(t.results, 0) AS result_count,
    'proxy_similarity_event_concentration' AS method
  FROM {queries} q LEFT JOIN totals t ON {join} LEFT JOIN dominant d ON {event_join})"""


@query(
    f"""WITH ranked AS ({KNN_SQL}),
labelled AS (SELECT r.query_id, r.rank, r.sim AS similarity, 'L' || e.label AS event_id FROM ranked r JOIN embeddings e ON e.vec_id = r.item_id),
all_queries AS (SELECT vec_id AS query_id FROM embeddings),
{_quality_ctes('labelled', 'all_queries')}
SELECT * FROM quality"""
)
def quality_report(data: LogData) -> DataFrame:
    """Quality of every vector's ten nearest, with the label as event."""
    labels = data.given("embeddings").select(
        F.col("vec_id").alias("item_id"), F.concat(F.lit("L"), F.col("label").cast("string")).alias("event_id")
    )
    ranked = all_neighbours(data).join(labels, "item_id").withColumnRenamed("sim", "similarity")
    return top_k_quality(ranked, data.given("embeddings").select(F.col("vec_id").alias("query_id")))


@query(
    over_logs(
        """SELECT r.query_id, r.text AS query, coalesce(r.top_k, 20) AS top_k, r.level,
  (SELECT count(*) FROM both_methods b WHERE b.query_id = r.query_id AND b.method = 'semantic') AS semantic_result_count,
  (SELECT count(*) FROM both_methods b WHERE b.query_id = r.query_id AND b.method = 'keyword') AS keyword_result_count,
  q.score, q.average_similarity, q.dominant_event_id, q.dominant_event_share, q.distinct_events, q.result_count, q.method
FROM requests r JOIN quality q ON q.query_id = r.query_id""",
        *LOG_SEARCH,
        LOG_KEYWORD,
        _quality_ctes("found", "requests"),
    )
)
def query_evaluation(data: LogData) -> DataFrame:
    return evaluation.evaluate_requests(
        data.requests(), data.stored_logs(), data.vectors(), HashingEncoder(SEARCH_DIMENSION)
    )


_DIMENSIONS = (64, 128, 256)


def _model_sql() -> str:
    parts = []
    for size in _DIMENSIONS:
        parts.append(hashed_ctes(f"items{size}", "candidates", "normalized_message", "normalized_message", size))
        parts.append(hashed_ctes(f"asked{size}", "requests", "query_id", "text", size))
    scored = " UNION ALL ".join(
        f"SELECT 'hashing-{size}' AS model, q.query_id, v.normalized_message, {cosine_sql('q.embedding', 'v.embedding')} AS similarity FROM asked{size} q, items{size} v"
        for size in _DIMENSIONS
    )
    pairs = " UNION ALL ".join(
        f"SELECT 'hashing-{size}' AS model, {size} AS dimension, query_id FROM requests" for size in _DIMENSIONS
    )
    return ",\n".join(
        [
            "candidates AS (SELECT normalized_message, min(event_id) AS event_id, count(*) AS occurrences FROM logs GROUP BY normalized_message "
            "ORDER BY occurrences DESC, normalized_message LIMIT 500)",
            *parts,
            f"scored AS ({scored})",
            f"pairs AS ({pairs})",
            """best AS (SELECT model, query_id, rank, event_id, """ + rounded_sql("similarity", 4) + """ AS similarity FROM (
  SELECT s.*, c.event_id, row_number() OVER (PARTITION BY model, query_id ORDER BY similarity DESC, normalized_message) AS rank
  FROM scored s JOIN candidates c USING (normalized_message)) WHERE rank <= 10)""",
            _quality_ctes("best", "pairs", "model, query_id"),
        ]
    )


@query(
    over_logs(
        """SELECT p.model, p.query_id, p.dimension, (SELECT count(*) FROM candidates) AS candidate_count,
  q.score, q.average_similarity, q.dominant_event_id, q.dominant_event_share, q.distinct_events, q.result_count
FROM pairs p JOIN quality q ON q.model = p.model AND q.query_id = p.query_id""",
        _model_sql(),
    )
)
def compare_encoders(data: LogData) -> DataFrame:
    encoders = [HashingEncoder(size, f"hashing-{size}") for size in _DIMENSIONS]
    return evaluation.compare_encoders(data.requests(), data.stored_logs(), encoders)


@query(
    over_logs(
        """SELECT b.model, b.query_id, b.rank, b.event_id, b.similarity, p.dimension, (SELECT count(*) FROM candidates) AS candidate_count
FROM best b JOIN pairs p ON p.model = b.model AND p.query_id = b.query_id""",
        _model_sql(),
    )
)
def model_results(data: LogData) -> DataFrame:
    """The best candidates of every request per model, with the measured size of its vectors."""
    encoders = [HashingEncoder(size, f"hashing-{size}") for size in _DIMENSIONS]
    candidates = settled(evaluation.comparison_candidates(data.stored_logs()), "candidates")
    return evaluation.model_results(data.requests(), candidates, encoders).select(
        "model", "query_id", "rank", "event_id", "similarity", "dimension", "candidate_count"
    )


@query(
    "SELECT vec_id, CASE label WHEN 0 THEN 'sentence-transformers/all-MiniLM-L6-v2' "
    "WHEN 1 THEN 'sentence-transformers/multi-qa-MiniLM-L6-cos-v1' "
    "WHEN 2 THEN 'sentence-transformers/all-mpnet-base-v2' ELSE 'custom/model-' || label END AS model FROM embeddings"
)
def model_alias(data: LogData) -> DataFrame:
    """Labels stand for models; the first three have a short name."""
    short = F.array(*[F.lit(name) for name, _ in MODEL_ALIASES])
    name = F.when(F.col("label") < 3, F.get(short, F.col("label"))).otherwise(
        F.concat(F.lit("custom/model-"), F.col("label").cast("string"))
    )
    return data.given("embeddings").select("vec_id", full_model_name(name).alias("model"))
