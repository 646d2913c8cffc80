"""Evaluation: how well searches and encoders answer a table of requests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from timberline.fixed_values import (
    ALL_LEVELS,
    CANDIDATE_LIMIT,
    CANDIDATE_LIMIT_RANGE,
    DEFAULT_TOP_K,
    MAX_MODEL_TOP_K,
    MODEL_TOP_K,
)
from timberline.functions.labels import score, wanted_level
from timberline.operators.encoders import Encoder
from timberline.operators.quality import top_k_quality
from timberline.operators.requests import check_number, tidy_requests
from timberline.operators.rollups import by_frequency, distinct_messages
from timberline.operators.spread import spread_join
from timberline.operators.vectors import nearest
from timberline.plans.search import compare_search
from timberline.session import settled

QUALITY_COLUMNS = (
    "score",
    "average_similarity",
    "dominant_event_id",
    "dominant_event_share",
    "distinct_events",
    "result_count",
)


def evaluate_requests(
    requests: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    encoder: Encoder,
    default_top_k: int = DEFAULT_TOP_K,
) -> DataFrame:
    """Per request the number of results of both searches and the quality of the semantic ones."""
    asked = tidy_requests(requests, default_top_k)
    both = compare_search(requests, logs, vectors, encoder, default_top_k)
    # The searches run once; both reports below read their short results.
    both = settled(both.select("query_id", "method", "rank", "event_id", "similarity"), "results")
    per_method = both.groupBy("query_id").agg(
        F.count_if(F.col("method") == "semantic").alias("semantic_result_count"),
        F.count_if(F.col("method") == "keyword").alias("keyword_result_count"),
    )
    quality = top_k_quality(both.where(F.col("method") == "semantic"), asked)
    none = F.lit(0).cast("bigint")
    return (
        asked.select(
            "query_id",
            F.col("text").alias("query"),
            "top_k",
            F.coalesce("level", F.lit(ALL_LEVELS)).alias("level"),
        )
        .join(per_method, "query_id", "left")
        .join(quality, "query_id", "left")
        .select(
            "query_id",
            "query",
            "top_k",
            "level",
            F.coalesce("semantic_result_count", none).alias("semantic_result_count"),
            F.coalesce("keyword_result_count", none).alias("keyword_result_count"),
            *QUALITY_COLUMNS,
            "method",
        )
    )


def comparison_candidates(
    logs: DataFrame,
    top_k: int = MODEL_TOP_K,
    level: str | None = None,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """The most frequent distinct messages, optionally of one level, each with their number."""
    check_number("top_k", top_k, 1, MAX_MODEL_TOP_K)
    check_number("candidate_limit", candidate_limit, *CANDIDATE_LIMIT_RANGE)
    only = wanted_level(level)
    chosen = logs if only is None else logs.where(F.col("level") == only)
    return (
        distinct_messages(chosen)
        .select(
            "normalized_message",
            F.col("representative_event_id").alias("event_id"),
            F.col("representative_level").alias("level"),
            "occurrences",
        )
        .orderBy(*by_frequency())
        .limit(max(candidate_limit, top_k))
        # A window over the candidates, of which the domain allows 5000 at most.
        .withColumn("candidate_count", F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))))
    )


def model_results(
    requests: DataFrame,
    candidates: DataFrame,
    encoders: Sequence[Encoder],
    top_k: int = MODEL_TOP_K,
) -> DataFrame:
    """The best candidates per model and request; similarities are rounded as they are reported."""
    results = []
    for encoder in encoders:
        queries = encoder.encode(requests.select("query_id", "text"), "text").drop("text")
        items = encoder.encode(candidates.select("normalized_message"), "normalized_message")
        measured = items.agg(F.max(F.size("embedding"))).first()[0]
        found = nearest(queries, items, "normalized_message", top_k)
        results.append(
            # One message may be among the best of most requests.
            spread_join(found, candidates, ["normalized_message"], "query_id").select(
                F.lit(encoder.name).alias("model"),
                "query_id",
                "rank",
                "event_id",
                "level",
                "normalized_message",
                "occurrences",
                score(F.col("similarity")).alias("similarity"),
                "candidate_count",
                F.lit(measured).cast("int").alias("dimension"),
            )
        )
    return reduce(DataFrame.unionByName, results)


def compare_encoders(
    requests: DataFrame,
    logs: DataFrame,
    encoders: Sequence[Encoder],
    top_k: int = MODEL_TOP_K,
    level: str | None = None,
    candidate_limit: int = CANDIDATE_LIMIT,
) -> DataFrame:
    """Per model and request the quality of its best candidates, on the same candidates for all.

    The quality is taken from the rounded similarities of ``model_results``.
    """
    # Every model reads the candidates twice.
    candidates = settled(comparison_candidates(logs, top_k, level, candidate_limit), "candidates")
    results = model_results(requests, candidates, encoders, top_k)
    asked = [
        requests.select(F.lit(encoder.name).alias("model"), "query_id")
        for encoder in encoders
    ]
    pairs = reduce(DataFrame.unionByName, asked)
    counted = results.groupBy("model").agg(
        F.max("candidate_count").alias("_candidates"), F.max("dimension").alias("dimension")
    )
    return (
        top_k_quality(results, pairs, ("model", "query_id"))
        .join(pairs, ["model", "query_id"])
        .join(counted, "model", "left")
        .select(
            "model",
            "query_id",
            # Measured on the vectors; without candidates there is none.
            "dimension",
            F.coalesce("_candidates", F.lit(0).cast("bigint")).alias("candidate_count"),
            *QUALITY_COLUMNS,
        )
    )
