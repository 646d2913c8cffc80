"""Proxy quality of ranked results: mean similarity and concentration on one event."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.fixed_values import QUALITY_METHOD, SHARE_WEIGHT, SIMILARITY_WEIGHT
from timberline.functions.labels import event_or_unknown, score


def top_k_quality(
    rows: DataFrame, queries: DataFrame | None = None, by: tuple[str, ...] = ("query_id",)
) -> DataFrame:
    """One report row per query from ``rows`` with ``rank``, ``event_id`` and ``similarity``.

    Of equally frequent events the one ranked first dominates. With ``queries`` given, a query
    without results reports zeros. Rows are folded per (query, event) before they meet per query.
    """
    per_event = (
        rows.withColumn("event", event_or_unknown(F.col("event_id")))
        .groupBy(*by, "event")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.min("rank").alias("first_rank"),
            # Decimal sums do not depend on the order in which tasks deliver their parts.
            F.sum(F.col("similarity").cast("decimal(20,18)")).alias("total"),
            F.count("similarity").alias("scored"),
        )
    )
    per_query = per_event.groupBy(*by).agg(
        F.coalesce(F.try_divide(F.sum("total").cast("double"), F.sum("scored")), F.lit(0.0)).alias("mean"),
        F.max_by("event", F.struct(F.col("lines"), -F.col("first_rank"))).alias("dominant_event_id"),
        (F.max("lines") / F.sum("lines")).alias("share"),
        F.count(F.lit(1)).alias("distinct_events"),
        F.sum("lines").alias("result_count"),
    )
    if queries is not None:
        per_query = queries.select(*by).join(per_query, list(by), "left")
    zero, none = F.lit(0.0), F.lit(0).cast("bigint")
    mean, share = F.coalesce("mean", zero), F.coalesce("share", zero)
    return per_query.select(
        *by,
        score(mean * SIMILARITY_WEIGHT + share * SHARE_WEIGHT).alias("score"),
        score(mean).alias("average_similarity"),
        "dominant_event_id",
        score(share).alias("dominant_event_share"),
        F.coalesce("distinct_events", none).alias("distinct_events"),
        F.coalesce("result_count", none).alias("result_count"),
        F.lit(QUALITY_METHOD).alias("method"),
    )
