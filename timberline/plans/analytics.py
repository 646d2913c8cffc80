"""Trends and counts over the log table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.fixed_values import DEFAULT_GROUP_LIMIT, MAX_GROUP_LIMIT, PROBLEM_LEVELS
from timberline.functions.labels import bucket, percentage, template_or_message, wanted_level
from timberline.operators.encoders import Encoder
from timberline.operators.requests import check_number, tidy_requests
from timberline.operators.spread import spread_join
from timberline.plans.search import nearest_events

_ANY_EVENT = "any"
_ONE_EVENT = "one"


def frequent_errors(
    logs: DataFrame, limit: int = DEFAULT_GROUP_LIMIT, level: str | None = None
) -> DataFrame:
    """The largest groups of problem lines; an explicit level replaces the default level set."""
    lines = logs.select("event_id", template_or_message().alias("template"), "level", F.lit(1).alias("lines"))
    return largest_groups(lines, limit, level)


def largest_groups(counts: DataFrame, limit: int, level: str | None) -> DataFrame:
    """``frequent_errors`` from numbers of ``lines`` per ``event_id, template, level`` and whatever else."""
    check_number("limit", limit, 1, MAX_GROUP_LIMIT)
    only = wanted_level(level)
    levels = F.col("level").isin(*PROBLEM_LEVELS) if only is None else F.col("level") == only
    groups = counts.where(levels).groupBy("event_id", "template", "level").agg(F.sum("lines").alias("count"))
    order = [
        F.desc("count"),
        F.asc_nulls_last("event_id"),
        F.asc("template"),
        F.asc("level"),
    ]
    return groups.orderBy(*order).limit(limit)


def timeline(
    logs: DataFrame,
    granularity: str = "day",
    event_id: str | None = None,
    level: str | None = None,
) -> DataFrame:
    """Lines per time bucket, ``bucket, count`` in time order."""
    chosen = logs.where(F.col("log_timestamp").isNotNull())
    if event_id:
        chosen = chosen.where(F.col("event_id") == event_id)
    only = wanted_level(level)
    if only is not None:
        chosen = chosen.where(F.col("level") == only)
    return (
        chosen.groupBy(bucket(F.col("log_timestamp"), granularity).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("bucket")
    )


def timelines(
    requests: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    encoder: Encoder,
    granularity: str = "day",
) -> DataFrame:
    """Per request a timeline, with the event ids found for its text.

    A request counts the lines of its ``event_id`` if it names one, else of the events nearest to its
    ``text``, else all lines. The optional ``level`` restricts the counted lines, not the choice of
    events. Lines are counted per event, level and bucket before they meet the requests.
    """
    if "event_id" not in requests.columns:
        requests = requests.withColumn("event_id", F.lit(None).cast("string"))
    asked = tidy_requests(requests).select(
        "query_id", F.col("level").alias("asked_level"), F.nullif("event_id", F.lit("")).alias("asked_event")
    )
    by_text = requests.where("coalesce(event_id, '') = '' AND coalesce(text, '') <> ''")
    events = (
        nearest_events(by_text, logs, vectors, encoder)
        .groupBy("query_id")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "event_id"))).alias("ranked"))
        .select("query_id", F.col("ranked.event_id").alias("matched_event_ids"))
    )

    def one(event: Column) -> Column:
        return F.struct(F.lit(_ONE_EVENT).alias("kind"), event.alias("event"))

    everything = F.struct(F.lit(_ANY_EVENT).alias("kind"), F.lit("").alias("event"))
    wants = (
        F.when(F.col("asked_event").isNotNull(), F.array(one(F.col("asked_event"))))
        .when(F.size("matched_event_ids") > 0, F.transform("matched_event_ids", one))
        .otherwise(F.array(everything))
    )
    no_events = F.array().cast("array<string>")
    wanted = (
        asked.join(events, "query_id", "left")
        .withColumn("matched_event_ids", F.coalesce("matched_event_ids", no_events))
        .select("query_id", "asked_level", "matched_event_ids", F.inline(wants))
    )
    # Every count serves its own event and the total, so the log table is read once.
    serves = F.array(one(F.col("event_id")), everything)
    counts = (
        logs.where(F.col("log_timestamp").isNotNull())
        .groupBy("event_id", "level", bucket(F.col("log_timestamp"), granularity).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("lines"))
        .select(F.inline(serves), "level", "bucket", "lines")
        .groupBy("kind", "event", "level", "bucket")
        .agg(F.sum("lines").alias("lines"))
    )
    return (
        # Most requests may ask for the same event, or for all.
        spread_join(wanted, counts, ["kind", "event"], "query_id")
        .where("asked_level IS NULL OR asked_level = level")
        .groupBy("query_id", "bucket", "matched_event_ids")
        .agg(F.sum("lines").alias("count"))
        .select("query_id", "bucket", "count", "matched_event_ids")
        .orderBy("query_id", "bucket")
    )


def level_histogram(logs: DataFrame) -> DataFrame:
    return (
        logs.groupBy("level").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "level")
    )


def table_statistics(logs: DataFrame, vectors: DataFrame) -> DataFrame:
    """One row: lines, lines and messages with a vector, events, first and last time, coverage.

    A single pass counts lines per message and event; every figure is then taken from that.
    """
    groups = logs.groupBy("normalized_message", "event_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("log_timestamp").alias("first_log"),
        F.max("log_timestamp").alias("last_log"),
    )
    return statistics_of(groups, vectors)


def statistics_of(groups: DataFrame, vectors: DataFrame) -> DataFrame:
    """``table_statistics`` from the lines and times per message, event and whatever else."""
    known = vectors.select("normalized_message", F.lit(True).alias("known"))
    zero = F.lit(0).cast("bigint")
    totals = groups.join(known, "normalized_message", "left").agg(
        F.coalesce(F.sum("lines"), zero).alias("total_logs"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("lines"))), zero).alias("embedded_logs"),
        F.count_distinct("event_id").alias("event_count"),
        F.min("first_log").alias("first_log"),
        F.max("last_log").alias("last_log"),
    )
    stored = vectors.agg(F.count(F.lit(1)).alias("embedded_messages"))
    # Two tables of one row each become one row.
    parts = totals.unionByName(stored, True)
    whole = parts.agg(*[F.max(name).alias(name) for name in parts.columns])
    return whole.select(
        "total_logs",
        "embedded_logs",
        "embedded_messages",
        "event_count",
        "first_log",
        "last_log",
        percentage(F.col("embedded_logs"), F.col("total_logs")).alias("coverage_pct"),
    )
