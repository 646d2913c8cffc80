"""Roll-ups over log messages.

Log lines are first counted per distinct key combination. That step keeps only counters, so Spark
hashes instead of sorting, every task folds its repeats before the shuffle, and a message that owns
most lines shrinks to one row per task. Text minimums and sets are then taken on the small result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.functions.labels import bucket, template_or_message

# Registers of a stored sketch as a power of two: a standard error below 2 percent in at most 4 kB.
SKETCH_BITS = 12


def message_counts(logs: DataFrame) -> DataFrame:
    """Lines per (normalised message, event id, level)."""
    return logs.groupBy("normalized_message", "event_id", "level").agg(
        F.count(F.lit(1)).alias("lines")
    )


def distinct_messages(logs: DataFrame) -> DataFrame:
    """One row per normalised message: smallest event id and level by spelling, number of lines."""
    return counted_messages(message_counts(logs))


def counted_messages(counts: DataFrame) -> DataFrame:
    """``distinct_messages`` from counts per message, event id and level."""
    return counts.groupBy("normalized_message").agg(
        F.min("event_id").alias("representative_event_id"),
        F.min("level").alias("representative_level"),
        F.sum("lines").alias("occurrences"),
    )


def by_frequency() -> list[Column]:
    return [F.desc("occurrences"), F.asc("normalized_message")]


def short_name(message: str) -> Column:
    """Stands for a message where only its identity counts: a long one's digest, a short one itself, NULL for NULL."""
    # A digest has 65 characters here, so it is no short message. In a list of one, the message, which may
    # be long to compute, is computed once for all three uses.
    name = lambda text: F.when(F.length(text) <= 64, text).otherwise(F.concat(F.sha2(text, 256), F.lit("#")))
    return F.transform(F.array(message), name)[0]


def messages_without_vector(messages: DataFrame, vectors: DataFrame) -> DataFrame:
    """Distinct messages that have no vector yet."""
    return messages.join(vectors.select("normalized_message"), "normalized_message", "left_anti")


def levels_per_message(logs: DataFrame) -> DataFrame:
    """The levels each message occurs at, as a set that is no larger than the level domain."""
    return (
        logs.select("normalized_message", "level")
        .distinct()
        .groupBy("normalized_message")
        .agg(F.collect_set("level").alias("scopes"))
    )


def counted_levels(counts: DataFrame) -> DataFrame:
    """``levels_per_message`` from counts per message, event id and level."""
    return counts.groupBy("normalized_message").agg(F.collect_set("level").alias("scopes"))


def message_summary(logs: DataFrame) -> DataFrame:
    """Lines per message, event id, level and template, with their first and last time."""
    return logs.groupBy("normalized_message", "event_id", "level", template_or_message().alias("template")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("log_timestamp").alias("first_log"),
        F.max("log_timestamp").alias("last_log"),
    )


def merged_message_summaries(parts: DataFrame) -> DataFrame:
    """Summaries of several sets of lines as one of them all."""
    return parts.groupBy("normalized_message", "event_id", "level", "template").agg(
        F.sum("lines").alias("lines"),
        F.min("first_log").alias("first_log"),
        F.max("last_log").alias("last_log"),
    )


def hour_summary(logs: DataFrame) -> DataFrame:
    """Lines per hour, event id and level, with sketches of their distinct messages and hosts.

    Lines without a time have a NULL ``bucket``; a NULL host is not counted as one.
    """
    hour = bucket(F.col("log_timestamp"), "hour").alias("bucket")
    return logs.groupBy(hour, "event_id", "level").agg(
        F.count(F.lit(1)).alias("lines"),
        F.hll_sketch_agg("normalized_message", SKETCH_BITS).alias("message_sketch"),
        F.hll_sketch_agg("host", SKETCH_BITS).alias("host_sketch"),
    )


def merged_hour_summaries(parts: DataFrame) -> DataFrame:
    """Summaries of several sets of lines as one of them all."""
    return parts.groupBy("bucket", "event_id", "level").agg(
        F.sum("lines").alias("lines"),
        F.hll_union_agg("message_sketch").alias("message_sketch"),
        F.hll_union_agg("host_sketch").alias("host_sketch"),
    )
