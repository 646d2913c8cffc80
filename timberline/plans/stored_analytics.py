"""The reports of ``analytics`` over stored tables, from their summaries alone: no log file is read.

All give what their namesakes give over ``tables.logs()``. ``distinct_estimates`` has none: counts of
distinct values do not add up over hours, so it unites sketches and is approximate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.fixed_values import DEFAULT_GROUP_LIMIT
from timberline.functions.labels import bucket, wanted_level
from timberline.plans import analytics, summaries
from timberline.sources.tables import Tables


def frequent_errors(tables: Tables, limit: int = DEFAULT_GROUP_LIMIT, level: str | None = None) -> DataFrame:
    return analytics.largest_groups(summaries.messages(tables), limit, level)


def timeline(
    tables: Tables, granularity: str = "day", event_id: str | None = None, level: str | None = None
) -> DataFrame:
    chosen = _chosen_hours(tables, event_id, level)
    return (
        chosen.groupBy(bucket(F.col("bucket"), granularity).alias("bucket"))
        .agg(F.sum("lines").alias("count"))
        .orderBy("bucket")
    )


def distinct_estimates(
    tables: Tables, granularity: str = "day", event_id: str | None = None, level: str | None = None
) -> DataFrame:
    """Per time bucket its lines, and about how many distinct messages and hosts they have.

    ``bucket, count, messages, hosts``: the standard error of the last two is below 2 percent, and
    counts of a few dozen are exact in practice. Lines without a time are left out.
    """
    return (
        _chosen_hours(tables, event_id, level)
        .groupBy(bucket(F.col("bucket"), granularity).alias("bucket"))
        .agg(
            F.sum("lines").alias("count"),
            F.hll_sketch_estimate(F.hll_union_agg("message_sketch")).alias("messages"),
            F.hll_sketch_estimate(F.hll_union_agg("host_sketch")).alias("hosts"),
        )
        .orderBy("bucket")
    )


def _chosen_hours(tables: Tables, event_id: str | None, level: str | None) -> DataFrame:
    chosen = summaries.hours(tables).where(F.col("bucket").isNotNull())
    if event_id:
        chosen = chosen.where(F.col("event_id") == event_id)
    only = wanted_level(level)
    return chosen if only is None else chosen.where(F.col("level") == only)


def level_histogram(tables: Tables) -> DataFrame:
    return (
        summaries.hours(tables)
        .groupBy("level")
        .agg(F.sum("lines").alias("count"))
        .orderBy(F.desc("count"), "level")
    )


def table_statistics(tables: Tables) -> DataFrame:
    return analytics.statistics_of(summaries.messages(tables), tables.vectors())
