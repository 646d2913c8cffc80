"""Reports over stored tables, which read the summaries that two loads have left and no logs.

The first load brings the lines before noon and those without a time, the second one the rest. Days,
messages and events lie in both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData, SEARCH_DIMENSION, rounded_sql
from checks.registry import over_logs, query
from checks.searches import LOG_SEARCH, RESULT_SQL
from checks.trends import FREQUENT_SQL, TIMELINE_SQL
from timberline.operators.encoders import HashingEncoder
from timberline.plans import search, stored_analytics, summaries
from timberline.plans.load import load
from timberline.plans.vectorise import vectorise
from timberline.session import shared_folder
from timberline.sources.tables import Tables

_MORNING = "coalesce(time_text < '12:00:00', TRUE)"


def _loaded(data: LogData, vectors_after: int = 0) -> Tables:
    """The stored tables after both loads; messages of the first, or of both, get vectors."""
    tables = Tables(data.spark, shared_folder(data.spark, "stored"))
    logs, templates = data.stored_logs().drop("id"), data.templates()
    parts = ((_MORNING, templates), (f"NOT {_MORNING}", templates.where("false")))
    for number, (lines, new_templates) in enumerate(parts, 1):
        load(logs.where(lines), new_templates, tables, reset=number == 1)
        if number == vectors_after:
            vectorise(tables, HashingEncoder(SEARCH_DIMENSION))
    return tables


@query(over_logs(TIMELINE_SQL.format(unit="hour", more="AND event_id = 'E1'")))
def stored_timeline(data: LogData) -> DataFrame:
    return stored_analytics.timeline(_loaded(data), "hour", event_id="E1")


@query(over_logs("SELECT level, count(*) AS count FROM logs GROUP BY level"))
def stored_level_histogram(data: LogData) -> DataFrame:
    return stored_analytics.level_histogram(_loaded(data))


@query(over_logs(FREQUENT_SQL.format(levels="level IN ('ERROR', 'CRITICAL', 'WARNING')", limit=40)))
def stored_frequent_errors(data: LogData) -> DataFrame:
    return stored_analytics.frequent_errors(_loaded(data), 40)


_COVERED = "count(*) FILTER (WHERE normalized_message IN (SELECT normalized_message FROM covered))"


@query(
    over_logs(
        f"""SELECT count(*) AS total_logs, CAST({_COVERED} AS BIGINT) AS embedded_logs,
  (SELECT count(*) FROM covered) AS embedded_messages,
  count(DISTINCT event_id) AS event_count, min(log_timestamp) AS first_log, max(log_timestamp) AS last_log,
  {rounded_sql(f"({_COVERED} / count(*)) * 100", 1)} AS coverage_pct
FROM logs""",
        f"covered AS (SELECT DISTINCT normalized_message FROM logs WHERE {_MORNING})",
    )
)
def stored_statistics(data: LogData) -> DataFrame:
    """Messages that only the second load brought have no vector yet."""
    return stored_analytics.table_statistics(_loaded(data, vectors_after=1))


@query(
    over_logs(
        """SELECT CAST(date_trunc('day', log_timestamp) AS TIMESTAMP) AS bucket, count(*) AS count,
  count(DISTINCT normalized_message) AS exact_messages, count(DISTINCT host) AS exact_hosts, TRUE AS within_bound
FROM logs WHERE log_timestamp IS NOT NULL GROUP BY bucket"""
    )
)
def stored_distinct_estimates(data: LogData) -> DataFrame:
    """Estimates lie within 6 percent, three standard errors, of the exact counts beside them."""
    estimates = stored_analytics.distinct_estimates(_loaded(data))
    exact = (
        data.stored_logs()
        .groupBy(F.col("log_timestamp").cast("date").cast("timestamp_ntz").alias("bucket"))
        .agg(
            F.count_distinct("normalized_message").alias("exact_messages"),
            F.count_distinct("host").alias("exact_hosts"),
        )
    )

    def near(estimate: str, count: str) -> Column:
        return F.abs(F.col(estimate) - F.col(count)) <= 0.06 * F.col(count)

    within = near("messages", "exact_messages") & near("hosts", "exact_hosts")
    return estimates.join(exact, "bucket").select(
        "bucket", "count", "exact_messages", "exact_hosts", within.alias("within_bound")
    )


@query(
    over_logs(
        f"SELECT query_id, {RESULT_SQL}, round(similarity, 6) AS similarity, rank FROM found", *LOG_SEARCH
    )
)
def stored_level_search(data: LogData) -> DataFrame:
    """Requests, some with a level, over the stored level sets."""
    tables = _loaded(data, vectors_after=2)
    found = search.semantic_search(
        data.requests(),
        tables.logs(),
        tables.vectors(),
        HashingEncoder(SEARCH_DIMENSION),
        level_sets=summaries.level_sets(tables),
    )
    return found.withColumn("similarity", F.round("similarity", 6))
