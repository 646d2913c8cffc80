"""Counts and trends over the log table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from checks.fixture import LogData, SEARCH_DIMENSION, rounded_sql
from checks.registry import over_logs, query
from timberline.operators.encoders import HashingEncoder
from timberline.operators.rollups import distinct_messages
from timberline.plans import analytics


@query(over_logs("SELECT level, count(*) AS count FROM logs GROUP BY level"))
def level_histogram(data: LogData) -> DataFrame:
    return analytics.level_histogram(data.logs())


@query(
    over_logs(
        """SELECT count(*) AS total_logs,
  CAST(count(*) FILTER (WHERE normalized_message IN (SELECT normalized_message FROM covered)) AS BIGINT) AS embedded_logs,
  (SELECT count(*) FROM covered) AS embedded_messages,
  count(DISTINCT event_id) AS event_count, min(log_timestamp) AS first_log, max(log_timestamp) AS last_log,
  """ + rounded_sql("(count(*) FILTER (WHERE normalized_message IN (SELECT normalized_message FROM covered)) / count(*)) * 100", 1) + """ AS coverage_pct
FROM logs""",
        "covered AS (SELECT DISTINCT normalized_message FROM logs WHERE event_template IS NOT NULL)",
    )
)
def table_statistics(data: LogData) -> DataFrame:
    """Vectors exist for the messages of known templates only."""
    logs = data.stored_logs()
    known = distinct_messages(logs.where("event_template IS NOT NULL"))
    vectors = HashingEncoder(SEARCH_DIMENSION).encode(known, "normalized_message")
    return analytics.table_statistics(logs, vectors)


FREQUENT_SQL = """SELECT event_id, coalesce(event_template, normalized_message) AS template, level, count(*) AS count
FROM logs WHERE {levels} GROUP BY ALL ORDER BY count DESC, event_id NULLS LAST, template, level LIMIT {limit}"""


@query(over_logs(FREQUENT_SQL.format(levels="level IN ('ERROR', 'CRITICAL', 'WARNING')", limit=15)))
def frequent_errors(data: LogData) -> DataFrame:
    return analytics.frequent_errors(data.logs())


@query(over_logs(FREQUENT_SQL.format(levels="level = 'INFO'", limit=40)))
def frequent_errors_level(data: LogData) -> DataFrame:
    return analytics.frequent_errors(data.logs(), 40, "INFO")


TIMELINE_SQL = """SELECT CAST(date_trunc('{unit}', log_timestamp) AS TIMESTAMP) AS bucket, count(*) AS count
FROM logs WHERE log_timestamp IS NOT NULL {more} GROUP BY bucket"""


@query(over_logs(TIMELINE_SQL.format(unit="day", more="")))
def timeline_day(data: LogData) -> DataFrame:
    return analytics.timeline(data.logs())


@query(over_logs(TIMELINE_SQL.format(unit="hour", more="AND level = 'ERROR'")))
def timeline_hour(data: LogData) -> DataFrame:
    return analytics.timeline(data.logs(), "hour", level="ERROR")


@query(over_logs(TIMELINE_SQL.format(unit="day", more="AND event_id = 'E5' AND level = 'CRITICAL'")))
def timeline_event(data: LogData) -> DataFrame:
    return analytics.timeline(data.logs(), event_id="E5", level="CRITICAL")
