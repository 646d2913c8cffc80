"""Keyword search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData
from checks.registry import over_documents, over_logs, query
from timberline.plans import search


RESULT_SQL = "id, line_id, log_timestamp, level, event_id, raw_message, event_template"
_TIME_ORDER_SQL = "log_timestamp NULLS LAST, line_id"


def keyword_sql(requests: str, condition: str, logs: str = "logs", columns: str = RESULT_SQL) -> str:
    chosen = ", ".join(f"l.{name}" for name in columns.split(", "))
    return f"""SELECT query_id, {columns}, rank FROM (
  SELECT q.query_id, q.top_k, {chosen},
    CAST(row_number() OVER (PARTITION BY q.query_id ORDER BY {_TIME_ORDER_SQL}) AS BIGINT) AS rank
  FROM {requests} q JOIN {logs} l ON ({condition}) AND (q.level IN ('ALL', '') OR q.level IS NULL OR l.level = q.level))
WHERE rank <= coalesce(top_k, 20)"""


_USER_REQUESTS = (
    "SELECT user_id AS query_id, 'FOR U' || CAST(user_id AS STRING) || ' FROM' AS text, "
    "CAST(NULL AS STRING) AS level, CAST(NULL AS INT) AS top_k FROM {events} GROUP BY user_id"
)


@query(
    over_logs(
        keyword_sql("asked", "contains(lower(l.raw_message), lower(q.text))"),
        f"asked AS ({_USER_REQUESTS.format(events='events')})",
    )
)
def keyword_search(data: LogData) -> DataFrame:
    """One request per user, in capitals."""
    requests = data.spark.sql(_USER_REQUESTS, events=data.given("events"))
    return search.keyword_search(requests, data.logs())


_HOST_REQUESTS = (
    "SELECT host_id AS query_id, CASE host_id % 2 WHEN 0 THEN 'password' ELSE 'authentication' END AS text, "
    "CASE host_id % 4 WHEN 0 THEN 'ERROR' WHEN 1 THEN 'CRITICAL' ELSE 'INFO' END AS level, "
    "CAST(host_id + 10 AS INT) AS top_k FROM (SELECT user_id % 8 AS host_id FROM {events} GROUP BY 1)"
)


@query(
    over_logs(
        keyword_sql("asked", "contains(lower(l.raw_message), lower(q.text))"),
        f"asked AS ({_HOST_REQUESTS.format(events='events')})",
    )
)
def keyword_search_level(data: LogData) -> DataFrame:
    requests = data.spark.sql(_HOST_REQUESTS, events=data.given("events"))
    return search.keyword_search(requests, data.logs())


@query(
    over_logs(
        keyword_sql(
            "(SELECT query_id, replace(text, '<*>', '%') AS text, level, top_k FROM requests)",
            "l.raw_message ILIKE '%' || q.text || '%' ESCAPE '\\'",
        )
    )
)
def keyword_wildcard(data: LogData) -> DataFrame:
    """Every template as a pattern with wildcards."""
    patterns = data.requests().withColumn("text", F.replace("text", F.lit("<*>"), F.lit("%")))
    return search.keyword_search(patterns, data.logs())


_DOCUMENT_RESULT_SQL = "id, line_id, log_timestamp, level, event_id, raw_message"


@query(
    over_documents(
        keyword_sql(
            "(SELECT item_id AS query_id, text, NULL AS level, 50 AS top_k FROM benchmark)",
            "contains(lower(l.raw_message), lower(q.text))",
            "document_logs",
            _DOCUMENT_RESULT_SQL,
        )
    )
)
def keyword_documents(data: LogData) -> DataFrame:
    """Benchmark items looked up, whole and literally, in whole documents."""
    requests = data.given("benchmark").select(
        F.col("item_id").alias("query_id"), "text", F.lit(50).alias("top_k")
    )
    found = search.keyword_search(requests, data.document_logs(), literal=True)
    return found.drop("event_template")


@query(
    over_logs(
        "SELECT * REPLACE (strftime(log_timestamp, '%Y-%m-%dT%H:%M:%S') AS log_timestamp) FROM ("
        + keyword_sql(
            "(SELECT query_id, split_part(text, ' ', 1) AS text, level, 40 AS top_k FROM requests)",
            "contains(lower(l.raw_message), lower(q.text))",
        )
        + ")"
    )
)
def result_export(data: LogData) -> DataFrame:
    """Results for export, for the first word of every template."""
    words = data.requests().withColumns({"text": F.split_part("text", F.lit(" "), F.lit(1)), "top_k": F.lit(40)})
    return search.rendered(search.keyword_search(words, data.logs()))


_DEEP_REQUESTS = """SELECT code AS query_id, CASE code % 4 WHEN 0 THEN 'password' WHEN 1 THEN 'from 10.0.' || CAST(code % 256 AS STRING)
    WHEN 2 THEN 'port _2 %' ELSE 'u' || CAST(code % 100 AS STRING) || ' ' END AS text,
  CASE code % 3 WHEN 0 THEN 'ERROR' ELSE 'ALL' END AS level,
  CAST(CASE WHEN code % 500 = 0 THEN 1500 ELSE 1 + code % 4 END AS INT) AS top_k
FROM (SELECT DISTINCT event_id % 4500 AS code FROM {events})"""


@query(
    over_logs(
        keyword_sql(
            "asked",
            "lower(l.raw_message) LIKE '%' || q.text || '%'",
        ),
        f"asked AS ({_DEEP_REQUESTS.format(events='events')})",
    )
)
def keyword_search_deep(data: LogData) -> DataFrame:
    """Many broad requests; a few ask for many more lines than the others."""
    requests = data.spark.sql(_DEEP_REQUESTS, events=data.given("events"))
    return search.keyword_search(requests, data.stored_logs())
