"""Runs, sizes, requests and whole jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData, SEARCH_DIMENSION
from checks.reading import write_raw_text, write_structured_csv, write_templates_csv
from checks.registry import over_logs, query
from timberline.operators.encoders import HashingEncoder
from timberline.operators.requests import validate_requests
from timberline.operators.rollups import distinct_messages
from timberline.plans.full_run import Inputs, run_all
from timberline.plans.load import load
from timberline.plans.storage import latest_run, step_timings, storage_report, table_sizes
from timberline.plans.vectorise import encoding_totals, new_vectors, refresh_vectors, vectorise
from timberline.schemas import EVENT_TEMPLATES
from timberline.session import shared_folder
from timberline.sinks.tables import export_csv, write_parquet
from timberline.sources.delimited import exported_table
from timberline.sources.tables import Tables, VECTORS


def _runs(data: LogData) -> DataFrame:
    """Orders as runs: the priority is the command, prices and customers are step seconds."""
    timings = F.struct(F.col("o_totalprice").alias("prepare_data"), F.col("o_custkey").cast("double").alias("embed"))
    details = F.when(F.col("o_orderstatus") != "P", F.to_json(F.struct(timings.alias("timings"))))
    return data.given("orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_orderpriority").alias("command"),
        F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCESS").alias("status"),
        F.coalesce(details, F.lit("{}")).alias("details"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("started_at"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("finished_at"),
    )


_LATEST_SQL = """latest AS (SELECT * FROM orders WHERE o_orderstatus <> 'F' AND o_orderdate IS NOT NULL
  ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC LIMIT 1)"""


@query(
    f"WITH {_LATEST_SQL} SELECT o_orderpriority AS command, CAST(o_orderdate AS TIMESTAMP) AS finished_at, "
    "CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2 END AS steps FROM latest"
)
def latest_success(data: LogData) -> DataFrame:
    return latest_run(_runs(data)).select("command", "finished_at", F.size("timings").alias("steps"))


@query(
    """WITH newest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
    ORDER BY o_orderdate DESC, CAST(o_orderkey AS VARCHAR) DESC) AS place FROM orders WHERE o_orderstatus = 'O') WHERE place = 1)
SELECT o_orderpriority AS command, CAST(o_orderdate AS TIMESTAMP) AS finished_at, 'prepare_data' AS step, o_totalprice AS seconds FROM newest
UNION ALL SELECT o_orderpriority, CAST(o_orderdate AS TIMESTAMP), 'embed', CAST(o_custkey AS DOUBLE) FROM newest"""
)
def run_timings(data: LogData) -> DataFrame:
    """Step timings of the latest complete run of every command."""
    runs = _runs(data).where("details <> '{}'")
    commands = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    tables = [step_timings(latest_run(runs.where(F.col("command") == name))) for name in commands]
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table)
    return result


@query(
    """SELECT query_id, accepted, CASE WHEN text = '' THEN 'empty query' WHEN NOT (top_k BETWEEN 1 AND 200) THEN 'top_k out of range'
  WHEN level NOT IN ('', 'ALL', 'CRITICAL', 'ERROR', 'WARNING', 'INFO') THEN 'unknown level' END AS reason
FROM (SELECT *, text <> '' AND top_k BETWEEN 1 AND 200 AND level IN ('', 'ALL', 'CRITICAL', 'ERROR', 'WARNING', 'INFO') AS accepted
  FROM (SELECT conv_id * 100 + turn AS query_id, CASE WHEN role = 'system' THEN '' ELSE text END AS text, length(text) AS top_k,
    CASE WHEN turn % 4 = 0 THEN 'ALL' WHEN turn % 4 = 1 THEN 'NOTICE' WHEN turn % 4 = 2 THEN 'ERROR' ELSE '' END AS level FROM conversations))"""
)
def request_validation(data: LogData) -> DataFrame:
    """Conversation turns as requests; their length is the number of results asked for."""
    turn = F.col("turn") % 4
    requests = data.given("conversations").select(
        (F.col("conv_id") * 100 + F.col("turn")).alias("query_id"),
        F.when(F.col("role") == "system", "").otherwise(F.col("text")).alias("text"),
        F.length("text").alias("top_k"),
        F.when(turn == 0, "ALL").when(turn == 1, "NOTICE").when(turn == 2, "ERROR").otherwise("").alias("level"),
    )
    return validate_requests(requests).select("query_id", "accepted", "reason")


@query(
    over_logs(
        """SELECT 'first' AS batch, count(*) AS distinct_texts, CAST(sum(n) AS BIGINT) AS covered_logs FROM per_message WHERE place <= 7
UNION ALL SELECT 'rest', count(*), CAST(sum(n) AS BIGINT) FROM per_message WHERE place > 7
UNION ALL SELECT 'nothing left', 0, 0""",
        """per_message AS (SELECT *, row_number() OVER (ORDER BY n DESC, normalized_message) AS place
  FROM (SELECT normalized_message, count(*) AS n FROM logs GROUP BY normalized_message))""",
    )
)
def incremental_vectors(data: LogData) -> DataFrame:
    """The most frequent messages are encoded first, then all others, then none is left."""
    encoder = HashingEncoder(SEARCH_DIMENSION)
    logs, spark = data.stored_logs(), data.spark
    folder = Tables(spark, shared_folder(spark, "vectors")).path(VECTORS)
    nothing = data.vectors().withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz")).where("false")
    first = new_vectors(logs, nothing, encoder, limit=7)
    write_parquet(first, folder)
    stored = spark.read.parquet(folder)
    rest = new_vectors(logs, stored, encoder)
    left = new_vectors(logs, stored.unionByName(rest), encoder)

    def named(name: str, rows: DataFrame) -> DataFrame:
        return encoding_totals(rows).select(F.lit(name).alias("batch"), "distinct_texts", "covered_logs")

    return named("first", stored).unionByName(named("rest", rest)).unionByName(named("nothing left", left))


@query()
def given_table_sizes(data: LogData) -> DataFrame:
    names = ("events", "documents", "embeddings", "orders", "lineitem")
    return table_sizes(data.spark, {name: f"{data.folder}/{name}.parquet" for name in names})


@query(
    over_logs(
        """SELECT count(*) AS total_logs, count(*) AS embedded_logs, count(DISTINCT normalized_message) AS embedded_messages,
  count(DISTINCT event_id) AS event_count, min(log_timestamp) AS first_log, max(log_timestamp) AS last_log, 100.0::DOUBLE AS coverage_pct,
  TRUE AS has_logs, TRUE AS has_vectors, TRUE AS has_index, TRUE AS adds_up, 'run-all' AS command, 5 AS steps,
  count(*) AS loaded_logs, (SELECT count(*) FROM event_templates) AS loaded_templates
FROM logs"""
    )
)
def full_run(data: LogData) -> DataFrame:
    """Files in, all tables out, then the storage report over them."""
    target = shared_folder(data.spark, "run")
    inputs = Inputs(write_raw_text(data), write_structured_csv(data), write_templates_csv(data))
    run_all(data.spark, inputs, target, HashingEncoder(SEARCH_DIMENSION))
    parts = ("log_entries_bytes", "message_embeddings_bytes", "message_index_bytes")
    loaded = "struct<loaded:struct<log_entries:bigint,event_templates:bigint>>"
    details = F.from_json("latest_details", loaded)["loaded"]
    return storage_report(Tables(data.spark, target)).select(
        "total_logs",
        "embedded_logs",
        "embedded_messages",
        "event_count",
        "first_log",
        "last_log",
        "coverage_pct",
        *[(F.col(name) > 0).alias(label) for name, label in zip(parts, ("has_logs", "has_vectors", "has_index"))],
        (F.col("total_bytes") > sum(map(F.col, parts[1:]), F.col(parts[0]))).alias("adds_up"),
        F.col("latest_command").alias("command"),
        F.size("latest_timings").alias("steps"),
        details["log_entries"].alias("loaded_logs"),
        details["event_templates"].alias("loaded_templates"),
    )


@query(
    over_logs(
        """SELECT normalized_message, min(event_id) AS representative_event_id,
  CASE WHEN contains(normalized_message, 'password') THEN 'CHANGED' ELSE min(level) END AS representative_level,
  count(*) AS occurrences FROM logs GROUP BY normalized_message"""
    )
)
def vector_refresh(data: LogData) -> DataFrame:
    """Vectors of half the lines are stored, some come again changed, the rest arrive; counts are anew."""
    spark, encoder = data.spark, HashingEncoder(SEARCH_DIMENSION)
    tables = Tables(spark, shared_folder(spark, "refreshed"))
    logs = data.stored_logs().drop("id")
    load(logs, data.templates(), tables)
    vectorise(tables, encoder, limit=6)
    early = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    late = F.lit("2124-01-01 00:00:00").cast("timestamp_ntz")
    every = encoder.encode(distinct_messages(tables.logs()), "normalized_message")
    changed = every.where("contains(normalized_message, 'password')").withColumn("representative_level", F.lit("CHANGED"))
    missing = every.join(tables.vectors(), "normalized_message", "left_anti")
    changes = (
        missing.withColumn("updated_at", early)
        .unionByName(changed.withColumn("updated_at", late))
        .select(*tables.vectors().columns)
    )
    refresh_vectors(tables, changes, encoder)
    return tables.vectors().select(
        "normalized_message", "representative_event_id", "representative_level", "occurrences"
    )


@query(over_logs("SELECT event_id, event_template, occurrences FROM event_templates"))
def template_table_roundtrip(data: LogData) -> DataFrame:
    folder = shared_folder(data.spark, "templates")
    export_csv(data.templates(), folder)
    return exported_table(data.spark, folder, EVENT_TEMPLATES)
