"""Table contracts and loading."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData
from checks.registry import over_logs, query
from timberline.operators import contracts
from timberline.plans.load import contract_report, load
from timberline.session import shared_folder
from timberline.sinks.tables import write_parquet
from timberline.sources.tables import LOGS, Tables


@query(
    """SELECT 'customer.c_custkey unique' AS rule, CAST(count(*) - count(DISTINCT c_custkey) AS BIGINT) AS violations FROM customer
UNION ALL SELECT 'orders.o_custkey unique', CAST(count(*) - count(DISTINCT o_custkey) AS BIGINT) FROM orders
UNION ALL SELECT 'lineitem.l_orderkey,l_partkey unique', CAST(sum(n - 1) AS BIGINT)
  FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey)"""
)
def check_unique(data: LogData) -> DataFrame:
    return (
        contracts.check_unique(data.given("customer"), "customer", ["c_custkey"])
        .unionByName(contracts.check_unique(data.given("orders"), "orders", ["o_custkey"]))
        .unionByName(contracts.check_unique(data.given("lineitem"), "lineitem", ["l_orderkey", "l_partkey"]))
    )


@query(
    over_logs(
        """SELECT 'log_entries.' || name || ' not null' AS rule, CAST(violations AS BIGINT) AS violations FROM (
  UNPIVOT (SELECT count(*) FILTER (WHERE line_id IS NULL) AS line_id, count(*) FILTER (WHERE log_timestamp IS NULL) AS log_timestamp,
    count(*) FILTER (WHERE event_id IS NULL) AS event_id, count(*) FILTER (WHERE raw_message IS NULL) AS raw_message FROM logs)
  ON line_id, log_timestamp, event_id, raw_message INTO NAME name VALUE violations)"""
    )
)
def check_not_null(data: LogData) -> DataFrame:
    return contracts.check_not_null(
        data.logs(), LOGS, ["line_id", "log_timestamp", "event_id", "raw_message"]
    )


@query(
    """SELECT 'orders.o_custkey references customer.c_custkey' AS rule, count(*) AS violations
FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL SELECT 'customer.c_custkey references orders.o_custkey', count(*)
FROM customer WHERE c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)"""
)
def check_fk(data: LogData) -> DataFrame:
    orders, customer = data.given("orders"), data.given("customer")
    forward = contracts.check_reference(orders, "orders", "o_custkey", customer, "customer", "c_custkey")
    backward = contracts.check_reference(customer, "customer", "c_custkey", orders, "orders", "o_custkey")
    return forward.unionByName(backward)


@query(
    """SELECT 'embeddings.embedding has 64 elements' AS rule, count(*) FILTER (WHERE len(embedding) <> 64) AS violations FROM embeddings
UNION ALL SELECT 'embeddings.embedding has 384 elements', count(*) FILTER (WHERE len(embedding) <> 384) FROM embeddings"""
)
def check_dim(data: LogData) -> DataFrame:
    vectors = data.given("embeddings")
    return contracts.check_dimension(vectors, "embeddings", "embedding", 64).unionByName(
        contracts.check_dimension(vectors, "embeddings", "embedding", 384)
    )


@query(
    over_logs(
        """SELECT l.line_id, 'OpenSSH' AS source, l.line_id AS id, coalesce(t.occurrences, 0) AS occurrences
FROM logs l LEFT JOIN event_templates t ON t.event_id = l.event_id"""
    )
)
def load_defaults(data: LogData) -> DataFrame:
    logs = contracts.with_log_defaults(data.logs().drop("source", "id"))
    joined = logs.join(data.templates().drop("event_template"), "event_id", "left")
    return contracts.with_template_defaults(joined).select("line_id", "source", "id", "occurrences")


@query(
    over_logs(
        """SELECT * FROM (
SELECT 'log_entries.line_id unique' AS rule, CAST(0 AS BIGINT) AS violations
UNION ALL SELECT 'event_templates.event_id unique', 0
UNION ALL SELECT 'log_entries.' || unnest(['line_id', 'source', 'level', 'raw_message', 'normalized_message']) || ' not null', 0
UNION ALL SELECT 'event_templates.' || unnest(['event_id', 'event_template']) || ' not null', 0
UNION ALL SELECT 'log_entries.line_id new', count(*) FROM logs WHERE level IN ('ERROR', 'CRITICAL')
UNION ALL SELECT 'event_templates.event_id new', 0
UNION ALL SELECT 'log_entries.event_id references event_templates.event_id', 0
UNION ALL SELECT 'stored lines', count(*) FROM logs)"""
    )
)
def load_append(data: LogData) -> DataFrame:
    """Problem lines are loaded first and the rest appended; all lines are then refused as stored."""
    target = Tables(data.spark, shared_folder(data.spark, "tables"))
    logs, templates = data.stored_logs(), data.templates()
    severe = F.col("level").isin("ERROR", "CRITICAL")
    load(logs.where(severe), templates, target)
    first = contract_report(logs, templates.where("false"), target.logs(), target.templates())
    report_folder = shared_folder(data.spark, "report")
    write_parquet(first, report_folder)
    load(logs.where(~severe), templates.where("false"), target, reset=False)
    stored = target.logs().agg(F.lit("stored lines").alias("rule"), F.count(F.lit(1)).alias("violations"))
    return data.spark.read.parquet(report_folder).unionByName(stored)
