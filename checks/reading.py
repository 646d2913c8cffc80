"""Reading raw text and delimited files, and parsing lines into the log table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LOG_COLUMN_SQL, LogData
from checks.registry import over_logs, query
from timberline.fixed_values import LOG_COLUMNS
from timberline.plans.prepare import log_entries, parsed_lines, prepare
from timberline.schemas import LOG_ENTRIES
from timberline.session import shared_folder
from timberline.sinks.tables import export_csv
from timberline.sources.delimited import event_templates, exported_table, structured_lines
from timberline.sources.tables import LOGS, Tables
from timberline.sources.text_lines import first_lines, numbered_lines


def write_raw_text(data: LogData) -> str:
    """The raw lines as text files whose names follow the line order."""
    folder = shared_folder(data.spark, "raw")
    ordered = data.raw().repartitionByRange(8, "line_id").sortWithinPartitions("line_id")
    ordered.select("raw_line").write.text(folder)
    return folder


def write_structured_csv(data: LogData) -> str:
    folder = shared_folder(data.spark, "structured")
    export_csv(
        data.structured().select(
            F.col("line_id").alias("LineId"),
            F.lit("sshd").alias("Component"),
            F.col("raw_message").alias("Content"),
            F.col("event_id").alias("EventId"),
            F.col("event_template").alias("EventTemplate"),
        ),
        folder,
    )
    return folder


def write_templates_csv(data: LogData) -> str:
    folder = shared_folder(data.spark, "templates")
    export_csv(
        data.templates().select(
            F.col("event_id").alias("EventId"),
            F.col("event_template").alias("EventTemplate"),
            F.col("occurrences").alias("Occurrences"),
        ),
        folder,
        single_file=True,
    )
    return folder


@query(over_logs("SELECT line_id, raw_line FROM log_raw"))
def line_numbers(data: LogData) -> DataFrame:
    return numbered_lines(data.spark, write_raw_text(data))


@query(over_logs("SELECT line_id, raw_message, event_id, event_template FROM log_structured"))
def csv_structured(data: LogData) -> DataFrame:
    return structured_lines(data.spark, write_structured_csv(data))


@query(over_logs("SELECT event_id, event_template, occurrences FROM event_templates"))
def csv_templates(data: LogData) -> DataFrame:
    return event_templates(data.spark, write_templates_csv(data))


@query(over_logs(f"SELECT {LOG_COLUMN_SQL} FROM logs"))
def csv_log_table(data: LogData) -> DataFrame:
    folder = shared_folder(data.spark, "export")
    export_csv(data.logs().select(*LOG_COLUMNS), folder)
    return exported_table(data.spark, folder, LOG_ENTRIES)


@query(over_logs("SELECT line_id, level FROM logs WHERE line_id <= 5000"))
def limit_lines(data: LogData) -> DataFrame:
    """The deterministic sample: the first lines, cut before the join."""
    return log_entries(first_lines(data.raw(), 5000), data.structured()).select("line_id", "level")


@query(
    over_logs(
        "SELECT line_id, month, day, time_text, host, service, process_id, log_timestamp FROM parsed"
    )
)
def syslog_parse(data: LogData) -> DataFrame:
    return parsed_lines(data.raw()).select(
        "line_id", "month", "day", "time_text", "host", "service", "process_id", "log_timestamp"
    )


@query(over_logs(f"SELECT {LOG_COLUMN_SQL} FROM logs"))
def log_table(data: LogData) -> DataFrame:
    return data.logs().select(*LOG_COLUMNS)


@query(
    over_logs(
        "SELECT line_id, level, normalized_message FROM collapsed",
        "collapsed AS (SELECT line_id, "
        + "CASE WHEN contains(t, 'possible break-in attempt') OR contains(t, 'too many authentication failures') THEN 'CRITICAL' "
        + "WHEN contains(t, 'failed password') OR contains(t, 'authentication failure') OR contains(t, 'fatal') OR contains(t, 'error') OR contains(t, 'invalid user') OR contains(t, 'user unknown') THEN 'ERROR' "
        + "WHEN contains(t, 'disconnect') OR contains(t, 'closed by') OR contains(t, 'preauth') OR contains(t, 'reverse mapping') THEN 'WARNING' ELSE 'INFO' END AS level, "
        + "lower(trim(regexp_replace(coalesce(event_template, raw_message), '\\s+', ' ', 'g'))) AS normalized_message "
        + "FROM (SELECT *, lower(trim(regexp_replace(raw_message, '\\s+', ' ', 'g'))) AS t FROM joined))",
    )
)
def log_table_collapsed(data: LogData) -> DataFrame:
    """Severity and normalised message with doubled and outer spaces ignored."""
    table = log_entries(data.raw(), data.structured(), collapse=True)
    return table.select("line_id", "level", "normalized_message")


@query(over_logs(f"SELECT {LOG_COLUMN_SQL} FROM logs"))
def log_table_roundtrip(data: LogData) -> DataFrame:
    """Text and CSV files in, partitioned Parquet out, read back."""
    target = shared_folder(data.spark, "prepared")
    prepare(
        data.spark, write_raw_text(data), write_structured_csv(data), write_templates_csv(data), target
    )
    return Tables(data.spark, target).read(LOGS)
