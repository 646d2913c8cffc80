"""Preparation: raw lines and their structured companion become the log table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.fixed_values import LOG_COLUMNS, LOG_YEAR, SOURCE_NAME
from timberline.functions import syslog
from timberline.operators.once import computed_once
from timberline.sinks.tables import export_csv, write_logs, write_parquet
from timberline.sources.delimited import event_templates, structured_lines
from timberline.sources.tables import LOGS, TEMPLATES, Tables
from timberline.sources.text_lines import first_lines, numbered_lines


def parsed_lines(lines: DataFrame, year: int = LOG_YEAR) -> DataFrame:
    """``line_id, raw_line`` plus the typed prefix fields and ``content``; NULLs without a match."""
    parts = F.col("_parts")
    fields = {name: syslog.prefix_field(parts, name) for name in syslog.PREFIX_FIELDS}
    fields["service"] = F.trim(fields["service"])
    fields["day"] = fields["day"].try_cast("int")
    fields["process_id"] = fields["process_id"].try_cast("int")
    split = lines.withColumn("_parts", syslog.prefix_parts(F.col("raw_line")))
    time = syslog.event_time(F.col("month"), F.col("day"), F.col("time_text"), year)
    return computed_once(split, fields).drop("_parts").withColumn("log_timestamp", time)


def log_entries(
    lines: DataFrame,
    structured: DataFrame,
    year: int = LOG_YEAR,
    source: str = SOURCE_NAME,
    collapse: bool = False,
) -> DataFrame:
    """The 14 columns of the log table, one row per raw line.

    The message is the structured one, else the parsed one, else the whole line. ``collapse`` makes
    severity and normalised message ignore doubled and outer spaces.
    """
    joined = parsed_lines(lines.join(structured, "line_id", "left"), year).withColumn(
        "raw_message", F.coalesce("raw_message", "content", "raw_line")
    )
    marked = joined.withColumn("_markers", syslog.marker_text(F.col("raw_message"), collapse))
    derived = {
        "level": syslog.severity(F.col("_markers")),
        "normalized_message": syslog.normalized(F.coalesce("event_template", "raw_message"), collapse),
    }
    return computed_once(marked, derived).withColumn("source", F.lit(source)).select(*LOG_COLUMNS)


@dataclass(frozen=True)
class Prepared:
    log_rows: int
    template_rows: int
    log_path: str
    template_path: str


def prepare(
    spark: SparkSession,
    raw_log: str,
    structured_csv: str,
    templates_csv: str,
    target: str,
    limit: int | None = None,
    year: int = LOG_YEAR,
    csv_target: str | None = None,
    single_csv_file: bool = False,
) -> Prepared:
    """Read the three inputs and write the log and template tables below ``target``.

    The joined and parsed lines are computed once, for the Parquet write; the row counts come out
    of the writes and the optional CSV export reads the written tables.
    """
    lines = first_lines(numbered_lines(spark, raw_log), limit)
    logs = log_entries(lines, structured_lines(spark, structured_csv), year)
    tables = Tables(spark, target)
    log_rows = write_logs(logs, tables.path(LOGS))
    template_rows = write_parquet(event_templates(spark, templates_csv), tables.path(TEMPLATES))
    if csv_target is not None:
        exports = Tables(spark, csv_target)
        export_csv(tables.read(LOGS), exports.path(LOGS), single_csv_file)
        export_csv(tables.read(TEMPLATES), exports.path(TEMPLATES), single_csv_file)
    return Prepared(log_rows, template_rows, tables.path(LOGS), tables.path(TEMPLATES))
