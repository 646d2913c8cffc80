"""Small log tables and plan access for the tests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.fixed_values import LOG_COLUMNS
from timberline.plans.prepare import log_entries
from timberline.sources.tables import with_row_id


def logs_of(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Log entries from (line_id, minute or None, level, event_id, message)."""
    table = spark.createDataFrame(
        rows, "line_id bigint, minute int, level string, event_id string, raw_message string"
    )
    start = F.lit("2024-03-01 00:00:00").cast("timestamp_ntz")
    return with_row_id(
        table.withColumns(
            {
                "log_timestamp": F.when(
                    F.col("minute").isNotNull(), start + F.make_dt_interval(mins=F.col("minute"))
                ),
                "normalized_message": F.lower("raw_message"),
                "event_template": F.lit(None).cast("string"),
            }
        ).drop("minute")
    )


def parsed(spark: SparkSession, lines: list[str], structured: list[tuple] = (), **options) -> dict:
    raw = spark.createDataFrame(list(enumerate(lines, 1)), "line_id bigint, raw_line string")
    companion = spark.createDataFrame(
        list(structured), "line_id bigint, raw_message string, event_id string, event_template string"
    )
    table = log_entries(raw, companion, **options)
    assert table.columns == list(LOG_COLUMNS)
    return {row.line_id: row for row in table.collect()}


def final_plan(table: DataFrame) -> str:
    return table._jdf.queryExecution().explainString(
        table.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
