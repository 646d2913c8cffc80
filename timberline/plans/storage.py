"""Storage and run reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from timberline.functions.labels import run_timings
from timberline.plans.stored_analytics import table_statistics
from timberline.sources.tables import INDEX, LOGS, SCHEMAS, VECTORS, Tables, file_sizes

SUCCESS, FAILED = "SUCCESS", "FAILED"


def latest_run(runs: DataFrame) -> DataFrame:
    """The successful run that finished last, with its step timings; no row without one.

    One aggregate instead of a sort. A run without a finish time is never the latest.
    """
    finished = runs.where((F.col("status") == SUCCESS) & F.col("finished_at").isNotNull())
    newest = finished.agg(
        F.max_by(
            F.struct("command", "finished_at", "details"), F.struct("finished_at", "id")
        ).alias("_run")
    )
    return newest.where("_run IS NOT NULL").select(
        "_run.command",
        "_run.finished_at",
        "_run.details",
        run_timings(F.col("_run.details")).alias("timings"),
    )


def step_timings(latest: DataFrame) -> DataFrame:
    """One row per step of the latest run: ``command, finished_at, step, seconds``."""
    return latest.select("command", "finished_at", F.explode("timings").alias("step", "seconds"))


def table_sizes(spark: SparkSession, folders: dict[str, str | list[str]]) -> DataFrame:
    """Files and bytes per table, from file listings alone."""
    listed = [
        file_sizes(spark, path).agg(
            F.lit(name).alias("table"),
            F.count(F.lit(1)).alias("files"),
            F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"),
        )
        for name, path in folders.items()
    ]
    return reduce(DataFrame.unionByName, listed)


def storage_report(tables: Tables) -> DataFrame:
    """One row: table statistics, bytes per table, of the index and in all, and the latest successful run.

    The total is that of all current tables, templates, summaries and run log included.
    """
    spark = tables.spark
    names = {name: f"{name}_bytes" for name in SCHEMAS}
    present = {label: folders for name, label in names.items() if (folders := tables.folders(name))}
    none = spark.createDataFrame([], "table string, files bigint, bytes bigint")
    sizes = table_sizes(spark, present) if present else none
    by_name = sizes.agg(
        *[
            F.coalesce(F.max(F.when(F.col("table") == names[name], F.col("bytes"))), F.lit(0)).alias(names[name])
            for name in (LOGS, VECTORS, INDEX)
        ],
        F.sum("bytes").alias("total_bytes"),
    )
    newest = latest_run(tables.runs()).withColumnsRenamed(
        {name: f"latest_{name}" for name in ("command", "finished_at", "details", "timings")}
    )
    parts = [table_statistics(tables), by_name, newest]
    # Tables of at most one row each become one row; a map cannot be compared, so take any value.
    side_by_side = reduce(lambda left, right: left.unionByName(right, True), parts)
    return side_by_side.agg(
        *[F.any_value(name, F.lit(True)).alias(name) for name in side_by_side.columns]
    )
