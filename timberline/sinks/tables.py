"""Writers of the stored tables; each reports the rows it wrote."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from timberline.schemas import RUNS
from timberline.sources.delimited import CSV_FORMAT

OVERWRITE, APPEND = "overwrite", "append"


def write_parquet(
    table: DataFrame, path: str, mode: str = OVERWRITE, by: tuple[str, ...] = (), looked_up: tuple[str, ...] = ()
) -> int:
    """Write a Parquet table and return its row count, taken during the write itself.

    Columns that are ``looked_up`` get Bloom filters as large as their distinct values ask for, so that
    a search for single values skips the row groups without them.
    """
    rows = Observation()
    counted = table.observe(rows, F.count(F.lit(1)).alias("rows"))
    writer = counted.write.mode(mode)
    if looked_up:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    for name in looked_up:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    if by:
        writer = writer.partitionBy(*by)
    writer.parquet(path)
    return rows.get["rows"]


def write_logs(logs: DataFrame, path: str, mode: str = OVERWRITE) -> int:
    """The log table, one folder per severity level so that a level filter prunes files.

    Rows inside a file follow event time, which gives Parquet narrow min/max ranges to skip by; lines
    are found by message and by number through Bloom filters.
    """
    ordered = logs.sortWithinPartitions("level", "log_timestamp", "line_id")
    return write_parquet(ordered, path, mode, ("level",), looked_up=("normalized_message", "line_id"))


def export_csv(table: DataFrame, path: str, single_file: bool = False) -> None:
    """Header CSV; one file is opt-in because it pulls the whole write into one task."""
    if single_file:
        table = table.coalesce(1)
    table.write.mode(OVERWRITE).options(
        **CSV_FORMAT, timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
    ).csv(path)


def append_run(
    spark: SparkSession,
    path: str,
    command: str,
    status: str,
    started_at: datetime,
    finished_at: datetime | None,
    details: Mapping | None = None,
) -> None:
    """Append one record to the run log; details are kept as a JSON text."""
    record = (
        uuid.uuid4().hex,
        command,
        status,
        json.dumps(details or {}, ensure_ascii=False),
        started_at,
        finished_at,
    )
    spark.createDataFrame([record], RUNS).coalesce(1).write.mode(APPEND).parquet(path)
