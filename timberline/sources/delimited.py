"""Header CSV files: the structured companion of a raw log, its templates, exported tables."""

from __future__ import annotations

import csv
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from timberline.schemas import STRUCTURED_CSV, TEMPLATES_CSV
from timberline.sources.tables import file_sizes

# Quotes inside a field are doubled, the usual CSV rule; Spark's own default is a backslash. White
# space belongs to its field; the writer would trim it by default.
CSV_FORMAT = {
    "header": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _places(header: str | None, names: list[str]) -> tuple:
    """Where a header has the named columns; the header itself if not each is there once."""
    found = next(csv.reader([header or ""]), [])
    if any(found.count(name) != 1 for name in names):
        return (header,)
    return tuple(found.index(name) for name in names)


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The named columns of all files, each found by the header of its own file.

    Spark binds the columns of all files by the header of one, so files are read in groups that have
    the named columns in the same places. A file without one of the columns is an error.
    """
    first_lines = (
        spark.read.text(path)
        .where("_metadata.file_block_start = 0")
        .select(F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("at"), "value")
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("header"))
    )
    alike: dict[tuple, list[str]] = {}
    for row in first_lines.groupBy("header").agg(F.collect_list("file").alias("files")).toLocalIterator():
        alike.setdefault(_places(row["header"], schema.fieldNames()), []).extend(map(unquote, row["files"]))
    if len(alike) <= 1:
        return spark.read.options(**CSV_FORMAT).csv(path).select(*schema.fieldNames())
    groups = [spark.read.options(**CSV_FORMAT).csv(files).select(*schema.fieldNames()) for files in alike.values()]
    return reduce(DataFrame.unionByName, groups)


def structured_lines(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, STRUCTURED_CSV).select(
        F.col("LineId").try_cast("bigint").alias("line_id"),
        F.col("Content").alias("raw_message"),
        F.col("EventId").alias("event_id"),
        F.col("EventTemplate").alias("event_template"),
    )


def event_templates(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, TEMPLATES_CSV).select(
        F.col("EventId").alias("event_id"),
        F.col("EventTemplate").alias("event_template"),
        F.col("Occurrences").try_cast("int").alias("occurrences"),
    )


def exported_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table written by ``sinks.tables.export_csv``; an empty field is NULL.

    A folder without part files is an error, not an empty table.
    """
    if not file_sizes(spark, path, "part-*").select("path").take(1):
        raise FileNotFoundError(f"no part files in {path}")
    return (
        spark.read.schema(schema)
        .options(**CSV_FORMAT, nullValue="", timestampNTZFormat="yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
        .csv(path)
    )
