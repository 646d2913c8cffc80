"""Stored tables: Parquet folders under a common root, listed in manifests."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.session import names_in, read_small_text
from timberline.schemas import EVENT_TEMPLATES, HOUR_SUMMARIES, LOG_ENTRIES, MESSAGE_SUMMARIES, MESSAGE_VECTORS, RUNS

LOGS, TEMPLATES, VECTORS, RUN_LOG = "log_entries", "event_templates", "message_embeddings", "pipeline_runs"
INDEX, INDEX_MODEL = "message_index", "message_index_model"
MESSAGES, HOURS = "message_summaries", "hour_summaries"
INDEX_ROWS = T.StructType(
    [
        T.StructField("normalized_message", T.StringType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("cell", T.IntegerType()),
        T.StructField("folder", T.IntegerType()),
    ]
)
CELL_MODEL = T.StructType(
    [
        T.StructField("cell", T.IntegerType()),
        T.StructField("folder", T.IntegerType()),
        T.StructField("centre", T.ArrayType(T.FloatType())),
        T.StructField("probes", T.IntegerType()),
    ]
)
SCHEMAS = {
    LOGS: LOG_ENTRIES,
    TEMPLATES: EVENT_TEMPLATES,
    VECTORS: MESSAGE_VECTORS,
    RUN_LOG: RUNS,
    INDEX: INDEX_ROWS,
    INDEX_MODEL: CELL_MODEL,
    MESSAGES: MESSAGE_SUMMARIES,
    HOURS: HOUR_SUMMARIES,
}
MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Manifest:
    """Which folders make up the tables: per table and key the folders, relative to the table's own.

    A key names the rows that are replaced together: a bucket of messages in the vector table, a folder
    of cells in the index. Tables that are only added to, or replaced whole, have one empty key.
    ``buckets`` is the number of buckets of the vector table.
    """

    number: int = 0
    tables: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    buckets: int = 0

    @classmethod
    def of(cls, text: str) -> Manifest:
        return cls(**json.loads(text))

    def text(self) -> str:
        return json.dumps({"number": self.number, "tables": self.tables, "buckets": self.buckets})

    def folders(self) -> set[tuple[str, str]]:
        """All folders in use, as table and folder."""
        return {
            (name, folder) for name, keys in self.tables.items() for folders in keys.values() for folder in folders
        }


@dataclass(frozen=True)
class Tables:
    """Names the folders of the stored tables and reads them with their fixed schema.

    A manifest lists the folders that make up the tables, and readers follow the newest one. It is
    written in one step after all folders it names, so that whatever changes several tables is seen
    whole or not at all (``sinks.changes``). Without a manifest a table is the folder of its name.
    """

    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def manifest_path(self, number: int) -> str:
        return f"{self.path(MANIFESTS)}/{number:012d}.json"

    def manifest_numbers(self) -> list[int]:
        names = names_in(self.spark, self.path(MANIFESTS))
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and not name.startswith("."))

    def manifest(self) -> Manifest | None:
        """The newest manifest; None before the first change."""
        numbers = self.manifest_numbers()
        return Manifest.of(read_small_text(self.spark, self.manifest_path(numbers[-1]))) if numbers else None

    def folders(self, name: str, keys: Iterable[str] | None = None) -> list[str]:
        """The folders of a table, or of some of its keys."""
        manifest = self.manifest()
        if manifest is None or name == RUN_LOG:
            return [self.path(name)] if names_in(self.spark, self.path(name)) else []
        stored = manifest.tables.get(name, {})
        chosen = stored if keys is None else [key for key in dict.fromkeys(map(str, keys)) if key in stored]
        return [f"{self.path(name)}/{folder}" for key in chosen for folder in stored[key]]

    def read(self, name: str, keys: Iterable[str] | None = None) -> DataFrame:
        """A table, or the rows of some of its keys."""
        return self.read_folders(name, self.folders(name, keys))

    def read_folders(self, name: str, folders: list[str]) -> DataFrame:
        """The rows of a table that lie in the given folders of it."""
        schema = SCHEMAS[name]
        if not folders:
            return self.spark.createDataFrame([], schema)
        table = self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders)
        return table.select(*schema.names)

    def logs(self) -> DataFrame:
        """The log table with its row id, which equals the line number."""
        return with_row_id(self.read(LOGS))

    def templates(self) -> DataFrame:
        return self.read(TEMPLATES)

    def vectors(self) -> DataFrame:
        return self.read(VECTORS)

    def runs(self) -> DataFrame:
        return self.read(RUN_LOG)

    def has_index(self) -> bool:
        return bool(self.folders(INDEX_MODEL))


def with_row_id(logs: DataFrame) -> DataFrame:
    return logs.withColumn("id", F.col("line_id"))


def file_sizes(spark: SparkSession, paths: str | list[str], names: str = "*.parquet") -> DataFrame:
    """One row per data file below the paths; lists files only, no content is read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", names)
        .load(paths)
        .select("path", F.col("length").alias("bytes"))
    )
