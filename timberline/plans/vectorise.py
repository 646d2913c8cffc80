"""Vectors for distinct messages, incrementally."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.operators.encoders import Encoder
from timberline.operators.cells import CellModel, fit_cells, with_cell
from timberline.operators.rollups import by_frequency, counted_messages, distinct_messages, messages_without_vector
from timberline.operators.upsert import newest_per_key, upsert
from timberline.plans import summaries
from timberline.plans.load import ContractViolation, require, vector_contract_report
from timberline.session import released_folders, settled
from timberline.sinks.changes import Change
from timberline.sources.tables import INDEX, INDEX_MODEL, INDEX_ROWS, VECTORS, Tables

VECTOR_COLUMNS = (
    "normalized_message",
    "representative_event_id",
    "representative_level",
    "occurrences",
    "embedding",
    "updated_at",
)
# Buckets of the vector table: as many as its first rows fill, within these bounds.
LEAST_BUCKETS, MOST_BUCKETS, ROWS_PER_BUCKET = 4, 1024, 10_000


@dataclass(frozen=True)
class Vectorised:
    distinct_texts: int
    covered_logs: int


def new_vectors(
    logs: DataFrame, vectors: DataFrame, encoder: Encoder, limit: int | None = None
) -> DataFrame:
    """Vector rows for messages that have none yet, the most frequent ones first under a limit.

    Lines are rolled up before anything else happens, so the join and the encoder only ever see
    distinct messages.
    """
    return vectors_for(distinct_messages(logs), vectors, encoder, limit)


def vectors_for(
    messages: DataFrame, vectors: DataFrame, encoder: Encoder, limit: int | None = None
) -> DataFrame:
    """``new_vectors`` for distinct messages that have been rolled up before."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be at least 1")
    missing = messages_without_vector(messages, vectors)
    if limit is not None:
        missing = missing.orderBy(*by_frequency()).limit(limit)
    stamped = missing.withColumn("updated_at", F.current_timestamp().cast("timestamp_ntz"))
    return encoder.encode(stamped, "normalized_message").select(*VECTOR_COLUMNS)


def encoding_totals(rows: DataFrame) -> DataFrame:
    """Messages encoded and log lines they cover."""
    return rows.agg(
        F.count(F.lit(1)).alias("distinct_texts"),
        F.coalesce(F.sum("occurrences"), F.lit(0)).alias("covered_logs"),
    )


def refreshed_counts(logs: DataFrame, vectors: DataFrame) -> DataFrame:
    """The vector table with the current number of lines per message."""
    current = distinct_messages(logs).select("normalized_message", F.col("occurrences").alias("_now"))
    return (
        vectors.join(current, "normalized_message", "left")
        .withColumn("occurrences", F.coalesce("_now", F.lit(0)))
        .select(*VECTOR_COLUMNS)
    )


def merged_vectors(vectors: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert new messages and replace stored ones; the newest change of a message wins."""
    return upsert(vectors, changes, "normalized_message", "updated_at")


def stored_dimension(vectors: DataFrame) -> int | None:
    """The length of the stored vectors, None for an empty table."""
    row = vectors.select(F.size("embedding").alias("size")).take(1)
    return row[0]["size"] if row else None


def in_buckets(vectors: DataFrame, buckets: int) -> DataFrame:
    """Adds ``bucket``, by which vectors are replaced together."""
    bucket = F.pmod(F.xxhash64("normalized_message"), F.lit(buckets)).cast("int")
    return vectors.withColumn("bucket", bucket).hint("rebalance", "bucket")


def _index_rows(vectors: DataFrame, model: CellModel) -> DataFrame:
    """Vectors as the index stores them; a model without cells takes none."""
    rows = vectors.select("normalized_message", "embedding")
    if not len(model.centres):
        return vectors.sparkSession.createDataFrame([], INDEX_ROWS)
    placed = with_cell(rows, model).select(*INDEX_ROWS.names)
    return placed.hint("rebalance", "folder").sortWithinPartitions("folder", "cell")


def vectorise(tables: Tables, encoder: Encoder, limit: int | None = None) -> Vectorised:
    """Encode what is missing and add it to the stored vector table, and to its index if there is one.

    Both change in one step. Vectors of another length than the stored ones are refused before
    anything is written.
    """
    stored = stored_dimension(tables.vectors())
    if stored is not None and stored != encoder.dimension:
        raise ContractViolation(f"stored vectors have {stored} elements, the encoder gives {encoder.dimension}")
    with released_folders(tables.spark), Change(tables) as change:
        known = counted_messages(summaries.messages(tables))
        rows = settled(vectors_for(known, tables.vectors(), encoder, limit), "new-vectors")
        require(vector_contract_report(rows, encoder.dimension))
        totals = encoding_totals(rows).first()
        change.buckets = change.buckets or bucket_count(totals.distinct_texts)
        change.add(VECTORS, in_buckets(rows, change.buckets), "bucket")
        if tables.has_index():
            change.add(INDEX, _index_rows(rows, index_model(tables)), "folder")
        change.publish()
    return Vectorised(totals.distinct_texts, totals.covered_logs)


def bucket_count(rows: int) -> int:
    """Buckets of the vector table, by the rows it begins with."""
    return max(LEAST_BUCKETS, min(MOST_BUCKETS, rows // ROWS_PER_BUCKET))


def index_vectors(tables: Tables, model: CellModel | None = None) -> CellModel:
    """Index the stored vectors in cells fitted on them, or in given ones; replaces an index in one step."""
    model = fit_cells(tables.vectors()) if model is None else model
    with Change(tables) as change:
        change.clear(INDEX, INDEX_MODEL)
        change.add(INDEX_MODEL, model.table(tables.spark).coalesce(1))
        change.add(INDEX, _index_rows(tables.vectors(), model), "folder")
        change.publish()
    return model


def index_model(tables: Tables) -> CellModel:
    return CellModel.of(tables.read(INDEX_MODEL))


def stored_index(tables: Tables) -> tuple[DataFrame, CellModel]:
    """The rows of the stored index and the model they were placed by, for ``search.CellIndex``."""
    return tables.read(INDEX), index_model(tables)


def refresh_vectors(tables: Tables, changes: DataFrame, encoder: Encoder) -> int:
    """Store changed vectors: insert new messages, replace stored ones, count lines anew; returns rows.

    ``changes`` has the columns of the vector table; the newest row of a message counts. Only buckets
    with a changed message or number of lines are written anew, and only those folders of the index
    that lose or get a vector; log and template files are not touched. What is written passes the vector
    contract first, and readers see all of it in one step.
    """
    spark = tables.spark
    with released_folders(spark), Change(tables) as change:
        change.buckets = change.buckets or bucket_count(0)
        newest = settled(newest_per_key(changes, "normalized_message", "updated_at"), "changes")
        counts = settled(
            counted_messages(summaries.messages(tables)).select("normalized_message", "occurrences"), "counts"
        )
        now = counts.withColumnRenamed("occurrences", "_now")
        recounted = (
            tables.vectors()
            .select("normalized_message", "occurrences")
            .join(now, "normalized_message", "left")
            .where(F.col("occurrences") != F.coalesce("_now", F.lit(0)))
        )
        touched = [table.select("normalized_message") for table in (newest, recounted)]
        buckets = _numbers(in_buckets(touched[0].unionByName(touched[1]), change.buckets), "bucket")
        before = tables.read(VECTORS, buckets)
        merged = (
            merged_vectors(before, newest)
            .join(now, "normalized_message", "left")
            .withColumn("occurrences", F.coalesce("_now", F.lit(0)))
            .select(*VECTOR_COLUMNS)
        )
        merged = settled(merged, "merged-vectors")
        require(vector_contract_report(merged, encoder.dimension))
        change.replace(VECTORS, buckets, in_buckets(merged, change.buckets), "bucket")
        if tables.has_index():
            model = index_model(tables)
            gone = before.join(newest.select("normalized_message"), "normalized_message", "left_semi")
            moved = [_index_rows(table, model) for table in (gone, newest)]
            folders = _numbers(moved[0].unionByName(moved[1]), "folder")
            kept = tables.read(INDEX, folders).join(newest.select("normalized_message"), "normalized_message", "left_anti")
            rows = kept.unionByName(moved[1]).hint("rebalance", "folder").sortWithinPartitions("folder", "cell")
            change.replace(INDEX, folders, rows, "folder")
        change.publish()
    return tables.vectors().count()


def _numbers(rows: DataFrame, column: str) -> list[int]:
    """The distinct buckets or folders of rows: no more than there are of them in all."""
    return sorted(row[0] for row in rows.select(column).distinct().collect())
