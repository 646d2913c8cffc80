"""Distinct messages, their vectors and nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.fixture import LogData, SEARCH_DIMENSION, cosine_sql, hashed_ctes
from checks.registry import over_documents, over_logs, query
from timberline.functions import similarity
from timberline.operators.cells import fit_cells, nearest_in_cells, read_cells, with_cell, write_cells
from timberline.operators.lsh import approximate_nearest, recall, with_signature, write_index
from timberline.operators.rollups import by_frequency, distinct_messages, messages_without_vector
from timberline.operators.vectors import nearest
from timberline.plans.vectorise import merged_vectors
from timberline.session import shared_folder


_DISTINCT_SQL = """SELECT normalized_message, min(event_id) AS representative_event_id,
  min(level) AS representative_level, count(*) AS occurrences FROM {table} GROUP BY normalized_message"""


@query(over_logs(_DISTINCT_SQL.format(table="logs")))
def distinct_log_messages(data: LogData) -> DataFrame:
    return distinct_messages(data.logs()).orderBy(*by_frequency())


@query(over_documents(_DISTINCT_SQL.format(table="document_logs")))
def distinct_document_messages(data: LogData) -> DataFrame:
    return distinct_messages(data.document_logs()).orderBy(*by_frequency())


@query(
    over_documents(
        """SELECT normalized_message, count(*) AS occurrences FROM document_logs
WHERE normalized_message NOT IN (SELECT normalized_message FROM document_vectors WHERE label <> 3) GROUP BY normalized_message"""
    )
)
def missing_vectors(data: LogData) -> DataFrame:
    """Those of label 3 have no vector yet."""
    missing = messages_without_vector(distinct_messages(data.document_logs()), data.vectors_without_label(3))
    return missing.select("normalized_message", "occurrences")


@query(
    """SELECT CAST(vec_id AS VARCHAR) AS normalized_message, 'L' || label AS representative_event_id,
  CASE WHEN label < 5 THEN 'new' ELSE 'old' END AS representative_level,
  CASE WHEN label < 5 THEN 2 ELSE 1 END AS occurrences,
  round(CASE WHEN label < 5 THEN -1 ELSE 1 END * CAST(embedding[1] AS DOUBLE), 6) AS first_number
FROM embeddings"""
)
def vector_upsert(data: LogData) -> DataFrame:
    """Vectors of low label arrive twice more; the later arrival replaces the stored row."""
    given = data.given("embeddings")

    def rows(table: DataFrame, level: str, occurrences: int, sign: int, day: int) -> DataFrame:
        return table.select(
            F.col("vec_id").cast("string").alias("normalized_message"),
            F.concat(F.lit("L"), F.col("label").cast("string")).alias("representative_event_id"),
            F.lit(level).alias("representative_level"),
            F.lit(occurrences).cast("bigint").alias("occurrences"),
            F.transform("embedding", lambda x: (x * sign).cast("float")).alias("embedding"),
            F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp_ntz").alias("updated_at"),
        )

    # Of the vectors with a high label only the stored row exists; the rest are partly new.
    stored = rows(given.where("label > 2"), "old", 1, 1, 1)
    changed = given.where("label < 5")
    changes = rows(changed, "early", 9, 1, 2).unionByName(rows(changed, "new", 2, -1, 3))
    return merged_vectors(stored, changes).select(
        "normalized_message",
        "representative_event_id",
        "representative_level",
        F.col("occurrences").cast("int").alias("occurrences"),
        F.round(F.col("embedding")[0].cast("double"), 6).alias("first_number"),
    )


HASHED_LOGS = hashed_ctes(
    "hashed",
    "(SELECT DISTINCT normalized_message FROM logs)",
    "normalized_message",
    "normalized_message",
    SEARCH_DIMENSION,
)


@query(
    over_logs(
        """SELECT normalized_message, CAST(cell - 1 AS INT) AS cell, round(CAST(embedding[cell] AS DOUBLE), 6) AS weight
FROM (SELECT *, unnest(range(1, 65)) AS cell FROM hashed) WHERE embedding[cell] <> 0""",
        HASHED_LOGS,
    )
)
def hash_encode(data: LogData) -> DataFrame:
    vectors = data.vectors().select("normalized_message", F.posexplode("embedding").alias("cell", "x"))
    return vectors.where("x <> 0").select(
        "normalized_message", "cell", F.round(F.col("x").cast("double"), 6).alias("weight")
    )


@query(
    over_documents(
        f"""SELECT e.vec_id, CAST(e.label AS BIGINT) AS label, round({cosine_sql('e.embedding', 'q.embedding')}, 6) AS similarity,
  round(1 - ({cosine_sql('e.embedding', 'q.embedding')}), 6) + 0.0e0 AS distance
FROM embeddings e JOIN label_vectors q ON q.query_id = e.label"""
    )
)
def cosine_to_label(data: LogData) -> DataFrame:
    """Similarity of every vector to the first vector of its label."""
    first = data.label_vectors().select(
        F.col("query_id").alias("label"), F.col("embedding").alias("first_embedding")
    )
    vectors = data.given("embeddings").withColumn("label", F.col("label").cast("bigint"))
    pair = (F.col("embedding"), F.col("first_embedding"))
    return vectors.join(first, "label").select(
        "vec_id",
        "label",
        F.round(similarity.cosine(*pair), 6).alias("similarity"),
        # Adding zero turns a negative zero into zero.
        (F.round(similarity.cosine_distance(*pair), 6) + F.lit(0.0)).alias("distance"),
    )


KNN_SQL = f"""SELECT query_id, item_id, CAST(rank AS BIGINT) AS rank, round(sim, 6) AS sim FROM (
  SELECT query_id, item_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, item_id) AS rank FROM (
    SELECT a.vec_id AS query_id, b.vec_id AS item_id, {cosine_sql('a.embedding', 'b.embedding')} AS sim
    FROM embeddings a, embeddings b))
WHERE rank <= 10"""


def all_neighbours(data: LogData, **options) -> DataFrame:
    vectors = data.given("embeddings").select("vec_id", "embedding")
    found = nearest(vectors.withColumnRenamed("vec_id", "query_id"), vectors, "vec_id", 10, **options)
    return found.select(
        "query_id", F.col("vec_id").alias("item_id"), "rank", F.round("similarity", 6).alias("sim")
    )


@query(KNN_SQL)
def knn_join(data: LogData) -> DataFrame:
    """The ten nearest vectors of every vector, queries shared with all tasks."""
    return all_neighbours(data)


@query(KNN_SQL)
def knn_join_blocks(data: LogData) -> DataFrame:
    """The same in blocks, the form for query tables that are too large to share."""
    return all_neighbours(data, max_shared=64)


@query(KNN_SQL)
def signature_index_full(data: LogData) -> DataFrame:
    """The approximate search with every signature probed is exact."""
    vectors = data.given("embeddings").select("vec_id", "embedding")
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    found = approximate_nearest(queries, with_signature(vectors, 4), "vec_id", 10, probes=16, count=4)
    return found.select(
        "query_id", F.col("vec_id").alias("item_id"), "rank", F.round("similarity", 6).alias("sim")
    )


@query()
def lsh_topk(data: LogData) -> DataFrame:
    """Per query the share of the exact ten nearest that the approximate search finds."""
    vectors = data.given("embeddings").select("vec_id", "embedding")
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    exact = nearest(queries, vectors, "vec_id", 10)
    folder = shared_folder(data.spark, "index")
    write_index(vectors, folder)
    found = approximate_nearest(queries, data.spark.read.parquet(folder), "vec_id", 10)
    return recall(exact, found, "vec_id")


@query(KNN_SQL)
def cell_index_full(data: LogData) -> DataFrame:
    """The search over trained cells with every cell probed is exact."""
    vectors = data.given("embeddings").select("vec_id", "embedding")
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    model = fit_cells(vectors, max_cells=16)
    found = nearest_in_cells(queries, with_cell(vectors, model), model, "vec_id", 10, probes=16)
    return found.select(
        "query_id", F.col("vec_id").alias("item_id"), "rank", F.round("similarity", 6).alias("sim")
    )


@query("SELECT count(*) AS queries, 10 * count(*) AS exact_results, TRUE AS recall_reached FROM embeddings")
def cell_search_recall(data: LogData) -> DataFrame:
    """The stored index by its default probes finds at least nine tenths of the exact ten nearest."""
    vectors = data.given("embeddings").select("vec_id", "embedding")
    queries = vectors.withColumnRenamed("vec_id", "query_id")
    folder = shared_folder(data.spark, "cells")
    write_cells(vectors, folder)
    found = nearest_in_cells(queries, *read_cells(data.spark, folder), "vec_id", 10)
    found_per_query = recall(nearest(queries, vectors, "vec_id", 10), found, "vec_id")
    return found_per_query.agg(
        F.count(F.lit(1)).alias("queries"),
        F.sum("exact_results").alias("exact_results"),
        (F.avg("recall") >= 0.9).alias("recall_reached"),
    )


@query(
    """SELECT vec_id, CAST(length(literal) AS INT) AS literal_length, CAST(len(embedding) AS INT) AS numbers, TRUE AS exact_to_ten_decimals
FROM (SELECT *, '[' || array_to_string(list_transform(embedding, lambda x: printf('%.10f', CAST(x AS DOUBLE))), ',') || ']' AS literal
  FROM embeddings)"""
)
def vector_literal_roundtrip(data: LogData) -> DataFrame:
    written = data.given("embeddings").withColumn("literal", similarity.vector_literal(F.col("embedding")))
    read = written.withColumn("back", similarity.parse_vector_literal(F.col("literal")))
    errors = F.zip_with("embedding", "back", lambda x, y: F.abs(x.cast("double") - y))
    return read.select(
        "vec_id",
        F.length("literal").alias("literal_length"),
        F.size("back").alias("numbers"),
        (F.array_max(errors) <= 5.1e-11).alias("exact_to_ten_decimals"),
    )
