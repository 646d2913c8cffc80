"""Approximate nearest neighbours: an index of trained cells.

Centres are fitted by k-means on a bounded sample; every row is stored with its nearest centre's cell.
Neighbouring cells share a folder, in which rows lie in order of cells, so that a search reads the
folders and row groups of the cells it probes. A query probes the cells whose centres are closest to it
and ranks their rows exactly: similarities are true, only members can be missed. How many cells are
probed by default is measured on the sample when the centres are fitted, so data that falls into
clusters is searched in few cells and data without any structure in many.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.operators.lsh import nearest_in_probed
from timberline.operators.vectors import Vectors
from timberline.sinks.tables import APPEND, OVERWRITE, write_parquet

# Rows of the training sample, cells at most, and rows per cell below which no more cells are made.
SAMPLE_ROWS, MAX_CELLS, ROWS_PER_CELL = 32_768, 1024, 4
CELLS_PER_FOLDER = 16
ROUNDS = 10
# The measured share of the sample's ten nearest that the default probes reach, and the queries for it.
TARGET_RECALL, MEASURED_NEIGHBOURS, MEASURED_QUERIES = 0.93, 10, 512
CELLS, MODEL = "cells", "model"


@dataclass(frozen=True)
class CellModel:
    """Centres as unit rows, the folder of each cell, and the default number of probes."""

    centres: np.ndarray
    folders: np.ndarray
    probes: int

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (cell, int(folder), centre.tolist(), self.probes)
            for cell, (folder, centre) in enumerate(zip(self.folders, self.centres, strict=True))
        ]
        return spark.createDataFrame(rows, "cell int, folder int, centre array<float>, probes int")

    @classmethod
    def of(cls, table: DataFrame) -> CellModel:
        """From one row per cell, of which there are at most ``MAX_CELLS``."""
        rows = sorted(table.collect(), key=lambda row: row.cell)
        return cls(
            np.array([row.centre for row in rows], np.float32),
            np.array([row.folder for row in rows], np.int32),
            rows[0].probes if rows else 0,
        )


def _unit(rows: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(lengths == 0, 1, lengths)


def _centres(rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from the first rows: the centres and each row's cell."""
    centres = rows[:count].copy()
    for _ in range(ROUNDS):
        cell = (rows @ centres.T).argmax(axis=1)
        order = np.argsort(cell, kind="stable")
        used, begin = np.unique(cell[order], return_index=True)
        centres[used] = _unit(np.add.reduceat(rows[order], begin, axis=0))
    return centres, (rows @ centres.T).argmax(axis=1)


def _measured_probes(rows: np.ndarray, cell: np.ndarray, centres: np.ndarray, target: float) -> int:
    """The number of cells in which a share of ``target`` of the rows' nearest other rows lies."""
    asked = np.unique(np.linspace(0, len(rows) - 1, min(len(rows), MEASURED_QUERIES)).astype(int))
    scores = rows[asked] @ rows.T
    scores[np.arange(len(asked)), asked] = -np.inf
    most = min(MEASURED_NEIGHBOURS, len(rows) - 1)
    if most < 1:
        return 1
    true = np.argpartition(-scores, most - 1, axis=1)[:, :most]
    place = np.empty((len(asked), len(centres)), np.int64)
    np.put_along_axis(place, np.argsort(-(rows[asked] @ centres.T), axis=1), np.arange(len(centres))[None, :], axis=1)
    needed = np.sort(np.take_along_axis(place, cell[true], axis=1), axis=None)
    return int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)]) + 1


def _trained(rows: np.ndarray, count: int, target: float) -> CellModel:
    rows = _unit(rows.astype(np.float32))
    count = max(1, min(count, len(rows)))
    centres, cell = _centres(rows, count)
    probes = _measured_probes(rows, cell, centres, target)
    folder = _centres(centres, -(-count // CELLS_PER_FOLDER))[1]
    order = np.argsort(folder, kind="stable")
    return CellModel(centres[order], folder[order].astype(np.int32), probes)


def fit_cells(
    vectors: DataFrame,
    max_cells: int = MAX_CELLS,
    sample_rows: int = SAMPLE_ROWS,
    target_recall: float = TARGET_RECALL,
) -> CellModel:
    """Centres fitted in one task on a sample of at most ``sample_rows`` distinct vectors.

    The sample is chosen by a hash of the vectors, so it does not depend on how the table is split.
    Rows without a vector are left out. A table without vectors gives a model without cells.
    """
    present = vectors.where(F.col("embedding").isNotNull()).select("embedding")
    rows = present.count()
    hashed = present.withColumn("_draw", F.xxhash64("embedding"))
    if rows > sample_rows:
        # Half as much again as is needed, so that what is sorted stays within bounds.
        parts = 1 << 40
        hashed = hashed.where(F.pmod("_draw", F.lit(parts)) < int(parts * min(1.0, 1.5 * sample_rows / rows)))
    sample = hashed.groupBy("_draw").agg(F.any_value("embedding").alias("embedding"))
    sample = sample.orderBy(F.xxhash64("_draw"), "_draw").limit(sample_rows).select("embedding")
    count = min(max_cells, max(1, rows // ROWS_PER_CELL))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if not held:
            return
        model = _trained(_matrix(pa.Table.from_batches(held)["embedding"].combine_chunks()), count, target_recall)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(model.centres), dtype=np.int32)),
                pa.array(model.folders),
                pa.array(list(model.centres), pa.list_(pa.float32())),
                pa.array(np.full(len(model.centres), model.probes, np.int32)),
            ],
            names=["cell", "folder", "centre", "probes"],
        )

    schema = "cell int, folder int, centre array<float>, probes int"
    return CellModel.of(sample.coalesce(1).mapInArrow(train, schema))


def _matrix(lists: pa.ListArray) -> np.ndarray:
    """The vectors as rows; they must be of one length."""
    return Vectors.of(pa.table({"embedding": lists, "name": pa.nulls(len(lists))}), "name").numbers


def _checked(matrix: np.ndarray, model: CellModel) -> np.ndarray:
    if not len(model.centres):
        raise ValueError("the index was fitted on a table without vectors")
    if matrix.shape[1] != model.centres.shape[1]:
        raise ValueError("vectors and centres differ in length")
    return matrix @ model.centres.T.astype(np.float64)


def with_cell(vectors: DataFrame, model: CellModel) -> DataFrame:
    """Adds ``cell`` and ``folder`` to the rows that have a vector."""
    schema = T.StructType(
        [*vectors.schema, T.StructField("cell", T.IntegerType()), T.StructField("folder", T.IntegerType())]
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = _checked(_matrix(batch.column("embedding")), model).argmax(axis=1).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell), pa.array(model.folders[cell])],
                    names=[*batch.schema.names, "cell", "folder"],
                )

    return vectors.where(F.col("embedding").isNotNull()).mapInArrow(place, schema)


def write_cells(
    vectors: DataFrame, path: str, model: CellModel | None = None, mode: str = OVERWRITE
) -> CellModel:
    """Writes an index, or adds to one; without a model it is fitted first, or read where it is added to."""
    spark = vectors.sparkSession
    if model is None:
        model = read_model(spark, path) if mode == APPEND else fit_cells(vectors)
    if mode == OVERWRITE:
        write_parquet(model.table(spark).coalesce(1), f"{path}/{MODEL}")
    if not len(model.centres):
        # No row has a vector; one empty file keeps the columns.
        none = vectors.where("false").withColumn("cell", F.lit(0))
        write_parquet(none.coalesce(1), f"{path}/{CELLS}/folder=0", mode)
        return model
    placed = with_cell(vectors, model).hint("rebalance", "folder").sortWithinPartitions("folder", "cell")
    write_parquet(placed, f"{path}/{CELLS}", mode, ("folder",))
    return model


def read_model(spark: SparkSession, path: str) -> CellModel:
    return CellModel.of(spark.read.parquet(f"{path}/{MODEL}"))


def read_cells(spark: SparkSession, path: str) -> tuple[DataFrame, CellModel]:
    """The rows of an index, and the model they were placed by."""
    return spark.read.parquet(f"{path}/{CELLS}"), read_model(spark, path)


def probed_cells(queries: DataFrame, model: CellModel, probes: int | None = None) -> DataFrame:
    """Adds ``probe``, the cells that a query looks into, nearest first."""
    schema = T.StructType([*queries.schema, T.StructField("probe", T.ArrayType(T.IntegerType()))])
    count = min(model.probes if probes is None else probes, len(model.centres))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = _checked(_matrix(batch.column("embedding")), model)
                found = np.argsort(-scores, axis=1, kind="stable")[:, :count].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(found), pa.list_(pa.int32()))],
                    names=[*batch.schema.names, "probe"],
                )

    return queries.where(F.col("embedding").isNotNull()).mapInArrow(choose, schema)


def nearest_in_cells(
    queries: DataFrame,
    index: DataFrame,
    model: CellModel,
    key: str,
    limit: int,
    probes: int | None = None,
) -> DataFrame:
    """As ``nearest``, over the probed cells only; all cells probed give the exact answer.

    ``probes`` replaces the measured default. The cells that any query probes are named in the scan, so
    folders and row groups without one are not read.
    """
    probed = probed_cells(queries, model, probes)
    # No more than MAX_CELLS numbers.
    wanted = sorted(row.cell for row in probed.select(F.explode("probe").alias("cell")).distinct().collect())
    folders = sorted(set(model.folders[wanted].tolist()))
    hit = index.where(F.col("folder").isin(folders) & F.col("cell").isin(wanted))
    return nearest_in_probed(probed, hit, "cell", key, limit)
