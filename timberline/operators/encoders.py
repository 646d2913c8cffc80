"""Encoders: text column in, unit vector column out.

An encoder is anything with ``name``, ``dimension`` and ``encode(table, text, vector)``. The
hashing encoder needs no model files and is the tested default. ``ModelEncoder`` runs a sentence
model of the caller's choice inside the tasks; no such model is part of this library.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.fixed_values import ENCODE_BATCH, MODEL_ALIASES, VECTOR_DIMENSION

VECTOR_TYPE = T.ArrayType(T.FloatType())
_ARROW_VECTOR = pa.list_(pa.float32())
# Words, or rows if that is less, whose cells are summed at once (32 MB); a longer text is summed alone.
WORDS_AT_ONCE, ROWS_AT_ONCE = 500_000, 2048


class Encoder(Protocol):
    name: str
    dimension: int

    def encode(self, table: DataFrame, text: str, vector: str = "embedding") -> DataFrame: ...


def token_codes(text: Column) -> Column:
    """One 32-bit number per word of the whole text: the first 8 hex digits of its MD5."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))

    def code(word: Column) -> Column:
        return F.conv(F.substr(F.md5(word), F.lit(1), F.lit(8)), 16, 10).cast("bigint")

    return F.transform(words, code)


@dataclass(frozen=True)
class HashingEncoder:
    """Signed word counts hashed into ``dimension`` buckets, scaled to length 1.

    The first 7 hex digits of a word's MD5 choose the bucket and the parity of the 8th its sign. A
    text without words becomes the zero vector. Words are hashed in the JVM; only their numbers
    reach Python, where whole batches are summed at once.
    """

    dimension: int = VECTOR_DIMENSION
    name: str = "hashing"

    def encode(self, table: DataFrame, text: str, vector: str = "embedding") -> DataFrame:
        coded = table.withColumn(vector, token_codes(F.coalesce(F.col(text), F.lit(""))))
        schema = T.StructType(
            [T.StructField(vector, VECTOR_TYPE) if f.name == vector else f for f in coded.schema]
        )
        dimension = self.dimension

        def sum_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index(vector)
                yield _replace(batch, at, hashed_vectors(batch.column(at), dimension))

        return coded.mapInArrow(sum_words, schema)


def hashed_vectors(codes: pa.ListArray, dimension: int) -> np.ndarray:
    """Unit vectors of a batch of word-code lists, in steps of a bounded number of words."""
    words = np.cumsum(codes.value_lengths().to_numpy(zero_copy_only=False))
    result = np.empty((len(codes), dimension), dtype=np.float32)
    start = 0
    while start < len(codes):
        before = words[start - 1] if start else 0
        fits = int(np.searchsorted(words, before + WORDS_AT_ONCE, side="right"))
        stop = min(max(fits, start + 1), start + ROWS_AT_ONCE, len(codes))
        result[start:stop] = _summed_words(codes.slice(start, stop - start), dimension)
        start = stop
    return result


def _summed_words(codes: pa.ListArray, dimension: int) -> np.ndarray:
    rows = len(codes)
    owner = np.repeat(np.arange(rows), codes.value_lengths().to_numpy(zero_copy_only=False))
    code = codes.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    cell = owner * dimension + (code >> 4) % dimension
    sign = 1 - 2 * (code & 1)
    totals = np.bincount(cell, weights=sign, minlength=rows * dimension).reshape(rows, dimension)
    return unit_rows(totals)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return (matrix / np.where(lengths == 0, 1.0, lengths)).astype(np.float32)


def _replace(batch: pa.RecordBatch, at: int, vectors: np.ndarray) -> pa.RecordBatch:
    offsets = np.arange(len(vectors) + 1, dtype=np.int32) * vectors.shape[1]
    columns = list(batch.columns)
    columns[at] = pa.ListArray.from_arrays(pa.array(offsets), pa.array(vectors.ravel()))
    names = batch.schema.names
    return pa.RecordBatch.from_arrays(columns, names=names)


@dataclass(frozen=True)
class ModelEncoder:
    """Runs a sentence model in the tasks: ``load`` is called once per task, on the executor.

    ``load`` returns a function from a list of texts to a matrix with one row per text. Messages are
    small and models slow, so ``tasks`` can spread the texts wider than their bytes would.
    """

    name: str
    dimension: int
    load: Callable[[], Callable[[list[str]], np.ndarray]]
    batch_size: int = ENCODE_BATCH
    tasks: int | None = None

    def encode(self, table: DataFrame, text: str, vector: str = "embedding") -> DataFrame:
        if self.tasks is not None:
            table = table.repartition(self.tasks)
        prepared = table.withColumn(vector, F.coalesce(F.col(text), F.lit("")))
        schema = T.StructType(
            [T.StructField(vector, VECTOR_TYPE) if f.name == vector else f for f in prepared.schema]
        )
        load, step, dimension = self.load, self.batch_size, self.dimension

        def run_model(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for whole in batches:
                for start in range(0, whole.num_rows, step):
                    batch = whole.slice(start, step)
                    at = batch.schema.get_field_index(vector)
                    matrix = np.asarray(model(batch.column(at).to_pylist()), dtype=np.float64)
                    if matrix.shape != (batch.num_rows, dimension):
                        raise ValueError(f"expected {dimension} numbers per text, got {matrix.shape}")
                    yield _replace(batch, at, unit_rows(matrix))

        return prepared.mapInArrow(run_model, schema)


def full_model_name(name: Column) -> Column:
    """Full name of a known short model name; any other name stays as it is."""
    pairs = [F.lit(text) for alias in MODEL_ALIASES for text in alias]
    return F.coalesce(F.create_map(*pairs)[name], name)
