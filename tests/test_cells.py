"""The index of trained cells: recall with its default probes, pruning, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from timberline.operators.cells import (
    APPEND,
    fit_cells,
    nearest_in_cells,
    probed_cells,
    read_cells,
    with_cell,
    write_cells,
)
from timberline.operators.lsh import recall
from timberline.operators.vectors import nearest
from timberline.plans import search
from tests.helpers import final_plan, logs_of


def table(spark, rows):
    return spark.createDataFrame(
        [(at, None if row is None else [float(x) for x in row]) for at, row in enumerate(rows)],
        "vec_id bigint, embedding array<float>",
    )


def clustered(spark, rows=3000, clusters=30):
    generator = np.random.default_rng(3)
    centres = generator.standard_normal((clusters, 64)) / 8
    return table(spark, centres[generator.integers(0, clusters, rows)] + 0.12 * generator.standard_normal((rows, 64)))


def measured(spark, vectors, path):
    """Mean recall of the ten nearest, and the share of rows in the probed cells."""
    write_cells(vectors, path)
    index, model = read_cells(spark, path)
    queries = vectors.where("vec_id % 10 = 0").withColumnRenamed("vec_id", "query_id")
    found = nearest_in_cells(queries, index, model, "vec_id", 10)
    mean = recall(nearest(queries, vectors, "vec_id", 10), found, "vec_id").agg(F.avg("recall")).first()[0]
    probed = probed_cells(queries, model).select(F.explode("probe").alias("cell"))
    read = probed.join(index.groupBy("cell").count(), "cell").agg(F.sum("count")).first()[0]
    return mean, read / (queries.count() * vectors.count())


def test_default_probes_on_given_vectors(spark, tmp_path):
    """These have no structure at all, the worst case; still less than 30 % is read."""
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    mean, read = measured(spark, vectors, str(tmp_path / "index"))
    assert mean >= 0.9 and read < 0.3


def test_default_probes_on_clusters(spark, tmp_path):
    mean, read = measured(spark, clustered(spark), str(tmp_path / "index"))
    assert mean >= 0.9 and read < 0.1


def test_all_probes_are_exact_and_few_read_few_folders(spark, tmp_path):
    vectors = clustered(spark, 1200)
    write_cells(vectors, str(tmp_path / "index"))
    index, model = read_cells(spark, str(tmp_path / "index"))
    queries = vectors.where("vec_id < 5").withColumnRenamed("vec_id", "query_id")
    full = nearest_in_cells(queries, index, model, "vec_id", 7, probes=10_000)
    exact = nearest(queries, vectors, "vec_id", 7)
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, exact.collect()))
    plan = final_plan(nearest_in_cells(queries.limit(1), index, model, "vec_id", 7, probes=1))
    assert "PartitionFilters: [isnotnull(folder" in plan and "PushedFilters: [IsNotNull(cell)" in plan


def test_rows_are_added_to_the_stored_cells(spark, tmp_path):
    vectors = clustered(spark, 400)
    path = str(tmp_path / "index")
    write_cells(vectors.where("vec_id < 300"), path)
    write_cells(vectors.where("vec_id >= 300"), path, mode=APPEND)
    index, model = read_cells(spark, path)
    assert index.count() == 400 and index.select("vec_id").distinct().count() == 400
    placed = with_cell(vectors, model)
    assert placed.join(index, ["vec_id", "cell", "folder"]).count() == 400


def test_sample_is_bounded_and_repeats(spark):
    """Copies count once in the sample, and how a table is split does not change the centres."""
    vectors = clustered(spark, 600).unionAll(clustered(spark, 600).where("vec_id = 1").crossJoin(spark.range(500)).drop("id"))
    one, other = (fit_cells(vectors.repartition(parts), max_cells=8, sample_rows=100) for parts in (1, 5))
    assert np.array_equal(one.centres, other.centres) and one.probes == other.probes
    assert len(one.centres) == 8


@pytest.mark.parametrize("rows", [[], [None, None]])
def test_nothing_to_index(spark, tmp_path, rows):
    path = str(tmp_path / "index")
    write_cells(table(spark, rows), path)
    index, model = read_cells(spark, path)
    assert index.count() == 0 and len(model.centres) == 0


def test_null_zero_and_equal_vectors(spark, tmp_path):
    vectors = table(spark, [None, [0, 0], [1, 0], [1, 0], [0, 1], [-1, 0]])
    path = str(tmp_path / "index")
    write_cells(vectors, path)
    index, model = read_cells(spark, path)
    queries = vectors.where("vec_id IN (0, 1, 2)").withColumnRenamed("vec_id", "query_id")
    found = nearest_in_cells(queries, index, model, "vec_id", 2, probes=99)
    assert sorted((r.query_id, r.vec_id, r.rank) for r in found.collect()) == [(1, 1, 1), (1, 2, 2), (2, 2, 1), (2, 3, 2)]


def test_other_length_is_refused(spark):
    model = fit_cells(table(spark, [[1, 0], [0, 1]]))
    with pytest.raises(Exception, match="differ in length"):
        with_cell(table(spark, [[1, 0, 0]]), model).collect()


def test_search_through_cells_with_levels(spark, tmp_path):
    """All probes give what the exact search gives, levels included."""
    generator = np.random.default_rng(8)
    logs = logs_of(
        spark,
        [(k, k, ("INFO", "ERROR")[k % 2], "E", f"m{k % 40}") for k in range(1, 160)],
    )
    messages = [f"m{k}" for k in range(40)]
    vectors = spark.createDataFrame(
        [(m, generator.standard_normal(8).tolist()) for m in messages], "normalized_message string, embedding array<float>"
    )
    write_cells(vectors, str(tmp_path / "index"))
    index, model = read_cells(spark, str(tmp_path / "index"))
    asked = spark.createDataFrame(
        [(k, generator.standard_normal(8).tolist(), (None, "ERROR")[k % 2], 5) for k in range(6)],
        "query_id bigint, embedding array<float>, level string, top_k int",
    )
    through = search.vector_search(asked, logs, index, search.CellIndex(model, probes=999))
    exact = search.vector_search(asked, logs, vectors)
    assert sorted(map(tuple, through.collect())) == sorted(map(tuple, exact.collect()))
    assert exact.count() == 30
