"""Near-duplicate vectors by a tiled comparison over principal components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.llm.components import components
from timberline.llm.tables import settled


@dataclass(frozen=True)
class Tiling:
    """Tiles of ``tile_rows`` vectors meet in a grid of cells; ``leading`` components come first."""

    threshold: float = 0.9
    tile_rows: int = 1024
    leading: int = 16
    cell_tiles: int = 4
    doubt: float = 1e-9


def _unit_rows(column: pa.Array) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rows that hold a vector with a direction, and these vectors in double precision."""
    rows, vectors = [], []
    for at, value in enumerate(column.to_pylist()):
        if value is None or None in value:
            continue
        vector = np.array(value, np.float64)
        if vector.size and np.isfinite(vector).all() and vector.any():
            rows.append(at)
            vectors.append(vector)
    return np.array(rows, np.int64), vectors


def _moments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of outer products of unit vectors, for each length of vector that occurs."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        _, vectors = _unit_rows(batch.column("vector"))
        by_size: dict[int, list[np.ndarray]] = {}
        for vector in vectors:
            by_size.setdefault(len(vector), []).append(vector)
        for size, some in by_size.items():
            block = np.stack(some)
            block /= np.abs(block).max(axis=1, keepdims=True)
            block /= np.linalg.norm(block, axis=1, keepdims=True)
            sums[size] = sums.get(size, 0) + block.T @ block
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([value.ravel() for value in sums.values()], pa.list_(pa.float64())),
        ],
        names=["size", "sums"],
    )


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, an orthonormal basis ordered by falling variance; from all vectors.

    The sums of products add up in the executors; one matrix per length comes to the driver, whose
    size depends on the length alone.
    """
    rows = (
        vectors.select("vector")
        .mapInArrow(_moments, "size int, sums array<double>")
        .select("size", F.posexplode("sums").alias("at", "value"))
        .groupBy("size", "at")
        .agg(F.sum("value").alias("value"))
        .groupBy("size")
        .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("cells"))
        .collect()
    )
    bases = {}
    for row in rows:
        matrix = np.array([cell["value"] for cell in row["cells"]]).reshape(row["size"], row["size"])
        bases[row["size"]] = np.linalg.eigh((matrix + matrix.T) / 2)[1][:, ::-1].copy()
    return bases


def _rotator(bases: dict[int, np.ndarray]):
    """(class, copies, size, unit vector along the axes)."""

    def rotate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, vectors = _unit_rows(batch.column("vector"))
            if not len(rows):
                continue
            turned, sizes = [], []
            for vector in vectors:
                scaled = vector / np.abs(vector).max()
                turned.append(((scaled / np.linalg.norm(scaled)) @ bases[len(vector)]).astype("<f8").tobytes())
                sizes.append(len(vector))
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [taken.column("class"), taken.column("copies"), pa.array(sizes, pa.int32()), pa.array(turned, pa.binary())],
                names=["class", "copies", "size", "turned"],
            )

    return rotate


def _joined(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Labels after the ends of all links got one label, the least of what they are connected to."""
    while True:
        left, right = label[x], label[y]
        if (left == right).all():
            return label
        least = np.minimum(left, right)
        np.minimum.at(label, left, least)
        np.minimum.at(label, right, least)
        while (label[label] != label).any():
            label = label[label]


def _compare(rule: Tiling):
    """Counts of links for one cell of the grid, and with whom a vector is connected in it.

    Pairs too close to the threshold for the turned vectors to tell come out as they are, with -1 links.
    """

    def compare(cell: pd.DataFrame) -> pd.DataFrame:
        cell = cell.sort_values(["side", "tile", "class"], kind="stable")
        size = int(cell["size"].iloc[0])
        points = np.frombuffer(b"".join(cell["turned"]), "<f8").reshape(-1, size)
        names, copies = cell["class"].to_numpy(), cell["copies"].to_numpy()
        side, tile = cell["side"].to_numpy(), cell["tile"].to_numpy()
        leading = min(rule.leading, size)
        head, tail = points[:, :leading], points[:, leading:]
        rest = np.sqrt((tail**2).sum(axis=1))
        links = np.zeros(len(points), np.int64)
        label = np.arange(len(points))
        edges = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (side[1:] != side[:-1]), [True]]))
        tiles = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        one_side = side.min() == side.max()
        doubtful = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for p, (a, b) in enumerate(tiles):
            for q, (c, d) in enumerate(tiles):
                if (q < p) if one_side else (side[a] != side.min() or side[c] == side.min()):
                    continue
                dots = head[a:b] @ head[c:d].T
                # what the other components can still add is at most the product of their norms
                x, y = np.nonzero(dots + rest[a:b, None] * rest[None, c:d] >= rule.threshold - rule.doubt)
                if p == q and one_side:
                    x, y = x[x < y], y[x < y]
                if not len(x):
                    continue
                if len(x) * 8 > dots.size:
                    cosine = (dots + tail[a:b] @ tail[c:d].T)[x, y]
                else:
                    cosine = dots[x, y] + np.concatenate(
                        [
                            np.einsum("ij,ij->i", tail[a + x[k : k + 65536]], tail[c + y[k : k + 65536]])
                            for k in range(0, len(x), 65536)
                        ]
                    )
                near = np.abs(cosine - rule.threshold) <= rule.doubt
                linked = (cosine >= rule.threshold) & ~near
                doubtful.append((x[near] + a, y[near] + c))
                x, y = x[linked] + a, y[linked] + c
                links += np.bincount(x, copies[y], len(points)).astype(np.int64)
                links += np.bincount(y, copies[x], len(points)).astype(np.int64)
                label = _joined(label, x, y)
        bound = np.flatnonzero(label != np.arange(len(points)))
        some = np.flatnonzero(links)
        one, other = (np.concatenate(ends) for ends in zip(*doubtful, strict=True))
        return pd.DataFrame(
            {
                "a": [*names[some], *names[bound], *names[one]],
                "b": [*[None] * len(some), *names[label[bound]], *names[other]],
                "links": np.concatenate([links[some], np.zeros(len(bound), np.int64), np.full(len(one), -1)]),
            }
        )

    return compare


def _decided(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose vectors as given reach the threshold in double precision, with their copies."""

    def end(name: str) -> DataFrame:
        numbers = F.col("vector").cast("array<double>")
        # A power of two scales without rounding and keeps the products from running over.
        scale = F.pow(F.lit(2.0), F.floor(F.log2(F.array_max(F.transform(numbers, F.abs)))))
        numbers = F.transform(numbers, lambda x: x / scale).alias(f"{name}_vector")
        return classes.select(F.col("class").alias(name), F.col("copies").alias(f"{name}_copies"), numbers)

    def dot(left: str, right: str) -> Column:
        products = F.zip_with(left, right, lambda x, y: x * y)
        return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)

    lengths = F.sqrt(dot("a_vector", "a_vector")) * F.sqrt(dot("b_vector", "b_vector"))
    both = pairs.select("a", "b").join(end("a"), "a").join(end("b"), "b")
    return both.where(dot("a_vector", "b_vector") / lengths >= threshold).select(
        "a", "b", F.lit(0).cast("long").alias("links"), "a_copies", "b_copies"
    )


def linked_vectors(
    vectors: DataFrame, identifier: str = "vec_id", embedding: str = "embedding", rule: Tiling = Tiling()
) -> DataFrame:
    """One row per row of ``vectors``: identifier, n_links, component_id, kept.

    Vectors link when their cosine in double precision is at least ``threshold``. Equal vectors form a
    class that is compared once, with its copies counted. All vectors are turned onto the principal
    axes of the whole table, ordered along the first, and cut into tiles; tiles are dealt into groups,
    and each pair of groups is a task that compares their tiles. The leading components are multiplied
    first, and a pair goes on only if they and the product of the norms of the rest can reach the
    threshold. A task returns counts and one connection per vector, never the links; only pairs within
    rounding of the threshold come back by themselves and are decided on the vectors as given.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing; neither
    do vectors of different lengths. A vector without links is its own component. Rows that share an
    identifier are different vectors; null identifiers count as larger than all others. An empty table
    gives an empty one. Other columns are ignored, whatever their names.
    """
    spark = vectors.sparkSession
    base = vectors.select(F.col(identifier).alias("_id"), F.col(embedding).alias("vector"))
    base = base.withColumn("class", F.concat(F.unhex(F.sha2(F.col("vector").cast("string").cast("binary"), 256))))
    classes = settled(
        base.where("vector is not null")
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("_id").alias("least_id"), F.first("vector").alias("vector")),
        "vector-classes",
    )
    bases = spark.sparkContext.broadcast(principal_axes(classes))  # one square matrix per length

    def rotate(batches):
        return _rotator(bases.value)(batches)

    turned = settled(
        classes.select("class", "copies", "vector").mapInArrow(
            rotate, "class binary, copies bigint, size int, turned binary"
        ),
        "vector-turned",
    )
    count = turned.count()
    tiles = max(1, -(-count // rule.tile_rows))
    groups = max(1, -(-tiles // rule.cell_tiles))
    parts = max(groups * rule.cell_tiles, 1)

    def first_component(batches):
        for batch in batches:
            lead = [np.frombuffer(value, "<f8", 1)[0] for value in batch.column("turned").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lead, pa.float64())], names=[*batch.schema.names, "lead"])

    led = turned.mapInArrow(first_component, "class binary, copies bigint, size int, turned binary, lead double")
    bounds = led.approxQuantile("lead", [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 and count else []
    cuts = spark.sparkContext.broadcast(np.array(bounds))

    def tiled(batches):
        for batch in batches:
            tile = np.searchsorted(cuts.value, batch.column("lead").to_numpy(), "right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(name) for name in ("class", "copies", "size", "turned")], pa.array(tile)],
                names=["class", "copies", "size", "turned", "tile"],
            )

    placed = led.mapInArrow(tiled, "class binary, copies bigint, size int, turned binary, tile int").withColumn(
        "group", F.floor(F.col("tile") / rule.cell_tiles).cast("int")
    )
    others = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("other")
    dealt = placed.select("*", others).select(
        "class", "copies", "size", "turned", "tile",
        F.col("group").alias("side"),
        F.least("group", "other").alias("i"),
        F.greatest("group", "other").alias("j"),
    )
    found = settled(
        dealt.groupBy("size", "i", "j").applyInPandas(_compare(rule), "a binary, b binary, links bigint"), "vector-links"
    )
    decided = settled(_decided(found.where("links < 0"), classes, rule.threshold), "vector-decided")
    joined = components(found.where("b is not null and links = 0").select("a", "b").union(decided.select("a", "b")))
    ends = [
        F.struct(F.col(one).alias("a"), F.col(f"{other}_copies").alias("links")) for one, other in (("a", "b"), ("b", "a"))
    ]
    more = decided.select(F.inline(F.array(*ends)))
    counts = (
        found.where("b is null").select("a", "links").union(more)
        .groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    )
    rooted = (
        classes.join(turned.select(F.col("class"), F.lit(True).alias("valid")), "class", "left")
        .join(counts, "class", "left")
        .join(joined.select(F.col("node").alias("class"), "root"), "class", "left")
        .select("class", "copies", "least_id", "valid", "links", F.coalesce("root", "class").alias("root"))
    )
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component"))
    by_class = rooted.join(least, "root").select("class", "copies", "valid", "links", "component")
    valid = F.coalesce(F.col("valid"), F.lit(False))
    component = F.when(valid, F.col("component")).otherwise(F.col("_id"))
    return base.select("_id", "class").join(by_class, "class", "left").select(
        F.col("_id").alias(identifier),
        F.when(valid, F.col("copies") - 1 + F.coalesce(F.col("links"), F.lit(0))).otherwise(0).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.when(~valid | component.isNull(), True).otherwise(F.coalesce(F.col("_id") == component, F.lit(False))).alias("kept"),
    )
