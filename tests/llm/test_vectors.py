"""Linked vectors against all pairs."""

import math

import numpy as np
import pytest

from timberline.llm.embedding_dedup import Tiling, _joined, linked_vectors

from tests.llm import brute


def expected(rows, threshold=0.9):
    units = {}
    for at, (_, value) in enumerate(rows):
        if value and all(x is not None and math.isfinite(x) for x in value) and any(value):
            vector = np.array(value, np.float32).astype(np.float64)
            units[at] = vector / np.abs(vector).max()
    links = []
    for a in units:
        for b in units:
            if a < b and len(units[a]) == len(units[b]):
                u, v = units[a], units[b]
                cosine = math.fsum(u * v) / math.sqrt(math.fsum(u * u)) / math.sqrt(math.fsum(v * v))
                if cosine >= threshold:
                    links.append((a, b))
    root = brute.roots(range(len(rows)), links)
    least = {}
    for at, (key, _) in enumerate(rows):
        if key is not None:
            least[root[at]] = min(key, least.get(root[at], key))
    count = [0] * len(rows)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return sorted(
        (key if key is not None else -1, count[at], (least.get(root[at]) if at in units else key) if key is not None or at in units else None)
        for at, (key, _) in enumerate(rows)
    )


def found(table, rule):
    got = linked_vectors(table, rule=rule).collect()
    assert all(r.kept == (r.component_id is None or r.vec_id == r.component_id) for r in got)
    return sorted((r.vec_id if r.vec_id is not None else -1, r.n_links, r.component_id) for r in got)


SCHEMA = "vec_id bigint, embedding array<float>, label int, class string, links int"


@pytest.mark.parametrize("rule", [Tiling(), Tiling(tile_rows=16, cell_tiles=2, leading=3)])
def test_like_all_pairs(spark, rule):
    generator = np.random.default_rng(8)
    centres = generator.standard_normal((6, 12))
    rows = []
    for at in range(160):
        noise = 0.05 * generator.integers(0, 9)
        value = (centres[at % 6] + noise * generator.standard_normal(12)) * 10.0 ** generator.integers(-3, 4)
        rows.append((1000 - at, value.astype(np.float32).tolist()))
    rows += [(2000 + n, rows[5][1]) for n in range(40)]  # many equal vectors
    table = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA)
    assert found(table, rule) == expected(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (7, [1.0, 2.0]),
        (8, [2.0, 4.0]), (9, [1.0, 2.0, 0.0]), (None, [1.0, 2.0]), (11, [-1.0, -2.0]), (12, [1e-38, 2e-38]),
        (13, [1e38, 2e38]), (14, [9.0, 0.0]), (15, [9.0, 4.358898943540674]), (7, [1.0, 2.0]),
    ]
    table = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA)
    assert found(table, Tiling()) == expected(rows)
    assert linked_vectors(table.limit(0)).count() == 0


def test_labels_of_links_that_come_late():
    label = _joined(np.arange(8), np.array([6, 4]), np.array([7, 5]))
    label = _joined(label, np.array([7, 5]), np.array([2, 6]))
    assert label.tolist() == [0, 1, 2, 3, 2, 2, 2, 2]


def test_cosine_of_the_threshold_itself(spark):
    """9 * 10 / (10 * 10) is the threshold in double precision, whatever turning the vectors does to it."""
    generator = np.random.default_rng(4)
    rows, size = [(1000 + n, generator.standard_normal(40).tolist()) for n in range(200)], 40
    for pair in range(10):
        one, other = np.zeros(size), np.zeros(size)
        one[4 * pair : 4 * pair + 4], other[4 * pair] = (9, 3, 3, 1), 10
        rows += [(2 * pair, one.tolist()), (2 * pair + 1, other.tolist())]
    rows.append((500, rows[-1][1]))  # a copy of the last one
    table = spark.createDataFrame([(*row, 1, "x", 2) for row in rows], SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id) for r in linked_vectors(table).collect()}
    for pair in range(9):
        assert got[2 * pair] == got[2 * pair + 1] == (1, 2 * pair)
    assert (got[18], got[19], got[500]) == ((2, 18), (2, 18), (2, 18))
    assert all(got[1000 + n] == (0, 1000 + n) for n in range(200))
