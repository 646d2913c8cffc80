import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import final_plan
from timberline.functions.similarity import cosine, cosine_distance, parse_vector_literal, vector_literal
from timberline.operators import vectors as vectors_module
from timberline.operators.encoders import HashingEncoder, ModelEncoder, full_model_name
from timberline.operators.lsh import approximate_nearest, recall, with_signature, write_index
from timberline.operators.vectors import nearest


def brute_force(queries, items, limit):
    """Plain double arithmetic in element order; ties by name."""
    result = {}
    for query, left, scope in queries:
        scored = []
        for name, right, scopes in items:
            if right is None or (scope is not None and not set(scope) & set(scopes)):
                continue
            dot = sum(float(x) * float(y) for x, y in zip(left, right))
            lengths = float(np.sqrt(sum(float(x) ** 2 for x in left))) * float(
                np.sqrt(sum(float(x) ** 2 for x in right))
            )
            scored.append((-(dot / lengths) if lengths else -0.0, name))
        result[query] = [name for _, name in sorted(scored)[:limit]]
    return result


@pytest.fixture(scope="module")
def small(spark):
    random = np.random.Generator(np.random.PCG64(3))
    directions = random.standard_normal((40, 8)).astype(np.float32)
    # A third of all items share one vector, some are zero, some are missing.
    items = []
    for at in range(600):
        vector = directions[0] if at % 3 == 0 else directions[at % 40]
        vector = [0.0] * 8 if at % 50 == 1 else vector.tolist()
        items.append((f"m{at:03d}", None if at % 70 == 2 else vector, ["a", "b"] if at % 5 else ["c"]))
    queries = [
        (at, directions[at % 40].tolist() if at != 7 else [0.0] * 8, [None, ["a"], ["c"], ["x"], ["b", "c"]][at % 5])
        for at in range(30)
    ]
    item_table = spark.createDataFrame(items, "name string, embedding array<float>, scopes array<string>")
    query_table = spark.createDataFrame(queries, "query_id bigint, embedding array<float>, scope array<string>")
    return queries, items, query_table, item_table.repartition(5)


@pytest.mark.parametrize("shared", ["queries", "items", "neither"])
def test_nearest_equals_brute_force(small, shared, monkeypatch):
    queries, items, query_table, item_table = small
    if shared == "items":
        # More queries than items: every query is asked 30 times over.
        queries = [(q * 100 + copy, v, s) for q, v, s in queries for copy in range(30)]
        copies = F.explode(F.sequence(F.lit(0), F.lit(29))).alias("copy")
        query_table = query_table.select("*", copies).withColumn("query_id", F.expr("query_id * 100 + copy")).drop("copy")
    limit = {"queries": 1000, "items": 700, "neither": 3}[shared]
    monkeypatch.setattr(vectors_module, "QUERY_BLOCK", 8)
    monkeypatch.setattr(vectors_module, "ITEM_BLOCK", 100)
    found = {}
    found_table = nearest(query_table, item_table, "name", 9, max_shared=limit)
    assert ("Exchange" in final_plan(found_table).split("MapInArrow")[0]) == (shared != "items")
    rows = found_table.collect()
    for row in sorted(rows, key=lambda row: (row.query_id, row.rank)):
        assert -1 - 1e-9 <= row.similarity <= 1 + 1e-9
        found.setdefault(row.query_id, []).append(row.name)
    expected = {q: names for q, names in brute_force(queries, items, 9).items() if names}
    assert found == expected


def test_own_limits_and_unscoped(small):
    queries, items, query_table, item_table = small
    limited = query_table.drop("scope").withColumn("top_k", (F.col("query_id") % 4 + 1).cast("int"))
    counts = nearest(limited, item_table, "name", 4).groupBy("query_id").count().collect()
    assert {row.query_id: row["count"] for row in counts} == {at: at % 4 + 1 for at in range(30)}


def test_vectors_of_different_lengths_are_refused(spark):
    items = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], "name string, embedding array<float>").coalesce(1)
    queries = spark.createDataFrame([(1, [1.0, 0.0])], "query_id bigint, embedding array<float>")
    with pytest.raises(Exception, match="different lengths"):
        nearest(queries, items, "name", 2).collect()
    with pytest.raises(Exception, match="differ in length"):
        nearest(queries, items.where("name = 'b'"), "name", 2).collect()


def test_no_queries_or_items(small):
    _, _, query_table, item_table = small
    assert nearest(query_table.where("false"), item_table, "name", 3).count() == 0
    assert nearest(query_table, item_table.where("false"), "name", 3).count() == 0


def test_cosine_of_zero_vector_is_zero(spark):
    row = spark.range(1).select(
        cosine(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(0.0))).alias("zero"),
        cosine(F.array(F.lit(3.0), F.lit(4.0)), F.array(F.lit(3.0), F.lit(4.0))).alias("same"),
        cosine_distance(F.array(F.lit(1.0), F.lit(0.0)), F.array(F.lit(-1.0), F.lit(0.0))).alias("far"),
    ).first()
    assert (row.zero, row.same, row.far) == (0.0, 1.0, 2.0)


def test_vector_literal(spark):
    table = spark.createDataFrame([([0.0, 1.5, -2.0],)], "v array<float>")
    row = table.select(vector_literal(F.col("v")).alias("t")).withColumn("back", parse_vector_literal(F.col("t"))).first()
    assert row.t == "[0.0000000000,1.5000000000,-2.0000000000]"
    assert row.back == [0.0, 1.5, -2.0]


def test_hashing_encoder_reads_whole_texts(spark):
    long = "word " * 30_000
    table = spark.createDataFrame([("a b",), ("A  b!",), ("--",), (None,), (long,), (long + "tail",)], "text string")
    rows = [row.embedding for row in HashingEncoder(16).encode(table.coalesce(1), "text").collect()]
    assert rows[0] == rows[1]
    assert rows[2] == rows[3] == [0.0] * 16
    assert rows[4] != rows[5]
    for row in (rows[0], rows[4], rows[5]):
        assert abs(sum(x * x for x in row) - 1) < 1e-6


def test_model_encoder_runs_in_batches_and_scales_to_length_one(spark):
    def load():
        def model(texts):
            assert len(texts) <= 3
            return np.array([[len(text), 1.0] for text in texts])

        return model

    table = spark.createDataFrame([("x" * at, at) for at in range(10)], "text string, n int")
    rows = ModelEncoder("lengths", 2, load, batch_size=3).encode(table, "text").collect()
    assert len(rows) == 10
    for row in rows:
        expected = np.array([row.n, 1.0]) / np.hypot(row.n, 1.0)
        assert np.allclose(row.embedding, expected, atol=1e-6)
    spread = ModelEncoder("lengths", 2, load, batch_size=3, tasks=6).encode(table, "text")
    assert sorted(row.n for row in spread.collect()) == list(range(10))
    wrong = ModelEncoder("lengths", 3, load, batch_size=3)
    with pytest.raises(Exception, match="expected 3 numbers"):
        wrong.encode(table, "text").collect()


def test_model_names(spark):
    names = spark.createDataFrame([("all-MiniLM-L6-v2",), ("custom/model",)], "name string")
    assert [row[0] for row in names.select(full_model_name(F.col("name"))).collect()] == [
        "sentence-transformers/all-MiniLM-L6-v2", "custom/model",
    ]


def test_index_probes_prune_folders_and_all_probes_are_exact(spark, given, tmp_path):
    items = given("embeddings").select("vec_id", "embedding")
    queries = items.where("vec_id < 40").withColumnRenamed("vec_id", "query_id")
    exact = nearest(queries, items, "vec_id", 5)
    write_index(items, str(tmp_path / "index"), count=4)
    index = spark.read.parquet(str(tmp_path / "index"))
    full = approximate_nearest(queries, index, "vec_id", 5, probes=16, count=4)
    assert sorted(full.collect()) == sorted(exact.collect())
    part = approximate_nearest(queries, index, "vec_id", 5, probes=4, count=4)
    share = recall(exact, part, "vec_id").agg(F.avg("recall")).first()[0]
    assert 0.3 < share <= 1
    # What is found has its true similarity.
    known = {(row.query_id, row.vec_id): row.similarity for row in nearest(queries, items, "vec_id", 600).collect()}
    assert all(known[row.query_id, row.vec_id] == row.similarity for row in part.collect())
    assert with_signature(items, 4).select("signature").distinct().count() <= 16


def test_signatures_come_by_cost():
    import numpy as np

    from timberline.operators.lsh import nearest_signatures

    margins = np.random.default_rng(2).standard_normal(7)
    bits = (np.arange(128)[:, None] >> np.arange(7)) & 1
    cost = np.maximum(margins, 0) @ (1 - bits).T + np.maximum(-margins, 0) @ bits.T
    assert nearest_signatures(margins, 50) == np.argsort(cost)[:50].tolist()
    assert sorted(nearest_signatures(margins, 1000)) == list(range(128))
    assert len(nearest_signatures(np.random.default_rng(3).standard_normal(30), 40)) == 40


def test_no_more_than_a_query_asks_for_leaves_a_block(spark, monkeypatch):
    """One query wants many rows; the others must not pay for it."""
    monkeypatch.setattr(vectors_module, "QUERY_BLOCK", 25)
    monkeypatch.setattr(vectors_module, "ITEM_BLOCK", 150)
    random = np.random.Generator(np.random.PCG64(5))
    queries = [(at, row.tolist(), 200 if at == 9 else 2) for at, row in enumerate(random.standard_normal((50, 6)))]
    items = [(f"m{at:03d}", row.tolist()) for at, row in enumerate(random.standard_normal((600, 6)))]
    asked = spark.createDataFrame(queries, "query_id bigint, embedding array<float>, top_k int")
    stored = spark.createDataFrame(items, "name string, embedding array<float>")
    limited = asked.withColumnRenamed("top_k", "limit")
    left = vectors_module._meet_in_blocks(limited, stored, "name", 200, 600, 3600)
    blocks = -(-600 // 150)
    assert left.count() <= blocks * (2 * 49 + 200)
    found = nearest(asked, stored, "name", 200, max_shared=1).groupBy("query_id").count().collect()
    assert {row.query_id: row["count"] for row in found} == {at: own for at, _, own in queries}


def test_a_vector_is_sent_to_few_blocks():
    """By the sizes of 0.6 million vectors of 64 numbers: copies of a side are blocks of the other."""
    blocks = vectors_module._blocks(615_000, vectors_module.ITEM_BLOCK, 64)
    assert 2 * blocks * 615_000 * 64 * 4 < 5e9
    assert vectors_module._blocks(615_000, vectors_module.ITEM_BLOCK, 768) * vectors_module.BLOCK_NUMBERS >= 615_000 * 768


def test_best_are_found_where_most_scores_tie(spark, monkeypatch):
    """More items than contenders, most of them equal, and one far better at any place."""
    monkeypatch.setattr(vectors_module, "CONTENDERS", 16)
    rows = [[1.0, 1.0]] * 300
    rows[123], rows[299] = [1.0, 0.1], [1.0, 0.0]
    items = spark.createDataFrame([(at, row) for at, row in enumerate(rows)], "item bigint, embedding array<float>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.0], 5), (2, [1.0, 1.0], 1)], "query_id bigint, embedding array<float>, top_k int")
    found = nearest(asked, items, "item", 5).orderBy("query_id", "rank").collect()
    assert [row.item for row in found] == [299, 123, 0, 1, 2, 0]


def test_scopes_may_be_numbers(spark):
    items = spark.createDataFrame([(at, [1.0, float(at)], [at % 3]) for at in range(9)], "item bigint, embedding array<float>, scopes array<int>")
    asked = spark.createDataFrame([(1, [1.0, 0.0], [0]), (2, [1.0, 0.0], [1, 2]), (3, [1.0, 0.0], []), (4, [1.0, 0.0], None)], "query_id bigint, embedding array<float>, scope array<int>")
    found = nearest(asked, items, "item", 3).orderBy("query_id", "rank").collect()
    assert [(row.query_id, row.item) for row in found] == [(1, 0), (1, 3), (1, 6), (2, 1), (2, 2), (2, 4), (4, 0), (4, 1), (4, 2)]


def test_words_are_summed_in_steps(monkeypatch):
    import pyarrow as pa

    from timberline.operators import encoders

    random = np.random.Generator(np.random.PCG64(1))
    lists = [random.integers(0, 1 << 32, size).tolist() for size in (0, 3, 70, 1, 0, 12, 5, 200, 2)]
    codes = pa.array([[1]] + lists, pa.list_(pa.int64())).slice(1)
    whole, sizes, summed = encoders._summed_words(codes, 8), [], encoders._summed_words
    monkeypatch.setattr(encoders, "WORDS_AT_ONCE", 50)
    monkeypatch.setattr(encoders, "_summed_words", lambda part, size: sizes.append(len(pa.concat_arrays([part]).flatten())) or summed(part, size))
    assert (encoders.hashed_vectors(codes, 8) == whole).all()
    assert len(sizes) > 3 and sum(sizes) == 293 and sorted(sizes)[-3] <= 50


def _lined(spark, monkeypatch):
    """Queries and items of few directions, so that many tie, and what each query is to find."""
    monkeypatch.setattr(vectors_module, "QUERY_BLOCK", 10)
    monkeypatch.setattr(vectors_module, "ITEM_BLOCK", 40)
    random = np.random.Generator(np.random.PCG64(8))
    directions = random.standard_normal((30, 5)).astype(np.float32)
    items = [(f"m{at:03d}", directions[at % 30].tolist(), int(at * 7 % 4)) for at in range(200)]
    queries = [(at, directions[(at * 11) % 30].tolist(), at % 9 + 1, [None, 0, 1, 5, 40][at % 5]) for at in range(40)]
    expected = set()
    for query_id, vector, top_k, enough in queries:
        scores = {}
        for name, other, _ in items:
            a, b = np.array(vector, dtype=np.float64), np.array(other, dtype=np.float64)
            scores[name] = round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 9)
        ordered = sorted(items, key=lambda item: (-scores[item[0]], item[0]))[:top_k]
        for rank, (name, _, _) in enumerate(ordered, 1):
            before = sum(lines for other, _, lines in ordered if scores[other] > scores[name])
            if enough is None or before < enough:
                expected.add((query_id, name, rank, before))
    return (
        spark.createDataFrame(queries, "query_id bigint, embedding array<float>, top_k int, _enough bigint"),
        spark.createDataFrame(items, "name string, embedding array<float>, _lines bigint"),
        expected,
    )


@pytest.mark.parametrize("tasks", [1, 24])
@pytest.mark.parametrize("shared", [4096, 60, 1], ids=["queries", "queries few", "neither"])
def test_items_beyond_enough_lines_are_left_out(spark, monkeypatch, shared, tasks):
    asked, stored, expected = _lined(spark, monkeypatch)
    monkeypatch.setattr(vectors_module, "LEAST_TASKS", tasks, raising=False)
    found = nearest(asked, stored, "name", 9, max_shared=shared).select("query_id", "name", "rank", "_before").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_items_are_answered_in_place_with_enough_lines(spark, monkeypatch):
    asked, stored, expected = _lined(spark, monkeypatch)
    copies = asked.select("*", F.explode(F.sequence(F.lit(0), F.lit(9))).alias("copy"))
    many = copies.withColumn("query_id", F.expr("query_id * 10 + copy")).drop("copy")
    found = nearest(many, stored, "name", 9, max_shared=250).select("query_id", "name", "rank", "_before").collect()
    assert sorted(map(tuple, found)) == sorted((q * 10 + copy, *rest) for q, *rest in expected for copy in range(10))


def test_large_tables_meet_without_copies(spark, monkeypatch, tmp_path):
    """Of a block only the final rows come out, and no side is shuffled once per block of the other."""
    monkeypatch.setattr(vectors_module, "QUERY_BLOCK", 25)
    monkeypatch.setattr(vectors_module, "ITEM_BLOCK", 150)
    monkeypatch.setattr(vectors_module, "LEAST_TASKS", 1, raising=False)
    random = np.random.Generator(np.random.PCG64(5))
    queries = [(at, row.tolist(), 20) for at, row in enumerate(random.standard_normal((50, 6)))]
    items = [(f"m{at:03d}", row.tolist()) for at, row in enumerate(random.standard_normal((600, 6)))]
    asked = spark.createDataFrame(queries, "query_id bigint, embedding array<float>, limit int")
    stored = spark.createDataFrame(items, "name string, embedding array<float>")
    met = vectors_module._meet_in_blocks(asked, stored, "name", 20, 600, 3600)
    assert met.count() == 50 * 20
    tree = final_plan(met).split("\n\n")[0]
    assert tree.count("Exchange") == 1 and "Generate" not in tree


def test_a_repeated_query_is_ranked_once_over_blocks(spark, monkeypatch):
    """As one query, in whichever form its blocks meet the items."""
    items = spark.createDataFrame([(at, [1.0, float(at)]) for at in range(300)], "item bigint, embedding array<float>")
    asked = spark.createDataFrame([(1, [1.0, 0.0], 2), (1, [1.0, 9.0], 3), (2, [1.0, 9.0], 1)], "query_id bigint, embedding array<float>, top_k int")
    found = []
    for tasks in (1, 24):
        monkeypatch.setattr(vectors_module, "LEAST_TASKS", tasks, raising=False)
        monkeypatch.setattr(vectors_module, "ITEM_BLOCK", 100)
        table = nearest(asked, items, "item", 5, max_shared=1)
        found.append(sorted((row.query_id, row.rank, row.item) for row in table.collect()))
    assert found[0] == found[1] == [(1, 1, 0), (1, 2, 9), (1, 3, 10), (2, 1, 9)]
