"""Plans are part of the contract: what must be pushed down, pruned, broadcast or avoided."""

import pytest
from pyspark.sql import functions as F

from helpers import final_plan
from checks.fixture import LogData
from timberline.operators.encoders import HashingEncoder
from timberline.operators.lsh import approximate_nearest, write_index
from timberline.operators.rollups import distinct_messages, messages_without_vector
from timberline.operators.vectors import nearest
from timberline.plans import analytics, search
from timberline.plans.prepare import log_entries


def operators(table) -> str:
    """The operator tree alone, from the last operator down to the scans."""
    return final_plan(table).split("\n\n")[0]


@pytest.fixture(scope="module")
def data(spark):
    return LogData(spark, "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def stored(data):
    return data.stored_logs()


def test_level_filters_prune_folders_and_columns(stored):
    plan = final_plan(analytics.frequent_errors(stored))
    assert "PartitionFilters: [level" in plan
    assert "raw_message" not in plan.split("ReadSchema")[1].split("\n")[0]
    by_time = final_plan(analytics.timeline(stored, event_id="E1", level="ERROR"))
    assert "EqualTo(event_id,E1)" in by_time and "IsNotNull(log_timestamp)" in by_time
    assert by_time.split("ReadSchema: ")[1].startswith("struct<log_timestamp:timestamp_ntz,event_id:string>")


def test_counts_are_combined_before_the_shuffle(stored):
    tree = operators(distinct_messages(stored))
    before_the_shuffle = tree[tree.rindex("Exchange") :]
    assert "HashAggregate" in before_the_shuffle and "Sort" not in before_the_shuffle


def test_messages_without_vector_is_an_anti_join(stored, data):
    assert "LeftAnti" in final_plan(messages_without_vector(distinct_messages(stored), data.document_vectors()))


def test_neighbours_limit_in_every_task_and_never_pair_up(data):
    vectors = data.given("embeddings").select("vec_id", "embedding")
    plan = final_plan(nearest(vectors.withColumnRenamed("vec_id", "query_id"), vectors, "vec_id", 5))
    assert plan.count("WindowGroupLimit") >= 4
    for unwanted in ("Cartesian", "NestedLoop", "SortMergeJoin"):
        assert unwanted not in plan
    # The items are not shuffled before they are scored.
    tree = plan.split("\n\n")[0]
    assert "Exchange" not in tree[tree.index("MapInArrow") :]


def test_searches_broadcast_hashes_and_keep_line_scans_in_place(stored, data):
    vectors = HashingEncoder(16).encode(distinct_messages(stored), "normalized_message")
    plan = final_plan(search.semantic_search(data.requests(), stored, vectors, HashingEncoder(16)))
    assert "LeftSemi" in plan and "_hash" in plan
    for unwanted in ("Cartesian", "NestedLoop"):
        assert unwanted not in plan


def test_keyword_requests_meet_no_pairs_of_lines(stored, data):
    plan = final_plan(search.keyword_search(data.requests(), stored))
    # The one join fetches the lines of the ranked keys.
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert plan.count("BroadcastHashJoin Inner") + plan.count("SortMergeJoin Inner") <= 2
    assert "WindowGroupLimit" in plan


def test_limit_reaches_both_sides_of_the_preparation(data, spark, tmp_path):
    data.raw().write.parquet(str(tmp_path / "raw"))
    data.structured().write.parquet(str(tmp_path / "structured"))
    raw, structured = spark.read.parquet(str(tmp_path / "raw")), spark.read.parquet(str(tmp_path / "structured"))
    plan = final_plan(log_entries(raw.where(F.col("line_id") <= 10), structured))
    assert plan.count("LessThanOrEqual(line_id,10)") == 2
    filtered = final_plan(log_entries(raw, structured).where("level = 'ERROR'"))
    assert filtered.count("regexp_replace(raw_line") == 1


def test_index_folders_are_pruned(data, spark, tmp_path):
    vectors = data.given("embeddings").select("vec_id", "embedding")
    write_index(vectors, str(tmp_path / "index"), 4)
    queries = vectors.limit(1).withColumnRenamed("vec_id", "query_id")
    plan = final_plan(approximate_nearest(queries, spark.read.parquet(str(tmp_path / "index")), "vec_id", 3, 2, 4))
    assert "dynamicpruning" in plan
