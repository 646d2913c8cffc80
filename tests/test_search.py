import pytest
from pyspark.sql import functions as F

from helpers import logs_of
from timberline.fixed_values import RESULT_COLUMNS
from timberline.operators.encoders import HashingEncoder
from timberline.operators.ranking import in_time_order, top_per_group
from timberline.operators.requests import single_request
from timberline.operators.rollups import distinct_messages, short_name
from timberline.operators.spread import spread_common_join
from timberline.plans import analytics, search
from timberline.plans.evaluation import compare_encoders, comparison_candidates, evaluate_requests
from timberline.schemas import REQUESTS

ENCODER = HashingEncoder(32)


def vectors_of(logs):
    return ENCODER.encode(distinct_messages(logs), "normalized_message")


@pytest.fixture(scope="module")
def hot(spark):
    """600 lines; one message owns a third of them, and some carry no time."""
    rows = []
    for at in range(1, 601):
        message = "disk full on node" if at % 3 == 0 else f"login user{at % 45} from host{at % 7}"
        level = ["ERROR", "INFO", "WARNING"][at % 11 % 3]
        rows.append((at, None if at % 10 == 0 else (at * 37) % 500, level, f"E{at % 4}" if at % 9 else None, message))
    logs = logs_of(spark, rows).repartition(7)
    return rows, logs.cache(), vectors_of(logs).cache()


def in_order(rows):
    return sorted(rows, key=lambda row: (row[1] is None, row[1] or 0, row[0]))


def test_top_per_group_is_exact_for_hot_groups(hot):
    rows, logs, _ = hot
    found = top_per_group(logs, ["normalized_message"], in_time_order(), 5, parts=3).collect()
    expected = set()
    for message in {row[4] for row in rows}:
        for rank, row in enumerate(in_order([r for r in rows if r[4] == message])[:5], 1):
            expected.add((message, rank, row[0]))
    assert {(row.normalized_message, row.rank, row.line_id) for row in found} == expected


def test_one_hot_message_fills_results_in_time_order(spark, hot):
    rows, logs, vectors = hot
    found = search.semantic_search(single_request(spark, "disk full on node", 200), logs, vectors, ENCODER)
    ranked = found.orderBy("rank").collect()
    own = [row[0] for row in in_order([row for row in rows if row[4] == "disk full on node"])]
    assert len(own) == 200
    assert [row.line_id for row in ranked] == own
    assert all(abs(row.similarity - 1) < 1e-6 for row in ranked)
    assert found.columns == ["query_id", *RESULT_COLUMNS, "similarity", "rank"]


def test_many_requests_for_one_hot_message(spark, hot):
    rows, logs, vectors = hot
    requests = spark.createDataFrame([(at, "disk full on node", None, 1 + at % 60) for at in range(120)], REQUESTS)
    found = search.semantic_search(requests, logs, vectors, ENCODER)
    own = [row[0] for row in in_order([row for row in rows if row[4] == "disk full on node"])]
    by_query = {}
    for row in found.orderBy("query_id", "rank").collect():
        by_query.setdefault(row.query_id, []).append(row.line_id)
    assert by_query == {at: own[: 1 + at % 60] for at in range(120)}


def test_level_is_applied_before_the_candidate_cut(spark):
    near = [(at, at, "INFO", "E1", "alpha beta " + "x" * at) for at in range(1, 40)]
    rare = [(100, 1, "ERROR", "E2", "gamma delta"), (101, 2, "ERROR", "E1", "alpha beta x")]
    logs = logs_of(spark, near + rare)
    requests = spark.createDataFrame([(1, "alpha beta", "ERROR", 3), (2, "alpha beta", "ALL", 3)], REQUESTS)
    found = search.semantic_search(requests, logs, vectors_of(logs), ENCODER).collect()
    assert {row.line_id for row in found if row.query_id == 1} == {100, 101}
    assert {row.level for row in found if row.query_id == 1} == {"ERROR"}
    assert len([row for row in found if row.query_id == 2]) == 3


def test_large_request_tables_take_the_other_way(hot, spark, monkeypatch):
    rows, logs, vectors = hot
    requests = spark.createDataFrame(
        [(at, ["disk full", "login user3", "host5 login"][at % 3], [None, "ERROR"][at % 2], 4) for at in range(12)], REQUESTS
    )
    columns = ["query_id", "rank", "line_id", F.round("similarity", 9).alias("s")]
    expected = search.semantic_search(requests, logs, vectors, ENCODER).select(*columns).collect()
    monkeypatch.setattr(search, "MAX_SHARED_MESSAGES", 2)
    found = search.semantic_search(requests, logs, vectors, ENCODER).select(*columns).collect()
    assert sorted(found) == sorted(expected)
    monkeypatch.setattr(search, "MAX_SHARED_QUERIES", 2)
    found = search.semantic_search(requests, logs, vectors, ENCODER).select(*columns).collect()
    assert sorted(found) == sorted(expected)
    seeds = spark.createDataFrame([(3,), (4,), (9999,), (300,)], "seed_id bigint")
    near = search.similar_logs(seeds, logs, vectors, 7).select("seed_id", "rank", "line_id").collect()
    monkeypatch.setattr(search, "MAX_SHARED_SEEDS", 1)
    assert sorted(search.similar_logs(seeds, logs, vectors, 7).select("seed_id", "rank", "line_id").collect()) == sorted(near)


def test_similar_logs_leave_out_the_seed_only(spark, hot):
    rows, logs, vectors = hot
    seeds = spark.createDataFrame([(3, 50), (4, None), (9999, 5)], "seed_id bigint, top_k int")
    found = search.similar_logs(seeds, logs, vectors).collect()
    first = [row for row in found if row.seed_id == 3]
    assert len(first) == 50 and 3 not in {row.line_id for row in first}
    assert {row.raw_message for row in first} == {"disk full on node"}
    assert len([row for row in found if row.seed_id == 4]) == 20
    assert not [row for row in found if row.seed_id == 9999]
    without = vectors.where("normalized_message <> 'disk full on node'")
    assert search.similar_logs(seeds.where("seed_id = 3"), logs, without).count() == 0


def test_keyword_search_order_and_compare(spark, hot):
    rows, logs, vectors = hot
    requests = spark.createDataFrame([(1, "LOGIN user4", "ALL", 9), (2, "nothing like it", "", None)], REQUESTS)
    found = search.keyword_search(requests, logs).orderBy("rank").collect()
    expected = [row[0] for row in in_order([row for row in rows if "login user4" in row[4]])][:9]
    assert [row.line_id for row in found] == expected
    both = search.compare_search(requests, logs, vectors, ENCODER).groupBy("query_id", "method").count().collect()
    assert {(row.query_id, row.method): row["count"] for row in both} == {
        (1, "semantic"): 9, (1, "keyword"): 9, (2, "semantic"): 20,
    }
    report = {row.query_id: row for row in evaluate_requests(requests, logs, vectors, ENCODER).collect()}
    assert (report[1].semantic_result_count, report[1].keyword_result_count, report[1].level) == (9, 9, "ALL")
    assert (report[2].semantic_result_count, report[2].keyword_result_count) == (20, 0)
    nothing = evaluate_requests(requests, logs.where("false"), vectors, ENCODER).collect()
    assert [(row.score, row.result_count, row.dominant_event_id) for row in nothing] == [(0.0, 0, None)] * 2


def test_nearest_events_are_first_seen_and_limited(spark):
    rows = [(at, at, "INFO", f"E{at % 8}" if at % 5 else "", "same text") for at in range(1, 60)]
    logs = logs_of(spark, rows)
    found = search.nearest_events(single_request(spark, "same text"), logs, vectors_of(logs), ENCODER)
    assert [(row.rank, row.event_id) for row in found.orderBy("rank").collect()] == [
        (1, "E1"), (2, "E2"), (3, "E3"), (4, "E4"), (5, "E6"),
    ]


def test_timelines(spark):
    rows = [(1, 10, "INFO", "E1", "a b"), (2, 70, "ERROR", "E1", "a b"), (3, 1450, "INFO", "E2", "c d"), (4, None, "INFO", "E1", "a b"), (5, 20, "INFO", None, "e f")]
    logs = logs_of(spark, rows)
    day = [(row.bucket.day, row["count"]) for row in analytics.timeline(logs).collect()]
    assert day == [(1, 3), (2, 1)]
    hour = [(row.bucket.day, row.bucket.hour, row["count"]) for row in analytics.timeline(logs, "hour").collect()]
    assert hour == [(1, 0, 2), (1, 1, 1), (2, 0, 1)]
    assert analytics.timeline(logs, event_id="E1", level="ERROR").first()["count"] == 1
    assert analytics.timeline(logs, level="ALL").count() == 2
    for arguments in ({"granularity": "week"}, {"level": "LOUD"}):
        with pytest.raises(ValueError):
            analytics.timeline(logs, **arguments)
    requests = spark.createDataFrame([(1, "a b", None, None), (2, "a b", "ERROR", None)], REQUESTS)
    vectors = vectors_of(logs.where("event_id = 'E1'"))
    table = analytics.timelines(requests, logs, vectors, ENCODER).collect()
    assert [(row.query_id, row["count"], row.matched_event_ids) for row in table] == [(1, 2, ["E1"]), (2, 1, ["E1"])]
    # Without a matching event all lines count.
    unmatched = analytics.timelines(requests, logs, vectors_of(logs.where("event_id IS NULL")), ENCODER).collect()
    assert [(row.query_id, row["count"], row.matched_event_ids) for row in unmatched] == [(1, 3, []), (1, 1, []), (2, 1, [])]
    # A named event wins over the text; without either all lines count.
    mixed = spark.createDataFrame(
        [(1, "a b", None, None, "E2"), (2, "", "INFO", None, ""), (3, None, None, None, None)],
        "query_id bigint, text string, level string, top_k int, event_id string",
    )
    table = analytics.timelines(mixed, logs, vectors, ENCODER).collect()
    assert [(row.query_id, row.bucket.day, row["count"], row.matched_event_ids) for row in table] == [
        (1, 2, 1, []), (2, 1, 2, []), (2, 2, 1, []), (3, 1, 3, []), (3, 2, 1, []),
    ]


def test_timeline_ignores_the_session_time_zone(spark):
    logs = logs_of(spark, [(1, 30 * 1440 + 150, "INFO", "E1", "x")])  # 2024-03-31 02:30, skipped in Paris
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        bucket = analytics.timeline(logs, "hour").selectExpr("CAST(bucket AS STRING) AS b").first().b
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert bucket == "2024-03-31 02:00:00"


def test_frequent_errors(spark):
    rows = [(at, at, ["ERROR", "INFO", "WARNING"][at % 3], f"E{at % 2}", "m") for at in range(30)]
    logs = logs_of(spark, rows)
    found = analytics.frequent_errors(logs, 3).collect()
    assert [row["count"] for row in found] == [5, 5, 5]
    assert {row.level for row in found} <= {"ERROR", "WARNING"}
    assert {row.level for row in analytics.frequent_errors(logs, level="INFO").collect()} == {"INFO"}
    assert analytics.frequent_errors(logs, level="ALL").count() == 4
    for arguments in ((0,), (101,), (5, "LOUD")):
        with pytest.raises(ValueError):
            analytics.frequent_errors(logs, *arguments)


def test_statistics_of_empty_and_partly_covered_tables(spark, hot):
    rows, logs, vectors = hot
    some = vectors.where("normalized_message = 'disk full on node'")
    row = analytics.table_statistics(logs, some).first()
    assert (row.total_logs, row.embedded_logs, row.embedded_messages, row.event_count) == (600, 200, 1, 4)
    assert row.coverage_pct == 33.3
    empty = analytics.table_statistics(logs.where("false"), some).first()
    assert (empty.total_logs, empty.coverage_pct, empty.embedded_messages) == (0, 0.0, 1)


def test_encoders_are_compared_on_the_same_candidates(spark, hot):
    rows, logs, _ = hot
    requests = spark.createDataFrame([(1, "disk full"), (2, "login")], "query_id bigint, text string")
    encoders = [HashingEncoder(16, "a"), HashingEncoder(64, "b")]
    report = compare_encoders(requests, logs, encoders, top_k=5, candidate_limit=10).collect()
    assert {(row.model, row.query_id, row.dimension, row.candidate_count) for row in report} == {
        ("a", 1, 16, 10), ("a", 2, 16, 10), ("b", 1, 64, 10), ("b", 2, 64, 10),
    }
    assert comparison_candidates(logs, candidate_limit=10).first().normalized_message == "disk full on node"
    none = compare_encoders(requests, logs.where("false"), encoders).collect()
    assert {(row.dimension, row.candidate_count, row.score) for row in none} == {(None, 0, 0.0)}
    for arguments in ({"top_k": 51}, {"candidate_limit": 9}, {"candidate_limit": 5001}):
        with pytest.raises(ValueError):
            comparison_candidates(logs, **arguments)


def test_any_number_of_results_is_given(spark, hot):
    _, logs, vectors = hot
    deep = single_deep = spark.createDataFrame([(1, "disk full on node", None, 500), (2, "login", None, 3)], REQUESTS)
    counts = {r.query_id: r["count"] for r in search.keyword_search(deep, logs).groupBy("query_id").count().collect()}
    assert counts == {1: 200, 2: 3}
    counts = {r.query_id: r["count"] for r in search.semantic_search(single_deep, logs, vectors, ENCODER).groupBy("query_id").count().collect()}
    assert counts == {1: 500, 2: 3}
    many = spark.range(5000).selectExpr("id query_id", "'disk' text", "cast(null as string) level", "if(id = 7, 250, 1) top_k")
    counts = {r.query_id: r["count"] for r in search.semantic_search(many, logs, vectors, ENCODER).groupBy("query_id").count().collect()}
    assert counts.pop(7) == 250 and set(counts.values()) == {1}


@pytest.mark.parametrize("rows", [[(1, "a", None, 0)], [(1, "a", "LOUD", 5)], [(1, "a", None, 5), (1, "b", None, 5)]])
def test_requests_that_cannot_be_answered_are_refused(spark, hot, rows):
    _, logs, vectors = hot
    requests = spark.createDataFrame(rows, REQUESTS)
    for ask in (lambda: search.keyword_search(requests, logs), lambda: search.semantic_search(requests, logs, vectors, ENCODER)):
        with pytest.raises(ValueError):
            ask()


def test_repeated_requests_and_seeds_count_once(spark, hot):
    _, logs, vectors = hot
    once = spark.createDataFrame([(1, "disk", None, 5)], REQUESTS)
    key = lambda table: sorted((r.rank, r.line_id) for r in table.collect())
    assert key(search.keyword_search(once.unionAll(once), logs)) == key(search.keyword_search(once, logs))
    seeds = spark.createDataFrame([(3, 5)], "seed_id bigint, top_k int")
    assert key(search.similar_logs(seeds.unionAll(seeds), logs, vectors)) == key(search.similar_logs(seeds, logs, vectors))
    with pytest.raises(ValueError):
        search.similar_logs(seeds.unionAll(spark.createDataFrame([(3, 6)], seeds.schema)), logs, vectors)
    with pytest.raises(ValueError):
        search.similar_logs(spark.createDataFrame([(3, 0)], seeds.schema), logs, vectors)


def test_pairs_of_many_requests_hold_no_text(spark, hot, monkeypatch):
    """Of many requests each keeps its own number of matches, by number of the message, in its order."""
    rows, logs, vectors = hot
    monkeypatch.setattr(search, "MAX_SHARED_MESSAGES", 2)
    kept = {}
    settled = search.settled
    monkeypatch.setattr(search, "settled", lambda table, purpose: kept.setdefault(purpose, settled(table, purpose)))
    seeds = spark.createDataFrame([(3, 1), (4, 40)], "seed_id bigint, top_k int")
    found = search.similar_logs(seeds, logs, vectors).groupBy("seed_id").count().collect()
    assert {row.seed_id: row["count"] for row in found} == {3: 1, 4: 40}
    assert "string" not in dict(kept["matches"].dtypes).values()
    per_query = {row.query_id: row["count"] for row in kept["matches"].groupBy("query_id").count().collect()}
    assert sorted(per_query.values())[0] <= 20
    numbers = kept["numbers"].orderBy("_number").collect()
    assert [row.normalized_message for row in numbers] == sorted({row[4] for row in rows})


def _with_long_messages(spark):
    """Lines of long messages that differ in their last letter only, of short ones, and of none."""
    long = "disk full on node " * 20
    rows = [(at, at % 50, "ERROR", f"E{at % 3}", [f"{long}{at % 4}", f"login {at % 5}", None][at % 3]) for at in range(120)]
    logs = logs_of(spark, rows)
    return long, logs, ENCODER.encode(distinct_messages(logs.where("raw_message IS NOT NULL")), "normalized_message")


def test_many_requests_match_messages_by_short_names_and_enough_lines(spark, monkeypatch):
    long, logs, vectors = _with_long_messages(spark)
    requests = spark.createDataFrame(
        [(at, ["disk full", "login 3", "node 2"][at % 3], [None, "ERROR"][at % 2], at % 4 + 1) for at in range(12)], REQUESTS
    )
    unleveled = requests.withColumn("level", F.lit(None).cast("string"))
    columns = ["query_id", "rank", "line_id", F.round("similarity", 9).alias("s")]
    answers = lambda asked: sorted(search.semantic_search(asked, logs, vectors, ENCODER).select(*columns).collect())
    expected = [answers(requests), answers(unleveled)]
    monkeypatch.setattr(search, "MAX_SHARED_MESSAGES", 2)
    monkeypatch.setattr(search, "MAX_SHARED_QUERIES", 2)
    assert answers(requests) == expected[0]
    kept = {}
    settled = search.settled
    monkeypatch.setattr(search, "settled", lambda table, purpose: kept.setdefault(purpose, settled(table, purpose)))
    assert answers(unleveled) == expected[1]
    # Every message has ten lines or eight, more than any request asks for: only the best ones count.
    names = [row.normalized_message for row in kept["numbers"].orderBy("_number").collect()]
    assert len(names) == 9 and all(len(name) == 65 for name in names[:4]) and names[4:] == [f"login {at}" for at in range(5)]
    assert kept["matches"].count() < 12 * 9


@pytest.mark.parametrize("repeated", [False, True])
def test_similar_logs_of_many_seeds_equal_those_of_few(spark, monkeypatch, repeated):
    _, logs, vectors = _with_long_messages(spark)
    if repeated:
        # Ids and vectors that come twice; a few messages are of lines that do only.
        single = [(200 + at, 5, "INFO", "E5", f"reboot {at}") for at in range(8)]
        more = logs_of(spark, single + single[4:])
        logs = logs.unionAll(logs.where("id % 7 = 0")).unionAll(more)
        more_vectors = vectors_of(more)
        vectors = vectors.unionAll(vectors.where("normalized_message LIKE '%1'")).unionAll(more_vectors)
        vectors = vectors.unionAll(more_vectors.where("normalized_message > 'reboot 2'"))
    seeds = logs.dropDuplicates(["id"]).select(F.col("id").alias("seed_id"), F.expr("IF(id % 10 = 0, 90, 1 + id % 5)").cast("int").alias("top_k"))
    answers = lambda: sorted(search.similar_logs(seeds, logs, vectors).select("seed_id", "rank", "line_id").collect())
    expected = answers()
    monkeypatch.setattr(search, "MAX_SHARED_MESSAGES", 2)
    monkeypatch.setattr(search, "MAX_SHARED_SEEDS", 2)
    kept = {}
    settled = search.settled
    monkeypatch.setattr(search, "settled", lambda table, purpose: kept.setdefault(purpose, settled(table, purpose)))
    assert answers() == expected
    # Nine messages have ten or eight lines each; a seed that asks for five needs its own message or two.
    assert repeated or kept["wanted"].where("top_k <= 5").groupBy("query_id").count().agg(F.max("count")).first()[0] <= 4


def test_short_names_tell_messages_apart(spark):
    texts = ["", "a", "a" * 64, "a" * 65, "a" * 66, "é" * 64, None, "#"]
    table = spark.createDataFrame([(text,) for text in texts], "m string").select("m", short_name("m").alias("n"))
    names = {row.m: row.n for row in table.collect()}
    assert len(set(names.values())) == len(texts) and names[None] is None
    assert all(name == text or len(name) == 65 and len(text) > 64 for text, name in names.items() if text is not None)


def test_only_common_keys_are_copied(spark):
    many = spark.range(300).selectExpr("id AS query_id", "IF(id % 3 = 0, 0, id % 17) AS k")
    few = spark.createDataFrame([(k, copy) for k in [*range(0, 17, 2), None] for copy in range(3)], "k bigint, copy int")
    plain = many.join(few, "k").select("query_id", "k", "copy")
    for common in (0, 50, 1000):
        spread = spread_common_join(many, few, ["k"], "query_id", 5, common)
        assert sorted(spread.select("query_id", "k", "copy").collect()) == sorted(plain.collect())
        assert "_join_part" not in spread.columns and "_common" not in spread.columns
