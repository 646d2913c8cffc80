"""Stored summaries against the same reports over all log lines."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from timberline.operators.encoders import HashingEncoder
from timberline.operators.rollups import distinct_messages, hour_summary, levels_per_message, message_summary
from timberline.plans import analytics, load as loading, search, stored_analytics, summaries
from timberline.plans.load import ContractViolation, create_empty, load
from timberline.plans.vectorise import refresh_vectors, vectorise
from timberline.schemas import EVENT_TEMPLATES, LOG_ENTRIES
from timberline.sinks.changes import Change
from timberline.sources.tables import HOURS, LOGS, MESSAGES, Tables

ENCODER = HashingEncoder(16)


def lines(spark, first, count, day=1):
    """Lines of a few messages, events, levels and hosts; every fifth has no time, every seventh no event."""
    rows = []
    for number in range(first, first + count):
        time = None if number % 5 == 0 else datetime(2024, 1, day, number % 24, number % 60)
        event = None if number % 7 == 0 else f"E{number % 2}"
        level = ("INFO", "ERROR", "WARNING")[number % 3]
        host = None if number % 4 == 0 else f"h{number % 6}"
        message = f"text {number % 11}"
        rows.append((number, "s", time, None, None, None, host, None, None, level, event, message, message, None))
    return spark.createDataFrame(rows, LOG_ENTRIES)


def templates(spark, *names):
    return spark.createDataFrame([(name, name, 1) for name in names], EVENT_TEMPLATES)


@pytest.fixture
def stored(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "stored"))
    load(lines(spark, 1, 40), templates(spark, "E0", "E1"), tables)
    load(lines(spark, 41, 30, day=2), templates(spark), tables, reset=False)
    return tables


def parts(tables, name):
    return len(tables.folders(name))


def rows(table):
    return sorted(map(tuple, table.collect()), key=str)


def assert_equals_logs(tables):
    logs = tables.logs()
    assert rows(summaries.messages(tables)) == rows(message_summary(logs))
    hours = [table.select("bucket", "event_id", "level", "lines") for table in (summaries.hours(tables), hour_summary(logs))]
    assert rows(hours[0]) == rows(hours[1])


def assert_equal_reports(tables):
    logs = tables.logs()
    assert rows(stored_analytics.timeline(tables)) == rows(analytics.timeline(logs))
    one = {"granularity": "hour", "event_id": "E1", "level": "ERROR"}
    assert rows(stored_analytics.timeline(tables, **one)) == rows(analytics.timeline(logs, **one))
    assert stored_analytics.frequent_errors(tables).collect() == analytics.frequent_errors(logs).collect()
    assert stored_analytics.level_histogram(tables).collect() == analytics.level_histogram(logs).collect()
    assert stored_analytics.table_statistics(tables).first() == analytics.table_statistics(logs, tables.vectors()).first()
    sets = [
        {row.normalized_message: sorted(row.scopes) for row in table.collect()}
        for table in (summaries.level_sets(tables), levels_per_message(logs))
    ]
    assert sets[0] == sets[1]
    exact = (
        logs.where("log_timestamp IS NOT NULL")
        .groupBy(F.col("log_timestamp").cast("date").cast("timestamp_ntz").alias("bucket"))
        .agg(F.count(F.lit(1)), F.count_distinct("normalized_message"), F.count_distinct("host"))
    )
    assert rows(stored_analytics.distinct_estimates(tables)) == rows(exact)


def test_reports_of_several_loads(stored):
    assert parts(stored, MESSAGES) == parts(stored, HOURS) == 2
    vectorise(stored, ENCODER, limit=4)
    assert_equal_reports(stored)


def test_many_parts_are_written_as_one(spark, stored, monkeypatch):
    monkeypatch.setattr(summaries, "MOST_PARTS", 2)
    load(lines(spark, 80, 9), templates(spark), stored, reset=False)
    assert parts(stored, MESSAGES) == parts(stored, HOURS) == 1
    assert parts(stored, LOGS) == 3
    assert_equals_logs(stored)
    load(lines(spark, 90, 9), templates(spark), stored, reset=False)
    assert parts(stored, MESSAGES) == 2
    assert_equals_logs(stored)


def test_reset_and_empty_tables(spark, stored):
    create_empty(stored)
    assert parts(stored, HOURS) == 0
    assert stored_analytics.timeline(stored).collect() == []
    assert_equals_logs(stored)
    load(lines(spark, 5, 6), templates(spark, "E0", "E1"), stored)
    assert parts(stored, MESSAGES) == 1
    assert_equals_logs(stored)


def test_tables_that_were_never_loaded(spark, tmp_path):
    tables = Tables(spark, str(tmp_path / "none"))
    assert stored_analytics.frequent_errors(tables).collect() == []
    assert stored_analytics.table_statistics(tables).first().total_logs == 0


def test_a_failed_load_leaves_summaries_alone(spark, stored, monkeypatch):
    before = rows(summaries.messages(stored))

    def fails(change, loaded):
        summaries.extend(change, loaded)
        raise OSError("disk")

    monkeypatch.setattr(loading, "summaries", type("Failing", (), {"extend": staticmethod(fails)}))
    with pytest.raises(OSError):
        load(lines(spark, 80, 9), templates(spark), stored, reset=False)
    monkeypatch.undo()
    with pytest.raises(ContractViolation):
        load(lines(spark, 1, 1), templates(spark), stored, reset=False)
    assert rows(summaries.messages(stored)) == before
    load(lines(spark, 80, 9), templates(spark), stored, reset=False)
    assert_equals_logs(stored)


def test_logs_from_before_summaries(spark, stored):
    with Change(stored) as change:
        del change.tables[MESSAGES], change.tables[HOURS]
        change.publish()
    assert parts(stored, MESSAGES) == 0
    assert_equals_logs(stored)
    load(lines(spark, 80, 9), templates(spark), stored, reset=False)
    assert parts(stored, MESSAGES) == parts(stored, HOURS) == 1
    assert_equals_logs(stored)


def test_vectors_follow_the_summaries(spark, stored):
    vectorise(stored, ENCODER)
    expected = {row.normalized_message: row.occurrences for row in distinct_messages(stored.logs()).collect()}
    assert {row.normalized_message: row.occurrences for row in stored.vectors().collect()} == expected
    load(lines(spark, 80, 9), templates(spark), stored, reset=False)
    refresh_vectors(stored, stored.vectors().where("false"), ENCODER)
    expected = {row.normalized_message: row.occurrences for row in distinct_messages(stored.logs()).collect()}
    assert {row.normalized_message: row.occurrences for row in stored.vectors().collect()} == expected


def files_read(table):
    return "\n".join(table.inputFiles())


def test_reports_read_no_logs(stored):
    for table in (
        stored_analytics.timeline(stored),
        stored_analytics.frequent_errors(stored),
        stored_analytics.level_histogram(stored),
        stored_analytics.distinct_estimates(stored),
        stored_analytics.table_statistics(stored),
        summaries.level_sets(stored),
    ):
        assert "_summaries/" in files_read(table) and f"/{LOGS}/" not in files_read(table)


def test_a_search_by_level_reads_the_logs_once(spark, stored, monkeypatch):
    vectorise(stored, ENCODER)
    requests = spark.createDataFrame(
        [(1, "text 3", "ERROR", 5), (2, "text 4", None, 30), (3, "text 8", "WARNING", 9)],
        "query_id bigint, text string, level string, top_k int",
    )
    expected = search.semantic_search(requests, stored.logs(), stored.vectors(), ENCODER).collect()
    settled_plans = []
    plain = search.settled
    monkeypatch.setattr(
        search, "settled", lambda table, purpose: settled_plans.append(files_read(table)) or plain(table, purpose)
    )
    found = search.semantic_search(
        requests, stored.logs(), stored.vectors(), ENCODER, level_sets=summaries.level_sets(stored)
    )
    assert found.collect() == expected
    # What runs before the lines are fetched touches vectors and summaries only.
    assert settled_plans and not any(f"/{LOGS}/" in files for files in settled_plans)
    only = search.semantic_search(
        requests.where("level IS NOT NULL"), stored.logs(), stored.vectors(), ENCODER,
        level_sets=summaries.level_sets(stored),
    )
    assert rows(only) == sorted((tuple(row) for row in expected if row.query_id != 2), key=str)
