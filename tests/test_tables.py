import hashlib
import json

import pytest
from pyspark.sql import functions as F

from checks.reading import write_raw_text, write_structured_csv, write_templates_csv
from checks.fixture import LogData
from timberline.operators import contracts
from timberline.operators.encoders import HashingEncoder
from timberline.operators.upsert import upsert
from timberline.plans.full_run import Inputs, run_all
from timberline.plans.load import ContractViolation, create_empty, load, require, vector_contract_report
from timberline.plans.prepare import prepare
from timberline.plans.storage import latest_run, step_timings, storage_report
from timberline.plans.vectorise import index_vectors, new_vectors, refresh_vectors, refreshed_counts, vectorise
from timberline.schemas import EVENT_TEMPLATES, LOG_ENTRIES, RUNS
from timberline.sinks.changes import Change, ConcurrentChange
from timberline.sources.tables import INDEX, LOGS, TEMPLATES, Tables

ENCODER = HashingEncoder(16)


def violations(report):
    return {row.rule: row.violations for row in report.collect()}


def test_contract_checks(spark):
    table = spark.createDataFrame([(1, "a"), (1, None), (1, "c"), (2, "b"), (None, "b")], "k bigint, v string")
    parent = spark.createDataFrame([("a",), ("b",)], "v string")
    assert violations(contracts.check_unique(table, "t", ["k"])) == {"t.k unique": 2}
    assert violations(contracts.check_unique(table.limit(0), "t", ["k"])) == {"t.k unique": 0}
    assert violations(contracts.check_not_null(table, "t", ["k", "v"])) == {"t.k not null": 1, "t.v not null": 1}
    assert violations(contracts.check_reference(table, "t", "v", parent, "p", "v")) == {"t.v references p.v": 1}
    stored = spark.createDataFrame([(2,), (9,)], "k bigint")
    assert violations(contracts.check_new_keys(table, "t", "k", stored)) == {"t.k new": 1}
    assert violations(contracts.check_new_keys(table.limit(0), "t", "k", stored)) == {"t.k new": 0}


def test_vector_contracts(spark):
    vectors = spark.createDataFrame(
        [("a", [1.0, 2.0]), ("a", [1.0]), ("b", None)], "normalized_message string, embedding array<float>"
    )
    found = violations(vector_contract_report(vectors, 2))
    assert sorted(found.values()) == [0, 1, 1, 1]
    with pytest.raises(ContractViolation, match="has 2 elements: 1"):
        require(vector_contract_report(vectors, 2))


def test_upsert_replaces_whole_rows_and_keeps_the_newest(spark):
    stored = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, x int, v int")
    changes = spark.createDataFrame([("b", 3, 1), ("b", None, 2), ("c", 5, 1)], "k string, x int, v int")
    assert sorted(upsert(stored, changes, "k", "v").collect(), key=lambda r: r.k) == [
        ("a", 1, 0), ("b", None, 2), ("c", 5, 1),
    ]


def _entry(line_id, event_id="E1", message="m"):
    return (line_id, None, None, None, None, None, None, None, None, "INFO", event_id, message, message, None)


def test_load_refuses_broken_batches_and_leaves_tables_alone(spark, tmp_path):
    target = Tables(spark, str(tmp_path))
    templates = spark.createDataFrame([("E1", "t", None)], EVENT_TEMPLATES)

    def logs(*rows):
        return spark.createDataFrame(list(rows), LOG_ENTRIES)

    loaded = load(logs(_entry(1), _entry(2, None)), templates, target)
    assert (loaded.log_entries, loaded.event_templates) == (2, 1)
    assert target.templates().first().occurrences == 0
    assert {row.source for row in target.logs().collect()} == {"OpenSSH"}
    none = templates.where("false")
    for broken in (logs(_entry(2)), logs(_entry(3), _entry(3)), logs(_entry(3, "E9")), logs(_entry(3, "E1", None))):
        with pytest.raises(ContractViolation):
            load(broken, none, target, reset=False)
    with pytest.raises(ContractViolation):
        load(logs(_entry(3)), templates, target, reset=False)
    assert target.logs().count() == 2
    load(logs(_entry(3)), none, target, reset=False)
    assert [row.id for row in target.logs().orderBy("id").collect()] == [1, 2, 3]
    load(logs(_entry(7)), templates, target)
    assert [row.id for row in target.logs().collect()] == [7]
    assert target.vectors().count() == 0


def test_vectorise_adds_only_what_is_missing(spark, tmp_path):
    target = Tables(spark, str(tmp_path))
    templates = spark.createDataFrame([("E1", "t", 1)], EVENT_TEMPLATES)
    rows = [_entry(at, message="abc"[at % 3] * 2) for at in range(1, 10)]
    load(spark.createDataFrame(rows, LOG_ENTRIES), templates, target)
    first = vectorise(target, ENCODER, limit=2)
    assert (first.distinct_texts, first.covered_logs) == (2, 6)
    second = vectorise(target, ENCODER)
    assert (second.distinct_texts, second.covered_logs) == (1, 3)
    assert vectorise(target, ENCODER).distinct_texts == 0
    assert sorted(row.normalized_message for row in target.vectors().collect()) == ["aa", "bb", "cc"]
    more = spark.createDataFrame([_entry(20, message="aa")], LOG_ENTRIES)
    load(more, templates.where("false"), target, reset=False)
    assert new_vectors(target.logs(), target.vectors(), ENCODER).count() == 0
    refreshed = {row.normalized_message: row.occurrences for row in refreshed_counts(target.logs(), target.vectors()).collect()}
    assert refreshed == {"aa": 4, "bb": 3, "cc": 3}
    with pytest.raises(ValueError):
        new_vectors(target.logs(), target.vectors(), ENCODER, limit=0)


def test_latest_run(spark):
    day = "2024-01-0{} 00:00:00"
    details = json.dumps({"timings": {"load": 1.5, "total": 2.0}})
    rows = [
        ("a", "run", "SUCCESS", "{}", None, day.format(1)),
        ("b", "run", "SUCCESS", details, None, day.format(3)),
        ("c", "run", "FAILED", details, None, day.format(5)),
        ("d", "run", "SUCCESS", details, None, None),
    ]
    runs = spark.createDataFrame(rows, "id string, command string, status string, details string, started_at string, finished_at string")
    runs = runs.withColumn("finished_at", F.col("finished_at").cast("timestamp_ntz"))
    latest = latest_run(runs)
    assert latest.first().timings == {"load": 1.5, "total": 2.0}
    assert sorted((row.step, row.seconds) for row in step_timings(latest).collect()) == [("load", 1.5), ("total", 2.0)]
    assert latest_run(runs.where("id = 'a'")).first().timings == {}
    assert latest_run(runs.where("status = 'FAILED'")).count() == 0
    assert latest_run(spark.createDataFrame([], RUNS)).count() == 0


@pytest.fixture(scope="module")
def inputs(spark):
    data = LogData(spark, "/root/testdata/sf0.001")
    return data, Inputs(write_raw_text(data), write_structured_csv(data), write_templates_csv(data))


def test_prepare_with_limit_and_csv(spark, inputs, tmp_path):
    data, files = inputs
    target, csv = str(tmp_path / "tables"), str(tmp_path / "csv")
    done = prepare(
        spark, files.raw_log, files.structured_csv, files.templates_csv, target, limit=25, csv_target=csv, single_csv_file=True
    )
    assert (done.log_rows, done.template_rows) == (25, 10)
    stored = Tables(spark, target).read(LOGS)
    assert sorted(row.line_id for row in stored.collect()) == list(range(1, 26))
    assert spark.read.option("header", True).csv(f"{csv}/{LOGS}").count() == 25


def test_run_is_recorded_on_success_and_failure(spark, inputs, tmp_path):
    data, files = inputs
    tables = Tables(spark, str(tmp_path / "run"))
    details = run_all(spark, files, tables.root, ENCODER)
    lines = data.given("events").count()
    assert details["loaded"]["log_entries"] == lines
    assert set(details["timings"]) == {"prepare_data", "load", "embed", "index", "total"}
    report = storage_report(tables).first()
    assert report.total_logs == report.embedded_logs == lines
    assert report.coverage_pct == 100.0
    assert report.log_entries_bytes > 0 and report.message_embeddings_bytes > 0
    assert report.latest_timings.keys() == details["timings"].keys()
    with pytest.raises(Exception):
        run_all(spark, Inputs("/nowhere", files.structured_csv, files.templates_csv), tables.root, ENCODER)
    statuses = [row.status for row in tables.runs().orderBy("finished_at").collect()]
    assert statuses == ["SUCCESS", "FAILED"]
    failed = json.loads(tables.runs().where("status = 'FAILED'").first().details)
    assert "error" in failed and "total_until_failure" in failed["timings"]
    assert latest_run(tables.runs()).count() == 1


def test_empty_tables_can_be_reported(spark, tmp_path):
    tables = Tables(spark, str(tmp_path))
    create_empty(tables)
    report = storage_report(tables).first()
    assert (report.total_logs, report.embedded_logs, report.coverage_pct) == (0, 0, 0.0)
    assert report.latest_command is None
    assert tables.logs().count() == tables.runs().count() == 0


def failing_writes(monkeypatch, at):
    """The write number ``at``, from 0, of any change fails; one more is the manifest."""
    from timberline.sinks import changes

    calls = {"count": 0}
    add, create = changes.Change.add, changes.create_small_text

    def counted(real):
        def write(*args, **options):
            calls["count"] += 1
            if calls["count"] == at + 1:
                raise OSError("disk full")
            return real(*args, **options)

        return write

    monkeypatch.setattr(changes.Change, "add", counted(add))
    monkeypatch.setattr(changes, "create_small_text", counted(create))


def content(target):
    """What readers see, and the files they see it in."""
    rows = [sorted(map(str, table.collect())) for table in (target.logs(), target.templates(), target.vectors())]
    return rows, sorted(map(str, target.read(INDEX).collect())) if target.has_index() else None


def data_files(path):
    return {str(one) for one in path.rglob("*.parquet")}


def filled(spark, root):
    target = Tables(spark, str(root))
    templates = spark.createDataFrame([("E1", "old", 1)], EVENT_TEMPLATES)
    load(spark.createDataFrame([_entry(n, message=f"m{n % 30}") for n in range(60)], LOG_ENTRIES), templates, target)
    vectorise(target, ENCODER)
    index_vectors(target)
    return target


@pytest.mark.parametrize("at", range(3))
@pytest.mark.parametrize("reset", [True, False])
def test_a_failed_load_changes_nothing_for_readers(spark, tmp_path, monkeypatch, at, reset):
    """Templates, logs, manifest: whichever write fails, readers have the old tables, and a retry works."""
    target = filled(spark, tmp_path)
    before, files = content(target), data_files(tmp_path)
    more = spark.createDataFrame([("E2", "new", 1)], EVENT_TEMPLATES)
    lines = spark.createDataFrame([_entry(100, "E2", message="new")], LOG_ENTRIES)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        failing_writes(patch, at)
        load(lines, more, target, reset)
    assert content(target) == before
    assert data_files(tmp_path) == files
    assert load(lines, more, target, reset).log_entries == 1
    assert target.logs().count() == (1 if reset else 61)
    assert target.vectors().count() == (0 if reset else 30)


@pytest.mark.parametrize("at", range(3))
def test_failed_vectors_leave_no_doubles(spark, tmp_path, monkeypatch, at):
    """Vectors, index, manifest: after a stop between any two a rerun stores each message once."""
    target = filled(spark, tmp_path)
    lines = spark.createDataFrame([_entry(100 + n, message=f"new{n}") for n in range(9)], LOG_ENTRIES)
    load(lines, target.templates().where("false"), target, reset=False)
    before = content(target)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        failing_writes(patch, at)
        vectorise(target, ENCODER)
    assert content(target) == before
    assert vectorise(target, ENCODER).distinct_texts == 9
    messages = [sorted(row.normalized_message for row in table.collect()) for table in (target.vectors(), target.read(INDEX))]
    assert messages[0] == messages[1] == sorted({*messages[0]}) and len(messages[0]) == 39


@pytest.mark.parametrize("at", range(3))
def test_a_failed_refresh_changes_nothing(spark, tmp_path, monkeypatch, at):
    target = filled(spark, tmp_path)
    before = content(target)
    with monkeypatch.context() as patch, pytest.raises(OSError):
        failing_writes(patch, at)
        refresh_vectors(target, _changed(target, "m3"), ENCODER)
    assert content(target) == before


def _changed(target, *messages):
    """Stored vectors turned around, with a new level."""
    return target.vectors().where(F.col("normalized_message").isin(*messages)).withColumns(
        {
            "representative_level": F.lit("NEW"),
            "embedding": F.transform("embedding", lambda x: (-x).cast("float")),
            "updated_at": F.lit("2124-01-01 00:00:00").cast("timestamp_ntz"),
        }
    )


def test_a_refresh_writes_only_the_buckets_it_touches(spark, tmp_path):
    """Files of logs, templates and other buckets stay, and the index answers from the new vector."""
    target = filled(spark, tmp_path)
    in_use = lambda: {name: {(key, *folders) for key, folders in keys.items()} for name, keys in target.manifest().tables.items()}
    files, before, rows = data_files(tmp_path), in_use(), {r.normalized_message: r for r in target.vectors().collect()}
    assert refresh_vectors(target, _changed(target, "m3"), ENCODER) == 30
    after = in_use()
    assert before["log_entries"] == after["log_entries"] and before["event_templates"] == after["event_templates"]
    assert len(before["message_embeddings"] - after["message_embeddings"]) == 1
    assert len(before["message_index"] - after["message_index"]) <= 2
    new_files = data_files(tmp_path) - files
    assert new_files and not any("log_entries" in name or "event_templates" in name for name in new_files)
    now = {r.normalized_message: r for r in target.vectors().collect()}
    assert now.pop("m3").representative_level == "NEW"
    assert now == {message: row for message, row in rows.items() if message != "m3"}
    index = {r.normalized_message: r.embedding for r in target.read(INDEX).collect()}
    assert index == {r.normalized_message: r.embedding for r in target.vectors().collect()}


def test_lines_of_new_messages_are_counted_anew(spark, tmp_path):
    """A refresh without changes of its own finds the buckets whose counts are out of date."""
    target = filled(spark, tmp_path)
    load(spark.createDataFrame([_entry(100, message="m5")], LOG_ENTRIES), target.templates().where("false"), target, reset=False)
    before = target.manifest().tables["message_embeddings"]
    assert refresh_vectors(target, target.vectors().where("false"), ENCODER) == 30
    counts = {r.normalized_message: r.occurrences for r in target.vectors().collect()}
    assert counts.pop("m5") == 3 and set(counts.values()) == {2}
    after = target.manifest().tables["message_embeddings"]
    assert sum(before[key] != after[key] for key in before) == 1


def test_of_two_changes_at_once_one_is_refused(spark, tmp_path):
    target = filled(spark, tmp_path)
    files = data_files(tmp_path)
    with pytest.raises(ConcurrentChange), Change(target) as slow:
        load(spark.createDataFrame([_entry(100, message="m5")], LOG_ENTRIES), target.templates().where("false"), target, reset=False)
        slow.add(TEMPLATES, spark.createDataFrame([("E9", "late", 1)], EVENT_TEMPLATES))
        slow.publish()
    assert [row.event_id for row in target.templates().collect()] == ["E1"]
    assert target.logs().count() == 61 and len(data_files(tmp_path) - files) <= 2


def test_what_no_manifest_names_is_removed(spark, tmp_path):
    """The tables before the last change stay for those who still read them."""
    target = Tables(spark, str(tmp_path))
    templates = spark.createDataFrame([("E1", "t", 1)], EVENT_TEMPLATES)
    for line in range(4):
        readers = target.logs()
        load(spark.createDataFrame([_entry(line + 1)], LOG_ENTRIES), templates, target)
        assert readers.count() == min(line, 1)
    assert len(list((tmp_path / "log_entries").iterdir())) == 2
    assert len([p for p in (tmp_path / "_manifests").iterdir() if p.suffix == ".json"]) == 2
    assert [row.id for row in target.logs().collect()] == [4]


def scanned_rows(table):
    """Rows that the scans of a table handed on, after it was read."""
    table.collect()
    plan = table._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "Adaptive" in plan.getClass().getName() else plan
    leaves, rows = plan.collectLeaves(), 0
    for at in range(leaves.size()):
        metric = leaves.apply(at).metrics().get("numOutputRows")
        rows += metric.get().value() if metric.isDefined() else 0
    return rows


def test_row_groups_without_a_matched_message_are_not_read(spark, tmp_path):
    """Messages are all different and mixed, so that only Bloom filters can tell the files apart."""
    from timberline.plans.search import _any_of
    from timberline.sinks.tables import write_logs

    rows = [_entry(n, message=hashlib.md5(str(n).encode()).hexdigest()) for n in range(40_000)]
    write_logs(spark.createDataFrame(rows, LOG_ENTRIES).repartition(20, "line_id"), str(tmp_path / "log_entries"))
    logs = Tables(spark, str(tmp_path)).logs()
    wanted = [rows[n][LOG_ENTRIES.names.index("normalized_message")] for n in (7, 30_000)]
    assert logs.where(_any_of("normalized_message", wanted)).count() == 2
    assert scanned_rows(logs.where(_any_of("normalized_message", wanted))) <= 3 * 2200
    absent = [hashlib.md5(f"no{n}".encode()).hexdigest() for n in range(25)]
    assert scanned_rows(logs.where(_any_of("normalized_message", absent))) < 20_000
    assert scanned_rows(logs.where(_any_of("id", [7, 30_000]))) <= 3 * 2200
    assert scanned_rows(logs) == 40_000


def test_vectors_of_another_length_are_refused(spark, tmp_path):
    target = Tables(spark, str(tmp_path))
    templates = spark.createDataFrame([("E1", "t", 1)], EVENT_TEMPLATES)
    load(spark.createDataFrame([_entry(1, message="a"), _entry(2, message="b")], LOG_ENTRIES), templates, target)
    vectorise(target, ENCODER, limit=1)
    with pytest.raises(ContractViolation, match="16 elements"):
        vectorise(target, HashingEncoder(32))
    assert target.vectors().count() == 1


def test_refresh_replaces_counts_and_indexes(spark, tmp_path):
    target = Tables(spark, str(tmp_path))
    templates = spark.createDataFrame([("E1", "t", 1)], EVENT_TEMPLATES)
    load(spark.createDataFrame([_entry(n, message="ab"[n % 2]) for n in range(1, 8)], LOG_ENTRIES), templates, target)
    vectorise(target, ENCODER)
    index_vectors(target)
    load(spark.createDataFrame([_entry(20, message="c"), _entry(21, message="a")], LOG_ENTRIES), templates.where("false"), target, reset=False)
    vectorise(target, ENCODER)
    assert sorted(r.normalized_message for r in target.read(INDEX).collect()) == ["a", "b", "c"]
    changed = target.vectors().where("normalized_message = 'a'").withColumn("representative_level", F.lit("NEW"))
    later = changed.withColumn("updated_at", F.lit("2124-01-01 00:00:00").cast("timestamp_ntz"))
    assert refresh_vectors(target, later, ENCODER) == 3
    rows = {r.normalized_message: (r.representative_level, r.occurrences) for r in target.vectors().collect()}
    assert rows == {"a": ("NEW", 4), "b": ("INFO", 4), "c": ("INFO", 1)}
    assert target.read(INDEX).count() == 3
    double = later.unionAll(later).withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    with pytest.raises(ContractViolation):
        refresh_vectors(target, double, ENCODER)
    assert target.vectors().count() == 3


def test_a_full_run_leaves_no_intermediate_tables(spark, inputs, tmp_path, monkeypatch):
    from timberline import session

    folder = tmp_path / "shared"
    folder.mkdir()
    monkeypatch.setattr(session, "_root", lambda spark: str(folder))
    run_all(spark, inputs[1], str(tmp_path / "run"), ENCODER)
    assert [path for path in folder.rglob("*") if path.is_file()] == []
