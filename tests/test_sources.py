import pytest

from timberline.fixed_values import LOG_COLUMNS
from timberline.schemas import EVENT_TEMPLATES, LOG_ENTRIES
from timberline.sinks.tables import export_csv
from timberline.sources.delimited import event_templates, exported_table, structured_lines
from timberline.sources.tables import file_sizes
from timberline.sources.text_lines import first_lines, numbered_lines


def test_line_numbers_run_through_files_and_blocks(spark, tmp_path):
    sizes = [300, 1, 0, 777, 50]
    expected, number = {}, 0
    for at, size in enumerate(sizes):
        lines = []
        for _ in range(size):
            number += 1
            lines.append(f"line {number} " + "x" * (number % 60))
            expected[number] = lines[-1]
        (tmp_path / f"part-{at}.log").write_text("".join(f"{line}\n" for line in lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        found = numbered_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {row.line_id: row.raw_line for row in found} == expected
    assert len(found) == len(expected)


def test_limit_keeps_the_first_lines(spark):
    lines = spark.range(1, 101).withColumnRenamed("id", "line_id")
    assert first_lines(lines, 7).count() == 7
    assert first_lines(lines, None).count() == 100
    with pytest.raises(ValueError):
        first_lines(lines, 0)


def test_structured_file_is_read_by_header_with_doubled_quotes(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        'Month,LineId,Content,EventId,EventTemplate\nDec,1,"say ""hi"", x",E1,say <*>\nDec,x,plain,E2,\n'
    )
    rows = structured_lines(spark, str(tmp_path / "s.csv")).collect()
    assert rows[0].raw_message == 'say "hi", x'
    assert [row.line_id for row in rows] == [1, None]
    (tmp_path / "t.csv").write_text("EventId,EventTemplate,Occurrences\nE1,say <*>,12\nE2,b,many\n")
    templates = event_templates(spark, str(tmp_path / "t.csv")).collect()
    assert [(t.event_id, t.occurrences) for t in templates] == [("E1", 12), ("E2", None)]


def test_exported_table_comes_back(spark, tmp_path):
    rows = spark.createDataFrame(
        [(1, "OpenSSH", None, None, None, None, None, None, None, "INFO", None, 'a "b", c', "x\\y", None)],
        LOG_ENTRIES,
    )
    export_csv(rows, str(tmp_path / "out"), single_file=True)
    back = exported_table(spark, str(tmp_path / "out"), LOG_ENTRIES)
    assert back.columns == list(LOG_COLUMNS)
    assert back.collect() == rows.collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        exported_table(spark, str(tmp_path / "none"), EVENT_TEMPLATES)
    (tmp_path / "empty").mkdir()
    with pytest.raises(FileNotFoundError):
        exported_table(spark, str(tmp_path / "empty"), EVENT_TEMPLATES)


def test_file_sizes_lists_files_only(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "t"))
    sizes = file_sizes(spark, str(tmp_path / "t"))
    assert sizes.count() == 3
    assert "content" not in sizes.columns


def test_csv_keeps_outer_spaces_and_finds_columns_per_file(spark, tmp_path):

    rows = [(1, "  outer  ", " E1"), (2, 'quote " and, comma', "\ttab\t"), (3, None, "x")]
    table = spark.createDataFrame(rows, "line_id bigint, raw_message string, event_id string")
    export_csv(table, str(tmp_path / "csv"))
    back = exported_table(spark, str(tmp_path / "csv"), table.schema)
    assert sorted(back.collect(), key=lambda r: r.line_id) == sorted(table.collect(), key=lambda r: r.line_id)
    folder = tmp_path / "two orders"
    folder.mkdir()
    (folder / "a.csv").write_text("LineId,Content,EventId,EventTemplate\n1, one ,E1,t\n")
    (folder / "b.csv").write_text("EventId,LineId,Extra,EventTemplate,Content\nE2,2,z,u, two\n")
    found = structured_lines(spark, str(folder)).orderBy("line_id").collect()
    assert [tuple(row) for row in found] == [(1, " one ", "E1", "t"), (2, " two", "E2", "u")]
    (folder / "c.csv").write_text("LineId,Content\n3,three\n")
    with pytest.raises(Exception, match="EventId"):
        structured_lines(spark, str(folder)).collect()


def test_files_of_any_number_of_headers_are_all_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("timberline.sources.delimited.MAX_HEADERS", 2, raising=False)
    names = ["EventId", "EventTemplate", "Occurrences"]
    for at in range(9):
        more = [f"x{at}_{n}" for n in range(at)]  # extra columns of other names and another number
        header = names[at % 3 :] + names[: at % 3] + more
        fields = {"EventId": f"E{at}", "EventTemplate": f'"a, {at}"', "Occurrences": str(at)}
        line = ",".join(fields.get(name, "more") for name in header)
        (tmp_path / f"f{at}.csv").write_text(",".join(header) + "\n" + line + "\n")
    found = sorted(tuple(row) for row in event_templates(spark, str(tmp_path)).collect())
    assert found == [(f"E{at}", f"a, {at}", at) for at in range(9)]
