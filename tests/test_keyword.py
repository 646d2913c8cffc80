import re

import pytest

from timberline.operators import keyword
from timberline.operators.keyword import keyword_matches, stretches
from timberline.operators.requests import single_request, split_requests, tidy_requests, validate_requests, seed_faults
from timberline.schemas import REQUESTS
from tests.helpers import final_plan

MESSAGES = [
    "100% sure", "a_b", "axb", "back\\slash", "Failed password for U1", "", "ABC%", "abcx",
    "tab\there", "a\nb", None, "Été é É", "aXbXc",
]
TEXTS = [
    "%", "100%", "100\\%", "a_b", "a\\_b", "back\\\\slash", "back\\slash", "abc\\", "failed%u1",
    "é", "_", "s", "password", "a%b%c", "abc\\%", "é É", "x", "x",
]


def as_regex(text: str, literal: bool) -> re.Pattern:
    pattern = "%" + (re.sub(r"([%_\\])", r"\\\1", text) if literal else text) + "%"
    out, at = "", 0
    while at < len(pattern):
        if pattern[at] == "\\" and at + 1 < len(pattern):
            out += re.escape(pattern[at + 1])
            at += 2
            continue
        out += {"%": ".*", "_": "."}.get(pattern[at], re.escape(pattern[at]))
        at += 1
    return re.compile(out, re.S | re.I)


@pytest.fixture(scope="module")
def tables(spark):
    levels = ["INFO", "ERROR"]
    logs = spark.createDataFrame(
        [(at, at, text, levels[at % 2]) for at, text in enumerate(MESSAGES)],
        "id bigint, line_id bigint, raw_message string, level string",
    ).selectExpr("*", "if(id % 3 = 0, null, timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, 100 - id)) log_timestamp")
    asked = ["ALL", "ERROR", "INFO", None]
    requests = spark.createDataFrame([(at, text, asked[at % 4], 5) for at, text in enumerate(TEXTS)], REQUESTS)
    return logs.repartition(3), tidy_requests(requests)


@pytest.mark.parametrize("literal", [False, True])
@pytest.mark.parametrize("compiled, looked_up", [(100, 100), (0, 100), (0, 5)])
def test_all_forms_find_the_same(tables, literal, compiled, looked_up):
    logs, requests = tables
    expected = set()
    for row in requests.collect():
        matcher = as_regex(row.text, literal)
        for at, message in enumerate(MESSAGES):
            level = ["INFO", "ERROR"][at % 2]
            if message is not None and row.level in (None, level) and matcher.fullmatch(message):
                expected.add((row.query_id, at))
    found = keyword_matches(requests, logs, literal, compiled, looked_up).select("query_id", "line_id").collect()
    assert sorted(map(tuple, found)) == sorted(expected)


def test_no_requests(tables):
    logs, requests = tables
    for compiled in (0, 10):
        assert keyword_matches(requests.where("false"), logs, max_compiled=compiled).count() == 0


def test_stretches():
    assert stretches("%a\\%b_c%") == ["", "a%b", "c", ""]
    assert stretches("%abc\\%") == ["", "abc%"]


def test_single_request_domains(spark):
    assert single_request(spark, "x", 200, "ERROR").count() == 1
    for arguments in (("",), ("x", 0), ("x", 201), ("x", 5, "LOUD")):
        with pytest.raises(ValueError):
            single_request(spark, *arguments)


def test_request_tables_are_split(spark):
    rows = [(1, "a", None, None), (2, "", "ALL", 5), (3, "a", "ERROR", 0), (4, "a", "LOUD", 5), (5, None, None, 5), (6, " ", "", 200)]
    requests = spark.createDataFrame(rows, REQUESTS)
    accepted, refused = split_requests(requests)
    assert [(r.query_id, r.level, r.top_k) for r in accepted.collect()] == [(1, None, 20), (6, None, 200)]
    assert {r.query_id: r.reason for r in refused.collect()} == {
        2: "empty query", 3: "top_k out of range", 4: "unknown level", 5: "empty query",
    }
    seeds = spark.createDataFrame([(1, None), (0, 5), (None, 5), (3, 500)], "seed_id bigint, top_k int")
    assert [r.accepted for r in validate_requests(seeds, seed_faults()).collect()] == [True, False, False, False]


def test_many_requests_stay_in_the_jvm(tables):
    logs, requests = tables
    plan = final_plan(keyword_matches(requests, logs, max_compiled=0, first_only=True))
    assert not re.search("MapIn|EvalPython|FlatMap", plan)
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_rarest_piece_is_chosen(spark):
    lines = spark.createDataFrame([("failed password for x",), ("failed login for",), ("failed xyzzy for",)], "_lower string")
    assert keyword._rarest([["failed", "login"], ["for"]], lines, keyword._words) == ["login", "for"]
    grams = [["fai", "pas"], [""], ["z"]]
    assert keyword._rarest(grams, lines, lambda text: keyword._grams(text, [0, 1, 3])) == ["pas", "", "z"]


def test_pieces_of_stretches():
    assert keyword._pieces("for u12 from") == (True, ["u12"])
    assert keyword._pieces("ñab-c") == (True, ["ab"])
    assert keyword._pieces("password") == (False, ["pas", "ass", "ssw", "swo", "wor", "ord"])
    assert keyword._pieces("u5 ") == (False, ["u5 "]) and keyword._pieces("") == (False, [""])
    assert len(keyword._pieces("".join(map(chr, range(200, 400))))[1]) == keyword.COMPARED
    assert len(keyword._pieces(" " + " ".join(map(str, range(99))) + " ")[1]) == keyword.COMPARED


def test_long_lines_and_characters_of_four_bytes(spark):
    text = "naïve 😀😀漢字 " * 20_000 + "needle 😀é"
    logs = spark.createDataFrame([(1, 1, text, "INFO", None)], "id bigint, line_id bigint, raw_message string, level string, log_timestamp timestamp_ntz")
    requests = tidy_requests(spark.createDataFrame([(1, "DLE 😀É", None, 5), (2, "😀漢字 naïve 😀_漢", None, 5), (3, "😀é漢", None, 5), (4, "😀", "INFO", 5), (5, "字", "ERROR", 5)], REQUESTS))
    found = keyword_matches(requests, logs, max_compiled=0)
    assert sorted(r.query_id for r in found.collect()) == [1, 2, 4]


def test_a_task_keeps_the_first_lines_of_each_request(spark):
    logs = spark.range(5000).selectExpr(
        "id", "id line_id", "'same text ' || id % 7 raw_message", "'INFO' level",
        "if(id % 10 = 0, null, timestamp_ntz '2024-01-01' + make_dt_interval(0, 0, (id * 37) % 911)) log_timestamp",
    )
    requests = tidy_requests(
        spark.createDataFrame([(n, f"text {n % 7}" if n % 2 else "same%t", None, 1 + n % 9) for n in range(90)], REQUESTS)
    )
    every = keyword_matches(requests, logs, max_compiled=0)
    first = keyword_matches(requests, logs, max_compiled=0, first_only=True)
    order = "row_number() over (partition by query_id order by log_timestamp nulls last, line_id) place"
    best = lambda table: {tuple(r) for r in table.selectExpr("query_id", "id", "top_k", order).where("place <= top_k").collect()}
    assert best(first) == best(every)
    assert first.count() == sum(1 + n % 9 for n in range(90)) < every.count()
