from datetime import datetime

from hypothesis import HealthCheck, given as hypothesis_given, settings, strategies as st
import pytest

from helpers import parsed
from timberline.fixed_values import LEVELS

LINE = (
    "Dec 10 06:55:48 LabSZ sshd[24200]: "
    "Failed password for invalid user webmaster from 173.234.31.186 port 38926 ssh2"
)


def test_canonical_line(spark):
    row = parsed(spark, [LINE])[1]
    assert (row.month, row.day, row.time_text, row.host) == ("Dec", 10, "06:55:48", "LabSZ")
    assert (row.service, row.process_id, row.source) == ("sshd", 24200, "OpenSSH")
    assert row.log_timestamp == datetime(2024, 12, 10, 6, 55, 48)
    assert row.raw_message.startswith("Failed password")
    assert row.level == "ERROR"


def test_message_falls_back_from_structured_to_parsed_to_whole_line(spark):
    rows = parsed(
        spark,
        [LINE, LINE, "no prefix here", ""],
        [(1, "from  the file", "E1", "From  <*> File")],
    )
    assert rows[1].raw_message == "from  the file"
    assert rows[1].normalized_message == "from <*> file"
    assert rows[2].raw_message.startswith("Failed password")
    assert rows[2].event_id is None
    assert rows[3].raw_message == "no prefix here"
    assert rows[3].month is None and rows[3].log_timestamp is None and rows[3].process_id is None
    assert rows[4].raw_message == ""


@pytest.mark.parametrize(
    "stamp, expected",
    [
        ("Feb 29 10:00:00", None),
        ("Xyz 10 10:00:00", None),
        ("Jan 10 25:00:00", None),
        ("Jan 10 10:00:60", None),
        ("Jan 32 10:00:00", None),
        ("Jan  1 00:00:00", datetime(2023, 1, 1)),
    ],
)
def test_impossible_times_are_null(spark, stamp, expected):
    row = parsed(spark, [f"{stamp} h sshd[1]: x"], year=2023)[1]
    assert row.log_timestamp == expected
    assert row.host == "h"


def test_levels_in_order_of_strength(spark):
    messages = [
        "POSSIBLE BREAK-IN ATTEMPT!",
        "Failed password for root",
        "Connection closed by host [preauth]",
        "Accepted publickey for user",
        "Disconnecting: Too many authentication failures",
        "Invalid  user bob",
    ]
    rows = parsed(spark, messages)
    assert [rows[n].level for n in range(1, 7)] == [
        "CRITICAL", "ERROR", "WARNING", "INFO", "CRITICAL", "INFO",
    ]
    collapsed = parsed(spark, messages, collapse=True)
    assert collapsed[6].level == "ERROR"


def test_normalisation_keeps_or_strips_outer_spaces(spark):
    text = "  Failed   Password\t "
    assert parsed(spark, [text])[1].normalized_message == " failed password "
    assert parsed(spark, [text], collapse=True)[1].normalized_message == "failed password"
    assert parsed(spark, ["A  B"])[1].normalized_message == "a  b"


_lines = st.lists(
    st.one_of(
        st.text(st.characters(blacklist_characters="\r\n", blacklist_categories=("Cs",)), max_size=40),
        st.builds(
            "{} {} {} h {}[{}]: {}".format,
            st.sampled_from(["Jan", "Feb", "Foo"]),
            st.integers(0, 40),
            st.sampled_from(["00:00:00", "23:59:59", "99:00:00"]),
            st.sampled_from(["sshd", " su ", "a b"]),
            st.integers(0, 10**9),
            st.sampled_from(["error", "FATAL  x", "", "preauth"]),
        ),
    ),
    max_size=8,
)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@hypothesis_given(_lines)
def test_every_line_gives_one_row_with_a_known_level(spark, lines):
    rows = parsed(spark, lines)
    assert sorted(rows) == list(range(1, len(lines) + 1))
    for row in rows.values():
        assert row.level in LEVELS
        assert row.raw_message is not None and row.normalized_message is not None
        assert "  " not in row.normalized_message


def test_a_row_with_a_line_feed_is_no_syslog_line(spark):
    found = parsed(spark, ["foo\nbar\nbaz", "Jan  1 00:00:01 h sshd[1]: a"])
    assert (found[1].month, found[1].time_text, found[1].raw_message) == (None, None, "foo\nbar\nbaz")
    assert found[2].month == "Jan"
