"""Syslog lines to typed columns: prefix fields, event time, severity, normalised message."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from timberline.fixed_values import DEFAULT_LEVEL, LOG_YEAR, MONTHS, SEVERITY_MARKERS, SYSLOG_PREFIX

PREFIX_FIELDS = ("month", "day", "time_text", "host", "service", "process_id", "content")
# A matching line holds no line feed, so it separates the fields without ambiguity.
_SPLIT_MATCH = "\n".join(f"${n}" for n in range(1, len(PREFIX_FIELDS) + 1)) + "\n"


def prefix_parts(line: Column) -> Column:
    """All prefix fields of a line as one array, or an array of one element without a match.

    One pass of the pattern yields all seven fields; ``regexp_extract`` would run it once per field.
    A text source never gives a line feed; a row from elsewhere that holds one matches nothing, since
    it is no single line.
    """
    parts = F.split(F.regexp_replace(line, SYSLOG_PREFIX, _SPLIT_MATCH), "\n", len(PREFIX_FIELDS) + 1)
    return F.when(F.contains(line, F.lit("\n")), F.array(line)).otherwise(parts)


def prefix_field(parts: Column, name: str) -> Column:
    """One text field out of ``prefix_parts``; NULL when the line did not match or it is empty."""
    value = F.get(parts, PREFIX_FIELDS.index(name))
    return F.when((F.size(parts) > 1) & (value != ""), value)


def month_number(month: Column) -> Column:
    pairs = [part for n, name in enumerate(MONTHS, 1) for part in (F.lit(name), F.lit(n))]
    return F.create_map(*pairs)[month]


def event_time(month: Column, day: Column, time_text: Column, year: int = LOG_YEAR) -> Column:
    """Zone-free event time; NULL for an impossible date or time instead of an error."""
    hour, minute, second = (F.substr(time_text, F.lit(at), F.lit(2)).try_cast("int") for at in (1, 4, 7))
    # Second 60 would roll over into the next minute, while a clock text may not hold it.
    return F.when(
        second < 60,
        F.try_make_timestamp_ntz(
            F.lit(year), month_number(month), day, hour, minute, second.cast("decimal(16,6)")
        ),
    )


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, r"\s+", " ")


def marker_text(message: Column, collapse: bool = False) -> Column:
    """The text in which severity markers are looked up.

    ``collapse`` joins runs of white space first, so that a doubled space cannot hide a marker.
    """
    return F.lower(F.trim(collapse_spaces(message)) if collapse else message)


def severity(marker_text: Column) -> Column:
    """First level whose markers occur in the text."""
    matches = []
    for level, markers in SEVERITY_MARKERS:
        found = reduce(Column.__or__, [F.contains(marker_text, F.lit(marker)) for marker in markers])
        matches.append(F.when(found, F.lit(level)))
    return F.coalesce(*matches, F.lit(DEFAULT_LEVEL))


def normalized(message: Column, strip: bool = False) -> Column:
    """Lower-case message with single spaces, the key under which vectors are stored."""
    text = collapse_spaces(message)
    return F.lower(F.trim(text) if strip else text)
