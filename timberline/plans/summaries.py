"""Stored summaries of the log table: small tables that each load extends, so that reports read no logs.

Two are kept. Messages have their lines, levels and times, from which come level sets, distinct messages,
frequent groups and the table's statistics. Hours have their lines per event and level and sketches of
their distinct messages and hosts, from which come timelines. Counts add up and sketches unite, so a load
summarises its own lines only; a reader adds up the parts of all loads.

Summaries change together with the logs, in one manifest. Tables whose logs were stored without any are
summarised from their logs when read, and wholly at the next load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from timberline.operators import rollups
from timberline.sinks.changes import Change
from timberline.sources.tables import HOURS, LOGS, MESSAGES, Tables

# Parts of loads that a summary may consist of before a load writes it anew as one.
MOST_PARTS = 16
SUMMARIES = {
    MESSAGES: (rollups.message_summary, rollups.merged_message_summaries),
    HOURS: (rollups.hour_summary, rollups.merged_hour_summaries),
}


def _summary(tables: Tables, name: str) -> DataFrame:
    summarise, merge = SUMMARIES[name]
    manifest = tables.manifest()
    if manifest is None or name not in manifest.tables:
        return summarise(tables.read(LOGS))
    return merge(tables.read(name))


def messages(tables: Tables) -> DataFrame:
    """The message summary of all stored lines, one row per message, event id, level and template."""
    return _summary(tables, MESSAGES)


def hours(tables: Tables) -> DataFrame:
    """The hour summary of all stored lines, one row per hour, event id and level."""
    return _summary(tables, HOURS)


def level_sets(tables: Tables) -> DataFrame:
    """The levels that each stored message occurs at, for searches that name a level."""
    return rollups.counted_levels(messages(tables))


def extend(change: Change, loaded: list[str]) -> None:
    """Adds to both summaries what a change has loaded into the log table, in the given folders of it."""
    for name, (summarise, merge) in SUMMARIES.items():
        known = name in change.tables
        rows = summarise(change.read(LOGS, loaded if known else None))
        if len(change.tables.get(name, {}).get("", [])) >= MOST_PARTS:
            rows = merge(change.read(name).unionByName(rows))
            change.clear(name)
        change.add(name, rows)
