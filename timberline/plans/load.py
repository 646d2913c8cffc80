"""Loading: prepared tables pass their contracts, then replace or extend the stored ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.operators import contracts
from timberline.plans import summaries
from timberline.sinks.changes import Change
from timberline.sinks.tables import write_logs, write_parquet
from timberline.sources.tables import HOURS, INDEX, INDEX_MODEL, LOGS, MESSAGES, RUN_LOG, SCHEMAS, TEMPLATES, VECTORS, Tables

# Everything that is loaded or derived from it.
_ALL = (LOGS, TEMPLATES, VECTORS, INDEX, INDEX_MODEL, MESSAGES, HOURS)
REQUIRED_LOG_COLUMNS = ("line_id", "source", "level", "raw_message", "normalized_message")


class ContractViolation(ValueError):
    """Raised when a load would break a table contract; the stored tables are left as they were."""


@dataclass(frozen=True)
class Loaded:
    log_entries: int
    event_templates: int


def contract_report(
    logs: DataFrame,
    templates: DataFrame,
    stored_logs: DataFrame | None = None,
    stored_templates: DataFrame | None = None,
) -> DataFrame:
    """``rule, violations`` of a load; keys must also be new with respect to the stored tables."""
    reports = [
        contracts.check_unique(logs, LOGS, ["line_id"]),
        contracts.check_unique(templates, TEMPLATES, ["event_id"]),
        contracts.check_not_null(logs, LOGS, REQUIRED_LOG_COLUMNS),
        contracts.check_not_null(templates, TEMPLATES, ["event_id", "event_template"]),
    ]
    known_templates = templates.select("event_id")
    if stored_logs is not None:
        reports.append(contracts.check_new_keys(logs, LOGS, "line_id", stored_logs))
    if stored_templates is not None:
        reports.append(contracts.check_new_keys(templates, TEMPLATES, "event_id", stored_templates))
        known_templates = known_templates.unionByName(stored_templates.select("event_id"))
    reports.append(
        contracts.check_reference(logs, LOGS, "event_id", known_templates, TEMPLATES, "event_id")
    )
    return reduce(DataFrame.unionByName, reports)


def vector_contract_report(vectors: DataFrame, dimension: int) -> DataFrame:
    reports = [
        contracts.check_unique(vectors, VECTORS, ["normalized_message"]),
        contracts.check_not_null(vectors, VECTORS, ["normalized_message", "embedding"]),
        contracts.check_dimension(vectors, VECTORS, "embedding", dimension),
    ]
    return reduce(DataFrame.unionByName, reports)


def require(report: DataFrame) -> None:
    # One row per rule: a fixed, small number.
    broken = report.where(F.col("violations") > 0).collect()
    if broken:
        raise ContractViolation("; ".join(f"{row.rule}: {row.violations}" for row in broken))


def create_empty(target: Tables) -> None:
    """Replace all stored tables, run log included, by empty ones."""
    with Change(target) as change:
        change.clear(*_ALL)
        change.buckets = 0
        change.publish()
    write_parquet(target.spark.createDataFrame([], SCHEMAS[RUN_LOG]), target.path(RUN_LOG))


def load(logs: DataFrame, templates: DataFrame, target: Tables, reset: bool = True) -> Loaded:
    """Check the contracts, then write. ``reset`` replaces both tables and empties the vectors.

    Without ``reset`` the rows are added, and keys that are already stored are refused. Either way all
    tables, summaries included, change in one step: if anything fails, readers still have the old ones,
    and the load can be tried again.
    """
    logs = contracts.with_log_defaults(logs).drop("id", "inserted_at")
    templates = contracts.with_template_defaults(templates)
    if reset:
        require(contract_report(logs, templates))
    else:
        require(contract_report(logs, templates, target.logs(), target.templates()))
    with Change(target) as change:
        if reset:
            change.clear(*_ALL)
            change.buckets = 0
        template_rows = change.add(TEMPLATES, templates)
        log_rows = change.add(LOGS, logs, write=write_logs)
        summaries.extend(change, change.tables[LOGS][""][-1:])
        change.publish()
    return Loaded(log_rows, template_rows)
