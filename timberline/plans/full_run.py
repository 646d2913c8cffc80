"""The whole batch: prepare, load, vectorise, index, with step timings and an audit record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass
from datetime import datetime, timezone
from time import perf_counter
from typing import TypeVar

from pyspark.sql import SparkSession

from timberline.fixed_values import LOG_YEAR
from timberline.operators.encoders import Encoder
from timberline.plans.load import load
from timberline.plans.prepare import prepare
from timberline.plans.storage import FAILED, SUCCESS
from timberline.plans.vectorise import index_vectors, vectorise
from timberline.session import released_folders, shared_folder
from timberline.sinks.tables import append_run
from timberline.sources.tables import RUN_LOG, Tables

T = TypeVar("T")


@dataclass(frozen=True)
class Inputs:
    raw_log: str
    structured_csv: str
    templates_csv: str


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_all(
    spark: SparkSession,
    inputs: Inputs,
    target: str,
    encoder: Encoder,
    limit: int | None = None,
    year: int = LOG_YEAR,
    command: str = "run-all",
) -> dict:
    """Rebuild all tables below ``target``; a record is kept of success and of failure.

    Intermediate tables are removed when the run ends.
    """
    with released_folders(spark):
        return _run_steps(spark, inputs, target, encoder, limit, year, command)


def _run_steps(
    spark: SparkSession,
    inputs: Inputs,
    target: str,
    encoder: Encoder,
    limit: int | None,
    year: int,
    command: str,
) -> dict:
    tables = Tables(spark, target)
    started_at, start = _now(), perf_counter()
    timings: dict[str, float] = {}

    def timed(step: str, work: Callable[[], T]) -> T:
        begin = perf_counter()
        result = work()
        timings[step] = round(perf_counter() - begin, 3)
        return result

    def record(status: str, details: dict) -> None:
        append_run(spark, tables.path(RUN_LOG), command, status, started_at, _now(), details)

    try:
        staging = Tables(spark, shared_folder(spark, "prepared"))
        prepared = timed(
            "prepare_data",
            lambda: prepare(
                spark, inputs.raw_log, inputs.structured_csv, inputs.templates_csv, staging.root, limit, year
            ),
        )
        loaded = timed("load", lambda: load(staging.logs(), staging.templates(), tables))
        embedded = timed("embed", lambda: vectorise(tables, encoder))
        timed("index", lambda: index_vectors(tables))
    except Exception as error:
        timings["total_until_failure"] = round(perf_counter() - start, 3)
        record(FAILED, {"error": str(error), "timings": timings})
        raise
    timings["total"] = round(perf_counter() - start, 3)
    details = {
        "prepared": asdict(prepared),
        "loaded": asdict(loaded),
        "embedded": asdict(embedded),
        "timings": timings,
    }
    record(SUCCESS, details)
    return details
