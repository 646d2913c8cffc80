"""How a query and its SQL are registered, and the SQL prefixes that name the derived tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from checks.fixture import DOCUMENT_CTES, LOG_CTES, LogData

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(sql: str | None = None) -> Callable[[Callable[[LogData], DataFrame]], Callable]:
    """Registers a function of the derived tables under its own name."""

    def register(build: Callable[[LogData], DataFrame]) -> Callable[[LogData], DataFrame]:
        CATALOG[build.__name__] = Entry(lambda spark, folder: build(LogData(spark, folder)), sql)
        return build

    return register


def over_logs(select: str, *more_ctes: str) -> str:
    return f"WITH {', '.join([LOG_CTES, *more_ctes])}\n{select}"


def over_documents(select: str, *more_ctes: str) -> str:
    return f"WITH {', '.join([DOCUMENT_CTES, *more_ctes])}\n{select}"
