"""All registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

# Importing a module registers its queries.
from checks import (  # noqa: F401
    reading,
    trends,
    keywords,
    contract_checks,
    messages,
    searches,
    evaluations,
    reports,
    stored_reports,
)
from checks.registry import CATALOG

__all__ = ["CATALOG"]
