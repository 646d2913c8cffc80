"""All queries of this subpackage; importing the modules registers them."""

from __future__ import annotations

from timberline.llm import (  # noqa: F401
    audit_queries,
    dedup_queries,
    embedding_queries,
    language_queries,
    lexical_queries,
    mix_queries,
    quality_queries,
    token_queries,
)
from timberline.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
