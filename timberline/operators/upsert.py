"""Keyed insert-or-replace on plain Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def newest_per_key(rows: DataFrame, key: str, version: str) -> DataFrame:
    """One row per key, the one with the highest version; combined per task before the shuffle."""
    payload = F.struct(*[F.col(name) for name in rows.columns])
    return (
        rows.groupBy(key)
        .agg(F.max_by(payload, F.col(version)).alias("_row"))
        .select("_row.*")
    )


def upsert(stored: DataFrame, changes: DataFrame, key: str, version: str) -> DataFrame:
    """Stored rows whose key is not changed, plus the newest change of every key.

    All payload columns of a changed key are replaced. The result goes to a fresh folder, since a
    Parquet table cannot be overwritten while it is read.
    """
    newest = newest_per_key(changes, key, version)
    kept = stored.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest)
