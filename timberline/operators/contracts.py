"""Table contracts as data-quality checks: each returns one row per rule with its violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.fixed_values import SOURCE_NAME


def _report(rule: str, violations: DataFrame) -> DataFrame:
    """``violations`` holds one row with one count, which may be NULL when nothing was violated."""
    count = F.coalesce(F.col(violations.columns[0]), F.lit(0)).cast("bigint")
    return violations.select(F.lit(rule).alias("rule"), count.alias("violations"))


def duplicate_keys(table: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows; NULL keys do not count."""
    present = F.lit(True)
    for name in key:
        present = present & F.col(name).isNotNull()
    return table.where(present).groupBy(*key).count().where("count > 1")


def check_unique(table: DataFrame, name: str, key: Sequence[str]) -> DataFrame:
    """Violations are the rows beyond the first of every key."""
    surplus = duplicate_keys(table, key).agg(F.sum(F.col("count") - 1))
    return _report(f"{name}.{','.join(key)} unique", surplus)


def check_new_keys(table: DataFrame, name: str, key: str, stored: DataFrame) -> DataFrame:
    """Violations are rows whose key is stored already.

    Only the stored key range that the new rows span is read: a batch of later lines touches few of
    the stored files, thanks to their min/max statistics.
    """
    span = table.agg(F.min(key).alias("low"), F.max(key).alias("high")).first()
    # An empty batch spans nothing.
    inside = F.lit(False) if span.low is None else F.col(key).between(span.low, span.high)
    known = stored.where(inside).select(key)
    return _report(f"{name}.{key} new", table.join(known, key, "left_semi").agg(F.count(F.lit(1))))


def check_not_null(table: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """All columns in one pass over the table."""
    counts = table.agg(*[F.count_if(F.col(column).isNull()).alias(column) for column in columns])
    # One row of counts, turned into one row per column.
    rules = [
        F.struct(F.lit(f"{name}.{column} not null").alias("rule"), F.col(column).alias("violations"))
        for column in columns
    ]
    return counts.select(F.inline(F.array(*rules)))


def orphan_keys(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null keys of the child without a parent, with their number of child rows.

    The child is counted per key before the join, so a key that owns most rows costs one row.
    """
    counted = child.where(F.col(key).isNotNull()).groupBy(key).count()
    parents = parent.select(F.col(parent_key).alias(key))
    return counted.join(parents, key, "left_anti")


def check_reference(
    child: DataFrame, name: str, key: str, parent: DataFrame, parent_name: str, parent_key: str
) -> DataFrame:
    orphans = orphan_keys(child, key, parent, parent_key).agg(F.sum("count"))
    return _report(f"{name}.{key} references {parent_name}.{parent_key}", orphans)


def check_dimension(vectors: DataFrame, name: str, column: str, dimension: int) -> DataFrame:
    """Vectors of another length; a missing vector is left to ``check_not_null``."""
    wrong = vectors.agg(F.count_if(F.size(column) != dimension))
    return _report(f"{name}.{column} has {dimension} elements", wrong)


def with_log_defaults(logs: DataFrame) -> DataFrame:
    """Stored defaults of the log table: source name, row id and load time."""
    columns = logs.columns
    source = F.coalesce("source", F.lit(SOURCE_NAME)) if "source" in columns else F.lit(SOURCE_NAME)
    row_id: Column = F.coalesce("id", "line_id") if "id" in columns else F.col("line_id")
    return logs.withColumns(
        {"source": source, "id": row_id, "inserted_at": F.current_timestamp().cast("timestamp_ntz")}
    )


def with_template_defaults(templates: DataFrame) -> DataFrame:
    return templates.withColumn("occurrences", F.coalesce("occurrences", F.lit(0)))

