"""Top rows per group that stay balanced when one group holds most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# First-round parts of a group: the second round sees at most this many times the limit.
GROUP_PARTS = 64


def top_per_group(
    rows: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    limit: int,
    rank: str = "rank",
    parts: int = GROUP_PARTS,
) -> DataFrame:
    """The first ``limit`` rows of every group by ``order``, with their 1-based rank.

    Every task keeps its own first rows per group (Spark's window group limit). The survivors of
    many tasks meet in ``parts`` parts per group, and only the first rows of the parts meet in one
    place, so no task receives a large group. ``order`` must be total within a group.
    """
    # Tasks, not rows, are spread over the parts: a task then still sends one limit per group.
    part = F.pmod(F.spark_partition_id(), F.lit(parts))
    by_part = Window.partitionBy(*group, "_part").orderBy(*order)
    by_group = Window.partitionBy(*group).orderBy(*order)
    return (
        rows.withColumn("_part", part)
        .withColumn("_place", F.row_number().over(by_part))
        .where(F.col("_place") <= limit)
        .drop("_part", "_place")
        .withColumn(rank, F.row_number().over(by_group).cast("bigint"))
        .where(F.col(rank) <= limit)
    )


def in_time_order() -> list[Column]:
    return [F.asc_nulls_last("log_timestamp"), F.asc("line_id")]
