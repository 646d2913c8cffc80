"""Keys by which results find their documents again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.session import release_shuffles, settled

__all__ = ["kept_rows", "row_key", "settled", "settled_alone", "shuffle_parts", "with_rows"]


def row_key(identifier: str = "doc_id", text: str = "text") -> Column:
    """A key that rows share only if identifier and text agree, so rows that share it get one result.

    It needs no unique identifiers: null and repeated ones are told apart by their texts.
    """
    return F.struct(
        F.xxhash64(F.col(identifier), F.col(text)).alias("a"),
        F.xxhash64(F.col(text), F.lit("key"), F.col(identifier)).alias("b"),
    )


def settled_alone(table: DataFrame, purpose: str) -> DataFrame:
    """As ``settled``, and the shuffle files behind the table go at once: for long chains of large steps."""
    written = settled(table, purpose)
    del table
    release_shuffles(written.sparkSession)
    return written


def with_rows(docs: DataFrame) -> DataFrame:
    """The rows with a number ``_row`` each, written once: all who read them see the same numbers.

    The numbers follow how files are packed into partitions, which may differ from one scan to the next.
    """
    return settled(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")


def kept_rows(docs: DataFrame, operator: Callable[..., DataFrame]) -> DataFrame:
    """The rows of a table that an operator with a column ``kept`` keeps, with all columns."""
    rows = with_rows(docs)
    kept = operator(rows, keep=("_row",)).where("kept").select("_row")
    return rows.join(kept, "_row", "left_semi").drop("_row")


def shuffle_parts(table: DataFrame) -> int:
    return int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
