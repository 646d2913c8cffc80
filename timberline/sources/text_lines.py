"""Raw text lines with a 1-based line number that runs through all files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from timberline.session import shared_folder

# One row per file block is joined to the lines; up to this many rows (some 200 MB) are broadcast.
MAX_BROADCAST_BLOCKS = 1_000_000


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of all files under ``path`` as ``line_id, raw_line``, in order of file name and offset.

    A line's number is its place in its own file block plus the lines of all earlier blocks. The
    lines are first written once with their block and place, so that both passes, and any retry,
    see the same blocks even when the cluster changes size in between.
    """
    staged = shared_folder(spark, "lines")
    (
        spark.read.text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            F.col("value").alias("raw_line"),
        )
        .write.parquet(staged)
    )
    lines = spark.read.parquet(staged)

    sizes = shared_folder(spark, "blocks")
    (
        lines.groupBy("file", "block")
        .agg(F.count(F.lit(1)).alias("size"), F.min("place").alias("first_place"))
        .write.parquet(sizes)
    )
    blocks = spark.read.parquet(sizes)
    shifts = _block_shifts(blocks)
    if blocks.count() <= MAX_BROADCAST_BLOCKS:
        shifts = F.broadcast(shifts)
    return lines.join(shifts, ["file", "block"]).select(
        (F.col("place") + F.col("shift")).alias("line_id"), "raw_line"
    )


def _block_shifts(blocks: DataFrame) -> DataFrame:
    """Per block, what turns a place into a line number; work grows with blocks, not with lines."""
    start, previous = Window.unboundedPreceding, -1
    earlier_files = Window.orderBy("file").rowsBetween(start, previous)
    earlier_blocks = Window.partitionBy("file").orderBy("block").rowsBetween(start, previous)
    files = (
        blocks.groupBy("file")
        .agg(F.sum("size").alias("file_size"))
        .select("file", F.coalesce(F.sum("file_size").over(earlier_files), F.lit(0)).alias("before_file"))
    )
    before_block = F.coalesce(F.sum("size").over(earlier_blocks), F.lit(0))
    return (
        blocks.withColumn("before_block", before_block)
        .join(files, "file")
        .select(
            "file",
            "block",
            (F.col("before_file") + F.col("before_block") - F.col("first_place") + 1).alias("shift"),
        )
    )


def first_lines(lines: DataFrame, limit: int | None) -> DataFrame:
    """Lines numbered up to ``limit``; None keeps all.

    A left join on ``line_id`` passes the condition on to its other side by itself.
    """
    if limit is None:
        return lines
    if limit < 1:
        raise ValueError("limit must be at least 1")
    return lines.where(F.col("line_id") <= limit)
