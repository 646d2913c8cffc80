"""Exact duplicates by a content sort, in DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from timberline.llm.tables import settled, shuffle_parts

WHITE_SPACE = "[\\x20\\x09-\\x0D]+"
PREFIX_LENGTH = 64
# Ranges per shuffle partition, sampled rows per range, and splitters that are looked at together.
RANGES_PER_PART, SAMPLED_PER_RANGE, SPLITTERS_AT_ONCE = 4, 30, 32


def exact_groups(
    docs: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    prefix_length: int = PREFIX_LENGTH,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: identifier, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after white space is deleted. Of equal texts the row with the most
    code points in its original text stays, then the one with the smallest identifier.

    Rows are put in order of their normalised text (its leading characters, then a 256-bit digest, to
    keep splitters short), and of what decides who stays. Splitters from a sample of rows cut that
    order into ranges. Within a range an external sort places equal texts next to each other, and
    neighbours are compared in full. Only a text that a splitter falls into can lie in two ranges: its
    parts, one row per range, are joined up by their texts. So copies of one text, however many, are
    dealt over as many ranges as the sample gives them.

    Null text counts as empty, and empty texts are equal to each other. A null identifier comes after
    all others; keep_id is null only if all identifiers of a group are. Of rows that agree in all, one
    stays. Identifiers may be of any type that can be ordered. An empty table gives an empty one. Of
    other columns those in ``keep`` are passed on; the rest are ignored, whatever their names.
    """
    carried = [f"_kept_{name}" for name in keep]
    passed = [F.col(name).alias(f"_kept_{name}") for name in keep]
    source = docs.select(*passed, F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    ranges = shuffle_parts(docs) * RANGES_PER_PART
    splitters = _splitters(source, ranges, prefix_length)
    placed = _placed(_normal(source, prefix_length), splitters, prefix_length)
    key = ["_range", "_prefix", "_digest", "_normal"]
    order = Window.partitionBy(*key).orderBy(F.col("_less"), F.col("_none"), F.col("_id"))
    whole_run = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = settled(
        placed.repartition(shuffle_parts(docs), "_range").select(
            *carried,
            "_id",
            "_range",
            "_digest",
            "_cut",
            F.row_number().over(order).alias("_rank"),
            F.first("_less").over(whole_run).alias("_best_less"),
            F.first("_id").over(whole_run).alias("_best_id"),
            F.count(F.lit(1)).over(whole_run).alias("_count"),
            F.when(F.col("_cut"), F.col("_normal")).alias("_cut_text"),
        ),
        "exact-rows",
    )
    best = F.struct(
        F.col("_best_less").alias("less"),
        F.col("_best_id").isNull().alias("none"),
        F.col("_best_id").alias("id"),
        F.col("_range").alias("range"),
    )
    # One row per range that such a text lies in: no more than twice the splitters.
    parts = rows.where("_cut and _rank = 1").select("_range", "_digest", "_cut_text", best.alias("_best"), "_count")
    texts = parts.groupBy("_cut_text").agg(F.min("_best").alias("_keep"), F.sum("_count").alias("_size"))
    joined = parts.select("_range", "_digest", "_cut_text").join(texts, "_cut_text").drop("_cut_text")
    return rows.join(F.broadcast(joined), ["_range", "_digest"], "left").select(
        *[F.col(f"_kept_{name}").alias(name) for name in keep],
        F.col("_id").alias(identifier),
        F.when(F.col("_cut"), F.col("_keep.id")).otherwise(F.col("_best_id")).alias("keep_id"),
        F.when(F.col("_cut"), F.col("_size")).otherwise(F.col("_count")).alias("group_size"),
        ((F.col("_rank") == 1) & (~F.col("_cut") | (F.col("_keep.range") == F.col("_range")))).alias("kept"),
        F.lower(F.hex("_digest")).alias("text_sha256"),
    )


def _normal(source: DataFrame, prefix_length: int) -> DataFrame:
    """The normalised text, and the fields that order rows: text first, then who stays."""
    whole = F.coalesce(F.col("_text"), F.lit(""))
    return (
        source.withColumns(
            {
                "_less": -F.char_length(whole),
                "_none": F.col("_id").isNull(),
                "_normal": F.regexp_replace(whole, WHITE_SPACE, ""),
                # Rows that agree in all are told apart, so that splitters can part them, too.
                "_tie": F.xxhash64(F.monotonically_increasing_id()),
            }
        )
        .drop("_text")
        .withColumns(
            {
                "_prefix": F.substring("_normal", 1, prefix_length),
                "_digest": F.unhex(F.sha2(F.col("_normal").cast("binary"), 256)),
            }
        )
    )


ORDER = ("_prefix", "_digest", "_less", "_none", "_id", "_tie")


def _splitters(source: DataFrame, ranges: int, prefix_length: int) -> list[Row]:
    """Rows of a sample, of a size that depends on the number of ranges alone, at even distances."""
    wanted = ranges * SAMPLED_PER_RANGE
    share = min(1.0, wanted / max(1, source.count()))
    sampled = _normal(source.sample(share, seed=11) if share < 1 else source, prefix_length)
    # A sample may be a little larger than asked for; beyond twice that it is cut.
    rows = sampled.select(*ORDER).limit(2 * wanted).orderBy(*ORDER).collect()
    return [rows[at * len(rows) // ranges] for at in range(1, ranges)] if len(rows) > 1 else []


def _placed(normal: DataFrame, splitters: list[Row], prefix_length: int) -> DataFrame:
    """Adds ``_range``, the number of splitters up to a row, and whether one of them falls into its text."""
    types = {name: normal.schema[name].dataType for name in ORDER}

    def literal(row: Row, names: Sequence[str]) -> Column:
        return F.struct(*[F.lit(row[name]).cast(types[name]).alias(name) for name in names])

    if not splitters:
        return normal.withColumns({"_range": F.lit(0), "_cut": F.lit(False)})
    key = F.struct(*ORDER)
    groups = F.array(*[literal(row, ORDER) for row in splitters[SPLITTERS_AT_ONCE - 1 :: SPLITTERS_AT_ONCE]])
    all_splitters = F.array(*[literal(row, ORDER) for row in splitters])
    before = lambda some: F.size(F.filter(some, lambda splitter: splitter <= key))
    first = before(groups) * SPLITTERS_AT_ONCE if len(splitters) >= SPLITTERS_AT_ONCE else F.lit(0)
    texts = sorted({bytes(row["_digest"]) for row in splitters})
    return (
        normal.withColumn("_first", first)
        .withColumn("_range", F.col("_first") + before(F.slice(all_splitters, F.col("_first") + 1, SPLITTERS_AT_ONCE)))
        .withColumn("_cut", F.col("_digest").isin(*[F.lit(digest) for digest in texts]))
        .drop("_first")
    )
