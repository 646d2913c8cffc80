"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timberline.llm.tables import settled

WORD = "[^\\x20\\x09-\\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
BINS = 4096
SEED = "mix-1"


def letter_share(text: str = "text") -> Column:
    """A quality weight between 0.1 and 1: the share of letters among the characters of a text."""
    value = F.coalesce(F.col(text), F.lit(""))
    letters = F.char_length(F.regexp_replace(value, "[^\\p{L}]+", ""))
    return F.lit(0.1) + F.lit(0.9) * letters / F.greatest(F.char_length(value), F.lit(1))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """Adds weight and target to rows of (source, source_size), one per source.

    The sum of all sizes is shared by weight; a target stops at ``most_epochs`` times its source, and
    the excess is shared again until none is above. The level at which this ends is found in one
    sorted pass: sources are capped in the order of cap to weight, and the level is the share per weight
    at the first source that it does not lift above its cap, where it is highest.
    """
    numbered = sizes.withColumn(
        "_number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    )
    weighted = numbered.select(
        "source",
        "source_size",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("_number") - 1, F.lit(len(weights))) + 1
        ).alias("weight"),
        (F.lit(most_epochs) * F.col("source_size")).alias("_cap"),
    )
    by_cap = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    capped_before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    everyone = Window.partitionBy()
    level = (F.col("_total") - F.col("_capped")) / F.col("_open")
    return (
        weighted.select(
            "*",
            F.sum("source_size").over(everyone).alias("_total"),
            F.coalesce(F.sum("_cap").over(capped_before), F.lit(0)).alias("_capped"),
            (
                F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(capped_before), F.lit(0.0))
            ).alias("_open"),
        )
        .withColumn(
            "_level", F.max(F.when(F.col("_cap") >= level * F.col("weight"), level)).over(everyone)
        )
        .select(
            "source",
            "source_size",
            "weight",
            F.least(F.col("_cap").cast("double"), F.coalesce(F.col("_level"), level) * F.col("weight")).alias(
                "target"
            ),
        )
    )


def mixed_documents(
    docs: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: Column | None = None,
    weights: Sequence[int] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    bins: int = BINS,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: identifier, source, size, source_size, target, epochs, taken.

    ``taken`` is the number of words that the mix takes of a document: each source first gives all its
    documents in complete epochs, and the rest of its target is a weighted sample without
    replacement. Its keys are exponential variables divided by the document's quality weight; sorted
    by key, documents are taken while the middle of a document lies within the rest of the target, so
    a source misses its target by half a document at most.

    The sizes are summed up in two levels: by bins of the key, then inside a bin. So a source with any
    share of the rows is sorted in ``bins`` groups. Only the table of sources is sorted in one task.

    Null text has size 0; a null source is a source of its own, the last one. Keys come from a hash of
    identifier and text, so reruns agree and rows that agree in both share a key. Documents without
    words are taken 0 times. An empty table gives an empty one. Of other columns only those in
    ``keep`` are passed on.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    digest = F.md5(
        F.concat_ws("|", F.lit(seed), F.coalesce(F.col(identifier).cast("string"), F.lit("")), value).cast("binary")
    )
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    rows = docs.select(
        *[F.col(name).alias(f"_kept_{name}") for name in keep],
        F.col(identifier).alias("_id"),
        F.col(source).alias("source"),
        F.regexp_count(value, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform) / (letter_share(text) if quality is None else quality)).alias("_order"),
    )
    rows = settled(rows, "mix-rows").withColumn(
        "_bin", F.floor((1 - F.exp(-F.col("_order"))) * (bins - 1)).cast("int")
    )
    targets = source_targets(
        rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most_epochs
    )
    targets = targets.withColumn(
        "epochs",
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"),
    ).withColumn("_rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    in_order = Window.partitionBy("source").orderBy("_bin")
    binned = (
        rows.groupBy("source", "_bin")
        .agg(F.sum("size").alias("_bin_size"))
        .select(
            "source",
            "_bin",
            (F.sum("_bin_size").over(in_order) - F.col("_bin_size")).alias("_before"),
        )
    )
    binned = binned.alias("b").join(
        targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))
    ).select("b.*", "source_size", "target", "epochs", "_rest")
    inside = Window.partitionBy("_r._bin", "_r.source").orderBy("_order", "_id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    placed = rows.alias("_r").join(
        binned.alias("_b"),
        (F.col("_r._bin") == F.col("_b._bin")) & F.col("_r.source").eqNullSafe(F.col("_b.source")),
    )
    reached = F.col("_before") + F.sum("size").over(inside)
    return placed.select(
        *[F.col(f"_kept_{name}").alias(name) for name in keep if name not in (identifier, source)],
        F.col("_id").alias(identifier),
        F.col("_r.source").alias(source),
        "size",
        "source_size",
        "target",
        "epochs",
        (
            F.col("epochs") * F.col("size")
            + F.when(reached - F.col("size") / 2 <= F.col("_rest"), F.col("size")).otherwise(0)
        ).cast("long").alias("taken"),
    )
