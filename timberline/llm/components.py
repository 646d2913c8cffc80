"""Connected components of a table of links, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.tables import settled


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) that is not itself its smallest reachable node.

    Nodes are of any type that can be ordered. Links, components and nodes stay in tables: a step
    hangs the neighbours of each node on its smallest one, first the larger neighbours, then the
    smaller ones, until nothing moves. Rounds grow with the logarithm of the longest path. Links that
    repeat, point both ways or lead back to their node are allowed; null ends are left out.
    """
    current = settled(
        links.where("a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    before = _signature(current)
    while before[0]:
        current = settled(_small_star(_large_star(current)), "links")
        after = _signature(current)
        if after == before:
            break
        before = after
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("v", "u"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    near = both.join(least, "u").where("v > u")
    return near.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", "m")).distinct()
