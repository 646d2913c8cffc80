"""Near-duplicates by bottom-k sketches of word shingles, verified on full sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timberline.llm.components import components
from timberline.llm.tables import row_key, settled_alone
from timberline.session import named_folders, remove_folder
from timberline.llm.words import Words, chunks, lower_ascii, mixed, rolled, text_buffers, words_of


@dataclass(frozen=True)
class Nearness:
    """Parameters. ``percent``: links have 100 * intersection >= percent * union."""

    percent: int = 85
    shingle_words: int = 5
    sketch_size: int = 64
    listed_values: int = 16
    longest_list: int = 40
    least_rare: int = 13
    hot_lists: int = 10
    deviations: float = 4.0
    block_classes: int = 2500
    block_shingles: int = 1_200_000
    drawn_sets: int = 15
    broadcast_values: int = 1_000_000
    most_marks: int = 1 << 26

    @property
    def least_estimate(self) -> float:
        share = self.percent / 100
        return share - self.deviations * (share * (1 - share) / self.sketch_size) ** 0.5


def shingle_sets(words: Words, width: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row; 63 bits, so that they order alike as signed."""
    hashes = words.hashes()
    runs = rolled(hashes, width) >> np.uint64(1)
    for begin, end in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if end - begin >= width:
            yield np.unique(runs[begin : end - width + 1])
        elif end > begin:
            yield rolled(hashes[begin:end], end - begin) >> np.uint64(1)
        else:
            yield np.zeros(0, np.uint64)


def fingerprint(values: np.ndarray) -> bytes:
    """128 bits of a set: two sums of its mixed values."""
    spread = mixed(values + np.uint64(0x632BE59BD9B4E019))
    first = mixed(spread.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(values)))
    second = mixed(mixed(spread ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64, keepdims=True))
    return np.concatenate([first, second]).tobytes()


def _signer(near: Nearness, full: bool):
    """Adds to (key columns..., text) the set's size, fingerprint and sketch, or the whole set."""

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "_text"):
            data, offsets = text_buffers(chunk.column("_text"))
            words = words_of(lower_ascii(data), offsets)
            sizes, prints, kept, flat = [], [], [0], []
            for values in shingle_sets(words, near.shingle_words):
                sizes.append(len(values))
                prints.append(fingerprint(values))
                part = values if full else values[: near.sketch_size]
                flat.append(part)
                kept.append(kept[-1] + len(part))
            lists = pa.ListArray.from_arrays(
                pa.array(kept, pa.int32()), pa.array(np.concatenate(flat).view(np.int64), pa.int64())
            )
            rest = [chunk.column(name) for name in chunk.schema.names if name != "_text"]
            names = [name for name in chunk.schema.names if name != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array(sizes, pa.int64()), pa.array(prints, pa.binary()), lists],
                names=[*names, "n", "fp", "values"],
            )

    return sign


def _estimate(left: Column, right: Column, size: int) -> Column:
    """The share of the smallest values of the union that both sketches hold."""
    union = F.slice(F.array_sort(F.array_union(left, right)), 1, size)
    return F.size(F.array_intersect(union, F.array_intersect(left, right))) / F.size(union)


def _fits(near: Nearness) -> Column:
    """Whether two sets of these sizes can reach the threshold."""
    return F.least("an", "bn") * 100 >= F.greatest("an", "bn") * near.percent


def near_components(
    docs: DataFrame,
    identifier: str = "doc_id",
    text: str = "text",
    near: Nearness = Nearness(),
    keep: Sequence[str] = (),
) -> DataFrame:
    """One row per row of ``docs``: identifier, n_shingles, component_id, kept.

    A document's set holds its distinct word shingles (A-Z lower-cased); with fewer words than a
    shingle has, the whole sequence is its one shingle. Documents link when 100 * intersection is at
    least ``percent`` * union; component_id is the smallest identifier that links can reach.

    Documents with equal sets form a class first, and only classes are compared. The sketch of a class
    is the ``sketch_size`` smallest values of one hash function. Inverted lists of the smallest
    retained values give candidates, the bottom of the union of two sketches estimates their
    similarity, and candidates near or above the threshold are verified on their full sets. Two sets
    over the threshold fail to share a listed value with a chance of 0.15 to the power of
    ``listed_values``.

    Lists longer than ``longest_list`` are never expanded into pairs. A class that keeps
    ``least_rare`` values in shorter lists of two classes or more is found through those. The others, whose text is mostly
    shared by many, drop out if too many of their shingles are held by none of the others. The rest are
    compared on their full sets inside their long lists, in pairs of bounded
    blocks that return who is connected, never the pairs: first among the classes with the same
    smallest long list, then in each other long list that still holds several components, where
    classes that met before form one side and need not meet again. Candidates from short lists are
    compared only while their ends are in different components, which changes no component.

    Null and empty texts, or texts without words, have an empty set and link with nothing. Null
    identifiers count as larger than all others; a component of nulls only has component_id null and
    kept true. Rows that agree in identifier are one another's component only if their sets link.
    Rows repeated in full share their result. An empty table gives an empty one. Of other columns those
    in ``keep`` are passed on; the rest are ignored, whatever their names.
    """
    spark, carried = docs.sparkSession, [f"_kept_{name}" for name in keep]
    base = docs.select(
        *[F.col(name).alias(f"_kept_{name}") for name in keep],
        F.col(identifier).alias("_id"),
        F.col(text).alias("_text"),
    )
    types = "".join(f"{name} {base.schema[name].dataType.simpleString()}, " for name in [*carried, "_id"])
    with named_folders() as sketched:
        signed = settled_alone(
            base.select(*carried, "_id", row_key("_id", "_text").alias("_key"), "_text").mapInArrow(
                _signer(near, full=False),
                f"{types}_key struct<a:bigint,b:bigint>, n bigint, fp binary, values array<bigint>",
            ),
            "near-signatures",
        )
    with named_folders() as compared:
        sketches = settled_alone(
            signed.where("n > 0")
            .groupBy("fp")
            .agg(
                F.min("_key").alias("_key"),
                F.min("_id").alias("least_id"),
                F.first("n").alias("n"),
                F.first("values").alias("values"),
            ),
            "near-sketches",
        )
    rows = _narrowed(signed.drop("_key", "values"), "near-rows", sketched)
    with named_folders() as lists:
        listed, long = _lists(sketches, near)
        hot = settled_alone(long, "near-long-lists")
        candidates = settled_alone(_estimated(_list_pairs(listed, near), sketches, near), "near-candidates")
    remove_folder(spark, lists[0])
    classes = _narrowed(sketches.drop("values"), "near-classes", compared)
    best = Window.partitionBy("a").orderBy(F.col("estimate").desc(), "b")
    first = candidates.withColumn("_rank", F.row_number().over(best)).where("_rank = 1").drop("_rank")
    sets = _full_sets(base, classes, _ends(candidates, hot), near)
    paired, grouped = sets.where("paired"), sets.where("hot")
    hot = settled_alone(_linkable(hot, grouped, near), "near-linkable")
    start = hot.where("rank = 1").select("value", "fp", "n", F.lit(None).alias("met"))
    alike = settled_alone(_connected(start, grouped, near), "near-alike")
    links = settled_alone(_verified(first, paired, near).union(alike), "near-links")
    joined = components(links)
    members = hot.join(joined.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "value", "fp", "n", F.coalesce("root", "fp").alias("root"), F.col("first").alias("met")
    )
    apart = settled_alone(_apart(candidates, joined), "near-apart")
    more = settled_alone(_verified(apart, paired, near), "near-verified")
    rest = settled_alone(more.union(_connected(_open(members), grouped, near)).distinct(), "near-links")
    if not rest.isEmpty():
        joined = components(links.union(rest))
    rooted = classes.select("fp", "least_id").join(
        joined.select(F.col("node").alias("fp"), "root"), "fp", "left"
    ).select("fp", "least_id", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_class = rooted.join(least, "root").select("fp", "component_id")
    return rows.join(by_class, "fp", "left").select(
        *[F.col(f"_kept_{name}").alias(name) for name in keep],
        F.col("_id").alias(identifier),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("_id")).alias("component_id"),
        F.when((F.col("n") == 0) | F.col("component_id").isNull(), True)
        .otherwise(F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)))
        .alias("kept"),
    )


def _narrowed(table: DataFrame, purpose: str, folders: list[str]) -> DataFrame:
    """Some columns of a settled table, written anew; the folders of the wider one go at once."""
    written = settled_alone(table, purpose)
    for path in folders:
        remove_folder(table.sparkSession, path)
    return written


def _lists(classes: DataFrame, near: Nearness) -> tuple[DataFrame, DataFrame]:
    """Entries (value, fp, n) of short lists, and those of long ones for classes that need them."""
    entries = classes.select("fp", "n", F.explode(F.slice("values", 1, near.listed_values)).alias("value"))
    lengths = entries.groupBy("value").agg(F.count(F.lit(1)).alias("length")).where("length > 1")
    placed = settled_alone(entries.join(lengths, "value"), "near-lists")
    short = placed.where(F.col("length") <= near.longest_list)
    long = placed.where(F.col("length") > near.longest_list)
    # values that no other class has lead to none, so they do not count as rare
    is_long = F.col("length") > near.longest_list
    needy = placed.groupBy("fp").agg(F.count_if(is_long).alias("long"), F.count_if(~is_long).alias("rare")).where(
        (F.col("long") > 0) & (F.col("rare") < near.least_rare)
    )
    order = Window.partitionBy("fp").orderBy("value")
    hot = (
        long.join(needy.select("fp"), "fp", "left_semi")
        .select("value", "fp", "n", F.row_number().over(order).alias("rank"), F.first("value").over(order).alias("first"))
        .where(F.col("rank") <= near.hot_lists)
    )
    return short, hot


def _linkable(hot: DataFrame, grouped: DataFrame, near: Nearness) -> DataFrame:
    """The entries of classes that may link with another class of the long lists, whose sets are ``grouped``.

    What a class shares with one of them is at most its shingles that any of them holds as well, and the
    union is at least its own set. So a class that holds too much text of its own links with none of them.
    """
    alone = (
        grouped.select("member", F.explode("values").alias("shingle"))
        .groupBy("shingle")
        .agg(F.min("member").alias("member"), F.max("member").alias("last"))
        .where("member = last")
        .groupBy("member")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    shared = F.col("n") - F.coalesce("alone", F.lit(0))
    able = grouped.select("fp", "n", "member").join(alone, "member", "left").where(shared * 100 >= F.col("n") * near.percent)
    return hot.join(able.select("fp"), "fp", "left_semi")


def _list_pairs(listed: DataFrame, near: Nearness) -> DataFrame:
    """Pairs of classes in a short list whose sizes allow a link; the larger fingerprint first."""
    left = listed.select("value", F.col("fp").alias("a"), F.col("n").alias("an"))
    right = listed.select("value", F.col("fp").alias("b"), F.col("n").alias("bn"))
    met = left.join(right, "value").where((F.col("a") > F.col("b")) & _fits(near)).select("a", "b")
    return met.distinct()  # most pairs meet in many lists


def _estimated(pairs: DataFrame, sketches: DataFrame, near: Nearness) -> DataFrame:
    """Pairs whose sketches estimate a similarity near the threshold or above, with the estimate."""
    left = sketches.select(F.col("fp").alias("a"), F.col("n").alias("an"), F.col("values").alias("av"))
    right = sketches.select(F.col("fp").alias("b"), F.col("n").alias("bn"), F.col("values").alias("bv"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(_fits(near))
        .select("a", "b", "an", "bn", _estimate(F.col("av"), F.col("bv"), near.sketch_size).alias("estimate"))
        .where(F.col("estimate") >= near.least_estimate)
    )


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component yet."""
    left = joined.select(F.col("node").alias("a"), F.col("root").alias("ar"))
    right = joined.select(F.col("node").alias("b"), F.col("root").alias("br"))
    return (
        pairs.join(left, "a", "left")
        .join(right, "b", "left")
        .where(F.coalesce("ar", "a") != F.coalesce("br", "b"))
        .select(*pairs.columns)
    )


def _ends(candidates: DataFrame, hot: DataFrame) -> DataFrame:
    """The classes whose full sets are needed: whether for pairs, and whether for long lists."""
    yes, no = F.lit(True), F.lit(False)
    pairs = candidates.select(F.col("a").alias("fp")).union(candidates.select("b"))
    both = pairs.select("fp", yes.alias("paired"), no.alias("hot")).union(hot.select("fp", no, yes))
    return both.groupBy("fp").agg(F.max("paired").alias("paired"), F.max("hot").alias("hot"))


def _full_sets(base: DataFrame, classes: DataFrame, ends: DataFrame, near: Nearness) -> DataFrame:
    """(paired, hot, n, fp, values, member) of the classes in ``ends``, each from the text of one of its documents."""
    wanted = settled_alone(
        classes.join(ends, "fp").select("_key.a", "_key.b", "paired", "hot"), "near-wanted"
    )
    texts = base.select(row_key("_id", "_text").alias("_key"), "_text").select("_key.a", "_key.b", "_text")
    return settled_alone(
        _perhaps_wanted(texts, wanted, near.most_marks)
        .join(wanted, ["a", "b"])
        .dropDuplicates(["a", "b"])
        .select("paired", "hot", "_text")
        .mapInArrow(
            _signer(near, full=True), "paired boolean, hot boolean, n bigint, fp binary, values array<bigint>"
        )
        .withColumn("member", F.monotonically_increasing_id()),
        "near-sets",
    )


def _perhaps_wanted(texts: DataFrame, wanted: DataFrame, most_marks: int) -> DataFrame:
    """The rows whose ``a`` has its mark in a bitmap of the wanted ones, so that few other texts are shuffled.

    All wanted rows stay, and of the others those that meet a mark: with up to ``most_marks`` bits, sent
    to all tasks, 1 in 16 or fewer as long as the bits are 16 times the wanted.
    """
    bits = min(most_marks, max(1 << 15, 1 << (32 * wanted.count()).bit_length()))
    place = F.pmod("a", F.lit(bits)) + 1
    marks = F.broadcast(
        wanted.groupBy(F.bitmap_bucket_number(place).alias("_bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("_marks")
        )
    )
    met = texts.withColumn("_place", place).withColumn("_bucket", F.bitmap_bucket_number("_place")).join(marks, "_bucket")
    byte = F.conv(F.hex(F.expr("substring(_marks, cast(bitmap_bit_position(_place) div 8 as int) + 1, 1)")), 16, 10)
    return met.where(F.getbit(byte.cast("long"), F.bitmap_bit_position("_place") % 8) == 1).select(texts.columns)


def _verified(pairs: DataFrame, sets: DataFrame, near: Nearness) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("fp").alias("a"), F.col("values").alias("av"))
    right = sets.select(F.col("fp").alias("b"), F.col("values").alias("bv"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .withColumn("_shared", F.size(F.array_intersect("av", "bv")))
        .where(F.col("_shared") * 100 >= (F.col("an") + F.col("bn") - F.col("_shared")) * near.percent)
        .select("a", "b")
    )


def _open(members: DataFrame) -> DataFrame:
    """The members of lists that hold several components and several sets of classes that met."""
    lists = (
        members.groupBy("value")
        .agg(
            (F.min("root") != F.max("root")).alias("several"),
            (F.min("met") != F.max("met")).alias("apart"),
        )
        .where("several and apart")
    )
    return members.join(lists.select("value"), "value", "left_semi").select("value", "fp", "n", "met")


def _connected(members: DataFrame, sets: DataFrame, near: Nearness) -> DataFrame:
    """(a, b) that connect all linked members (value, fp, n, met) of each list.

    The most members that met form one side of a list and the others the other side, both in blocks
    of bounded size: blocks of the others meet all blocks once. Without ``met`` all meet all. What
    travels to the cells is how a set differs from its list's typical one, which is little among near
    copies, and from which the cells count the same intersections.
    """
    sizes = members.groupBy("value", "met").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("held"))
    main = F.max(F.struct(F.when(F.col("met").isNull(), 0).otherwise(F.col("size")).alias("size"), "met", "held"))
    lists = sizes.groupBy("value").agg(F.sum("size").alias("size"), F.sum("held").alias("held"), main.alias("main"))

    def blocks(size: Column, held: Column) -> Column:
        return F.ceil(F.greatest(size / near.block_classes, held / near.block_shingles)).cast("int")

    main_held = F.when(F.col("main.met").isNull(), 0).otherwise(F.col("main.held"))
    plans = lists.select(
        "value",
        F.col("main.met").alias("main"),
        blocks(F.col("size") - F.col("main.size"), F.col("held") - main_held).alias("rest_blocks"),
        blocks(F.col("main.size"), main_held).alias("main_blocks"),
    )
    placed = members.join(plans, "value").withColumn("_rest", F.col("main").isNull() | (F.col("met") != F.col("main")))
    count = F.when(F.col("_rest"), F.col("rest_blocks")).otherwise(F.col("main_blocks"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("fp", "value"), F.greatest(count, F.lit(1))).cast("int"))

    def numbers(count: Column) -> Column:
        return F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda x: x < count)

    # a cell is (block of the rest, any block); blocks of the main side are numbered after the rest's
    own = F.col("own")
    to_rest = F.transform(
        numbers(F.col("rest_blocks")), lambda x: F.struct(F.least(own, x).alias("i"), F.greatest(own, x).alias("j"))
    )
    to_main = F.transform(
        numbers(F.col("main_blocks")), lambda x: F.struct(own.alias("i"), (x + F.col("rest_blocks")).alias("j"))
    )
    from_main = F.transform(
        numbers(F.col("rest_blocks")), lambda x: F.struct(x.alias("i"), (own + F.col("rest_blocks")).alias("j"))
    )
    cells = F.when(F.col("_rest"), F.concat(to_rest, to_main)).otherwise(from_main)
    side = F.when(F.col("_rest"), own).otherwise(own + F.col("rest_blocks"))
    sides = F.col("rest_blocks") + F.col("main_blocks")
    dealt = placed.select("value", "fp", "n", side.alias("side"), sides.alias("sides"), cells.alias("cells")).where(
        F.size("cells") > 0
    )
    typical = _typical(dealt.where("sides > 1").select("value", "fp", "sides"), sets, near)
    missing = F.array_except("typical", "values")
    return (
        dealt.drop("sides")
        .join(sets.select("fp", "values"), "fp")
        .join(typical, ["value", "side"], "left")
        .withColumn("typical", F.coalesce("typical", F.array().cast("array<bigint>")))
        .select(
            "value",
            "fp",
            "n",
            "side",
            (F.size("typical") - F.size(missing)).alias("held"),
            F.concat(F.array_except("values", "typical"), missing).alias("differing"),
            F.size("typical").alias("typical"),
            "cells",
        )
        .withColumn("cell", F.explode("cells"))
        .select("value", "fp", "n", "side", "held", "typical", "differing", F.col("cell.i").alias("i"), F.col("cell.j").alias("j"))
        .groupBy("value", "i", "j")
        .applyInPandas(_cell_linker(near.percent), "a binary, b binary")
        .distinct()
    )


def _typical(members: DataFrame, sets: DataFrame, near: Nearness) -> DataFrame:
    """(value, side, typical): shingles that most of a few sets of a list hold, for each side of the list.

    Any set would do, a near one only saves space. It holds less than twice the drawn sets' mean size.
    """
    order = Window.partitionBy("value").orderBy("fp")
    drawn = (
        members.withColumn("_place", F.row_number().over(order))
        .where(F.col("_place") <= near.drawn_sets)
        .join(sets.select("fp", "values"), "fp")
    )
    counts = drawn.select("value", "sides", F.explode("values").alias("shingle")).groupBy("value", "sides", "shingle").count()
    typical = settled_alone(
        counts.where(F.col("count") * 2 > near.drawn_sets)
        .groupBy("value", "sides")
        .agg(F.collect_list("shingle").alias("typical")),
        "near-typical",
    )
    dealt = typical.select("value", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)).alias("side"), "typical")
    values = typical.agg(F.sum(F.col("sides") * F.size("typical"))).first()[0] or 0
    return F.broadcast(dealt) if values <= near.broadcast_values else dealt


def _cell_linker(percent: int, columns_at_once: int = 1024):
    def link(cell: pd.DataFrame) -> pd.DataFrame:
        """Compares two blocks and returns each member with the least one it is connected to.

        With the typical set T, two sets that hold s and t of its members share s + t - |T| values and
        as many more as their differences from T have in common.
        """
        cell = cell.sort_values("fp", kind="stable")
        values = [np.asarray(row, np.int64) for row in cell["differing"]]
        sizes, held_typical = cell["n"].to_numpy(), cell["held"].to_numpy()
        lengths = np.array([len(row) for row in values])
        flat = np.concatenate(values)
        _, column, uses = np.unique(flat, return_inverse=True, return_counts=True)
        shared = uses[column] > 1
        renumbered = np.cumsum(uses > 1) - 1
        column, row = renumbered[column[shared]], np.repeat(np.arange(len(values)), lengths)[shared]
        order = np.argsort(column, kind="stable")
        column, row = column[order], row[order]
        side = cell["side"].to_numpy()
        left, right = np.flatnonzero(side == cell["i"].iloc[0]), np.flatnonzero(side == cell["j"].iloc[0])
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": []})
        both = np.zeros((len(left), len(right)), np.float32)  # counts stay far below 2 ** 24
        count = int(uses[uses > 1].size)
        for begin in range(0, count, columns_at_once):
            x, y = np.searchsorted(column, [begin, begin + columns_at_once])
            held = np.zeros((len(values), min(columns_at_once, count - begin)), np.float32)
            held[row[x:y], column[x:y] - begin] = 1
            both += held[left] @ held[right].T
        both += (held_typical[left][:, None] + held_typical[right][None, :] - cell["typical"].iloc[0]).astype(np.float32)
        linked = both * 100 >= (sizes[left][:, None] + sizes[right][None, :] - both) * percent
        linked &= left[:, None] != right[None, :]
        label = np.arange(len(values))
        while True:
            before = label.copy()
            lowest = np.where(linked, label[left][:, None], len(values)).min(axis=0)
            label[right] = np.minimum(label[right], lowest)
            lowest = np.where(linked, label[right][None, :], len(values)).min(axis=1)
            label[left] = np.minimum(label[left], lowest)
            if (label == before).all():
                break
        names = cell["fp"].to_numpy()
        some = np.flatnonzero(label != np.arange(len(values)))
        return pd.DataFrame({"a": names[some], "b": names[label[some]]})

    return link
