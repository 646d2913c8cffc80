"""How filters interact: what each removes, at every step of every order, from wide packed counters."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_BREAK = "[\\x20\\x09-\\x0D]+"
COUNTERS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
NULL_IDENTIFIER_PARTS = 64


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails the filters A to D; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(whole, WORD_BREAK), lambda word: word != "")
    count, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    length = F.char_length(whole).cast("long")
    capitals = length - F.char_length(F.regexp_replace(whole, "[A-Z]+", ""))
    return {
        "A": count < 200,
        "B": 100 * distinct < 50 * count,
        "C": 100 * capitals > 2 * length,
        "D": whole.rlike("[#$%&*|]"),
    }


def _bits(failures: Mapping[str, Column]) -> Column:
    """One bit per failed filter, the first filter lowest."""
    bits = [F.when(failed, 1 << at).otherwise(0) for at, failed in enumerate(failures.values())]
    return sum(bits[1:], bits[0]).cast("int")


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column],
    identifier: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """Rows per part, mask of failed filters, good and toxic: ``part, mask, good, toxic, n``.

    The filters are those of ``failures``, conditions on the columns of ``docs``, and one more, the
    highest bit: the text is identical to that of a row with a smaller identifier, in any part.

    Equal texts have equal masks but for the last bit, so texts are known by a 256-bit digest and rows
    are counted per digest, part and labels before they meet: a text that a third of all rows share is a
    few rows per task. Null parts count as empty, null texts too. A null identifier is smaller than
    none and greater than none, and has no label. A label that is repeated counts if one of its rows
    says so.
    """
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(identifier).alias("_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(whole, 256)).alias("_digest"),
        _bits(failures).alias("_mask"),
    )
    # Rows without an identifier meet no label; spread, they do not all go to one task.
    spread = F.when(F.col("_id").isNull(), F.pmod(F.xxhash64("_digest"), F.lit(NULL_IDENTIFIER_PARTS))).otherwise(0)
    marks = (
        labels.where(F.col(identifier).isNotNull())
        .groupBy(F.col(identifier).alias("_id"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
        .withColumn("_spread", F.lit(0).cast("long"))
    )
    by_text = ["_digest", "part", "_mask", "good", "toxic"]
    marked = (
        rows.groupBy("_id", "part", "_digest", "_mask")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_spread", spread.cast("long"))
        .join(marks, ["_id", "_spread"], "left")
        .select(
            "_id", "part", "_digest", "_mask", "_n", *[F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
        )
    )
    smallest = F.min(F.when(F.col("_id").isNotNull(), F.struct(F.col("_id").alias("id"), F.col("_n").alias("n"))))
    groups = marked.groupBy(*by_text).agg(
        F.sum("_n").alias("_n"),
        F.sum(F.when(F.col("_id").isNull(), F.col("_n")).otherwise(0)).alias("_unnamed"),
        smallest.alias("_least"),
    )
    least = groups.groupBy("_digest").agg(F.min("_least.id").alias("_first"))
    # Rows with the smallest identifier of their text, and rows without one, are no copies of it.
    original = F.col("_unnamed") + F.when(F.col("_least.id") == F.col("_first"), F.col("_least.n")).otherwise(0)
    counted = groups.join(least, "_digest").withColumn("_original", original)
    copy = 1 << len(failures)
    cases = F.array(
        F.struct(F.col("_mask").alias("mask"), F.col("_original").alias("n")),
        F.struct((F.col("_mask") + copy).alias("mask"), (F.col("_n") - F.col("_original")).alias("n")),
    )
    return (
        counted.select("part", "good", "toxic", F.inline(cases))
        .where("n > 0")
        .groupBy("part", "mask", "good", "toxic")
        .agg(F.sum("n").alias("n"))
    )


class PackedCounters:
    """All counters of all steps of all orders as fields of one integer.

    A case (a mask of failed filters, good, toxic) is an integer that holds 1 in the field of each
    counter it adds to. Cases times their numbers of rows are summed as whole integers, and a field is
    wide enough for the sum of all rows, so none runs over into its neighbour.
    """

    def __init__(self, filters: str, rows: int):
        self.filters = filters
        self.width = max(1, rows.bit_length())
        self.orders = ["".join(order) for order in permutations(filters)]
        self.steps = [(order, step) for order in self.orders for step in range(len(filters))]

    def packed(self, mask: int, good: bool, toxic: bool) -> int:
        fails = {name for at, name in enumerate(self.filters) if mask >> at & 1}
        fields = []
        for order, step in self.steps:
            name, earlier = order[step], not fails.isdisjoint(order[:step])
            removed = name in fails and not earlier
            fields += [
                not earlier and not removed,
                removed,
                name in fails and earlier,
                fails == {name},
                removed and good,
                removed and toxic,
            ]
        places = (format(int(field), f"0{self.width}b") for field in reversed(fields))
        return int("".join(places), 2)

    def unpacked(self, total: int) -> list[tuple[str, int, list[int]]]:
        """Order, step and the counters, for every step of every order."""
        count = len(self.steps) * len(COUNTERS)
        digits = format(total, f"0{count * self.width}b")
        fields = [int(digits[at : at + self.width], 2) for at in range(0, len(digits), self.width)][::-1]
        size = len(COUNTERS)
        return [(order, step, fields[at * size : (at + 1) * size]) for at, (order, step) in enumerate(self.steps)]


RESULT = "part string, filter_order string, step int, " + ", ".join(f"{name} long" for name in (*COUNTERS, "shapley"))


def _audited(filters: str, rows: int):
    counters = PackedCounters(filters, rows)
    known: dict[tuple[int, bool, bool], int] = {}

    def packed(*case) -> int:
        if case not in known:
            known[case] = counters.packed(*case)
        return known[case]

    def audit(cases: pd.DataFrame) -> pd.DataFrame:
        listed = zip(cases["mask"].tolist(), cases["good"].tolist(), cases["toxic"].tolist(), cases["n"].tolist())
        steps = counters.unpacked(sum(packed(mask, good, toxic) * n for mask, good, toxic, n in listed))
        shares = dict.fromkeys(filters, 0)
        for order, step, values in steps:
            shares[order[step]] += values[COUNTERS.index("removed")]
        found = pd.DataFrame(
            [(order, step + 1, *values, shares[order[step]]) for order, step, values in steps],
            columns=["filter_order", "step", *COUNTERS, "shapley"],
        )
        found.insert(0, "part", cases["part"].iloc[0])
        return found

    return audit


def filter_audit(
    docs: DataFrame,
    labels: DataFrame,
    failures: Mapping[str, Column] | None = None,
    identifier: str = "doc_id",
    text: str = "text",
    part: str = "source",
) -> DataFrame:
    """Per part, order of the filters and step: how many rows stay and go, and what is lost with them.

    ``failures`` are up to four conditions named by one letter each (by default those of
    ``text_failures``); the next letter is the filter of repeated texts. Columns: part, filter_order,
    step (from 1), kept, removed, redundant (failing here, removed earlier), unique_fails (failing this
    filter only), good_lost, toxic_lost, and shapley: its filter's removed rows, summed over all orders.
    Steps at which nothing happens are listed with zeros.

    At most 128 cases of a part reach one task, however many rows it has. See ``failure_counts`` for
    nulls, empty and repeated rows; an empty table gives an empty one, parts without rows are not
    listed. Other columns are ignored, whatever their names.
    """
    failures = text_failures(F.col(text)) if failures is None else failures
    filters = "".join(failures)
    if len(set(filters)) != len(failures) or not 0 < len(failures) <= 4:
        raise ValueError("name one to four filters by one letter each")
    filters += chr(ord(max(filters)) + 1)
    counts = failure_counts(docs, labels, failures, identifier, text, part)
    return counts.groupBy("part").applyInPandas(_audited(filters, docs.count()), RESULT)
