"""Case-insensitive substring and wildcard matching for tables of requests.

``%`` and ``_`` in a query text act as wildcards and a backslash takes the next character as it is;
``literal`` switches all three off. Two forms give the same matches:

* a few requests become literal predicates of one scan;
* many requests are joined by what lines and patterns must share: the rarest whole word of a pattern's
  longest plain stretch, or, in a stretch without one, its rarest gram of three characters. Each line
  gives its distinct words, or grams, and the lines that share one are checked against the pattern in
  full. Requests beyond the checked size take several such joins.

Matches are keys of lines. Requests for the same pattern and level are looked up once, and where only
the first lines of each are wanted, a task of the second form keeps no more of them than that.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.operators.ranking import in_time_order, top_per_group
from timberline.session import settled

# Requests compiled into predicates, requests per join otherwise, and characters of request text
# that tasks hold in either form.
MAX_COMPILED = 64
MAX_LOOKED_UP = 20_000
MAX_SHARED_TEXT = 16_000_000
# Characters of a gram, and the words or grams of a pattern among which the rarest is sought.
GRAM, COMPARED = 3, 16
WORD_BREAK = "[^a-z0-9]+"
# Asks are ranked together with others of their size, so that a few large ones do not widen all.
LIMIT_CLASSES = (32, 1024)
KEY_COLUMNS = ("id", "line_id", "log_timestamp")


def like_pattern(text: Column, literal: bool = False) -> Column:
    """Pattern that finds the text anywhere in a line.

    Spark accepts a backslash only before a wildcard or another backslash; elsewhere it is dropped,
    which leaves the meaning as it is.
    """
    if literal:
        return F.concat(F.lit("%"), F.regexp_replace(text, r"([%_\\])", r"\\$1"), F.lit("%"))
    wrapped = F.concat(F.lit("%"), text, F.lit("%"))
    return F.regexp_replace(wrapped, r"(?s)(\\[%_\\])|\\(.)", "$1$2")


def keyword_matches(
    requests: DataFrame,
    logs: DataFrame,
    literal: bool = False,
    max_compiled: int = MAX_COMPILED,
    max_looked_up: int = MAX_LOOKED_UP,
    first_only: bool = False,
) -> DataFrame:
    """(request, line) matches: ``id, line_id, log_timestamp, query_id, top_k``.

    ``requests`` is a tidy request table; requests without a text match nothing. With ``first_only``
    matches that are not among the first ``top_k`` in time of their task may be left out.
    """
    asked = requests.where(F.col("text").isNotNull()).select(
        "query_id", F.lower(like_pattern(F.col("text"), literal)).alias("pattern"), "level", "top_k"
    )
    size = asked.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.length("pattern")).alias("text")).first()
    text = size.text or 0
    prepared = logs.select(*KEY_COLUMNS, "level", F.lower("raw_message").alias("_lower"))
    if size.rows <= max_compiled and text <= MAX_SHARED_TEXT:
        passes = [_one_scan(asked.toArrow(), asked, prepared)]
    else:
        blocks = max(1, -(-size.rows // max_looked_up), -(-text // MAX_SHARED_TEXT))
        passes = []
        for block in _hashed_blocks(asked, blocks):
            passes += _by_shared_piece(block, prepared, first_only)
    return reduce(DataFrame.unionByName, [one.select(*KEY_COLUMNS, "query_id", "top_k") for one in passes])


def _hashed_blocks(asked: DataFrame, blocks: int) -> list[DataFrame]:
    """The requests in blocks of about equal size, each small enough to share with all tasks."""
    if blocks == 1:
        return [asked]
    asked = settled(asked, "requests")
    own_block = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    return [asked.where(own_block == block) for block in range(blocks)]


def _one_scan(few: pa.Table, asked: DataFrame, prepared: DataFrame) -> DataFrame:
    id_type = asked.schema["query_id"].dataType
    rows = few.to_pylist()
    levels = {row["level"] for row in rows}
    if None not in levels:
        # Every request names a level: read those folders only.
        prepared = prepared.where(F.col("level").isin(sorted(levels)))

    def hit(row: dict) -> Column:
        found = F.col("_lower").like(row["pattern"])
        anchor = max(stretches(row["pattern"]), key=len)
        if anchor:
            # A plain look at the longest stretch spares most lines the pattern.
            found = F.contains("_lower", F.lit(anchor)) & found
        if row["level"] is not None:
            found = (F.col("level") == row["level"]) & found
        identity = F.struct(
            F.lit(row["query_id"]).cast(id_type).alias("query_id"),
            F.lit(row["top_k"]).cast("int").alias("top_k"),
        )
        return F.when(found, identity)

    # Named here because an array of no requests has no type of its own.
    identity_type = T.StructType(
        [T.StructField("query_id", id_type), T.StructField("top_k", T.IntegerType())]
    )
    hit_type = T.ArrayType(identity_type)
    hits = F.array_compact(F.array(*[hit(row) for row in rows])).cast(hit_type)
    return prepared.select("*", F.inline(hits))


def stretches(pattern: str) -> list[str]:
    """The plain texts before, between and after the wildcards of a pattern."""
    texts, escaped = [""], False
    for character in pattern:
        if escaped:
            texts[-1] += character
            escaped = False
        elif character == "\\":
            escaped = True
        elif character in "%_":
            texts.append("")
        else:
            texts[-1] += character
    return texts


def _words(text: Column) -> Column:
    return F.array_distinct(F.split(text, WORD_BREAK))


def _grams(text: Column, sizes: list[int]) -> Column:
    """The distinct stretches of a text of the given sizes; size 0 is the empty one."""

    def of(size: int) -> Column:
        if not size:
            return F.array(F.lit(""))
        # Looking ahead gives overlapping matches in one pass.
        return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))

    return F.array_distinct(F.concat(*[of(size) for size in sizes]))


def _some(pieces: list[str]) -> list[str]:
    """Some of many pieces, evenly apart, each once."""
    last, count = len(pieces) - 1, min(len(pieces), COMPARED)
    return list({pieces[at * last // max(1, count - 1)]: None for at in range(count)})


def whole_words(stretch: str) -> list[str]:
    """Words that end inside the stretch on both sides, so that they are words of any line with it."""
    return [word for word in re.split(WORD_BREAK, stretch)[1:-1] if word]


def _pieces(anchor: str) -> tuple[bool, list[str]]:
    """Whether a stretch is sought by whole words, and the words or grams to choose from."""
    if words := whole_words(anchor):
        return True, _some(words)
    if len(anchor) <= GRAM:
        return False, [anchor]
    return False, _some([anchor[at : at + GRAM] for at in range(len(anchor) - GRAM + 1)])


def _rarest(pieces: list[list[str]], prepared: DataFrame, of: Callable[[Column], Column]) -> list[str]:
    """Per pattern the piece that the fewest lines hold. Lines are read only where there is a choice."""
    wanted = sorted({piece for own in pieces if len(own) > 1 for piece in own})
    lines = {}
    if wanted:
        table = prepared.sparkSession.createDataFrame([(piece,) for piece in wanted], "_piece string")
        counts = (
            prepared.select(F.explode(of(F.col("_lower"))).alias("_piece"))
            .join(F.broadcast(table), "_piece")
            .groupBy("_piece")
            .agg(F.count(F.lit(1)).alias("lines"))
        )
        # One row per piece of the requests, whose text is bounded.
        lines = {row["_piece"]: row["lines"] for row in counts.collect()}
    return [min(own, key=lambda piece: (lines.get(piece, 0), piece)) for own in pieces]


def _by_shared_piece(asked: DataFrame, prepared: DataFrame, first_only: bool) -> list[DataFrame]:
    """Lines by the rarest word or gram of each pattern; a join for words, one for grams, per class of limits."""
    spark = prepared.sparkSession
    requests = asked.toArrow()
    rows = requests.to_pylist()
    if rows and all(row["level"] is not None for row in rows):
        prepared = prepared.where(F.col("level").isin(sorted({row["level"] for row in rows})))
    prepared = prepared.where(F.col("_lower").isNotNull())
    limits: dict[tuple, int] = {}
    for row in rows:
        own = row["pattern"], row["level"]
        limits[own] = max(limits.get(own, 0), row["top_k"] or 0)
    number_of = {own: number for number, own in enumerate(limits)}
    names = pa.table(
        {
            "_ask": pa.array([number_of[row["pattern"], row["level"]] for row in rows], pa.int32()),
            "query_id": requests["query_id"],
            "top_k": requests["top_k"],
        }
    )
    named = spark.createDataFrame(
        names,
        T.StructType([T.StructField("_ask", T.IntegerType()), asked.schema["query_id"], asked.schema["top_k"]]),
    )
    asks = []
    for (pattern, level), number in number_of.items():
        parts = stretches(pattern)
        anchor = max(parts, key=len)
        # A pattern that is one plain text needs no second look.
        plain = parts == ["", anchor, ""]
        by_words, pieces = _pieces(anchor)
        asks.append((by_words, pieces, (number, pattern, level, limits[pattern, level], anchor, plain)))
    passes = []
    for by_words in (True, False):
        own = [(pieces, ask) for words, pieces, ask in asks if words == by_words]
        if own:
            passes += _joined(own, by_words, prepared, named, first_only)
    return passes or [prepared.where("false").join(F.broadcast(named))]


def _joined(
    asks: list[tuple], by_words: bool, prepared: DataFrame, named: DataFrame, first_only: bool
) -> list[DataFrame]:
    sizes = sorted({min(GRAM, len(piece)) for pieces, _ in asks for piece in pieces})
    of = _words if by_words else lambda text: _grams(text, sizes)
    rarest = _rarest([pieces for pieces, _ in asks], prepared, of)
    table = prepared.sparkSession.createDataFrame(
        [(*ask, piece) for (_, ask), piece in zip(asks, rarest)],
        "_ask int, _pattern string, _level string, _most int, _anchor string, _plain boolean, _piece string",
    )
    lines = prepared.select("*", F.explode(of(F.col("_lower"))).alias("_piece"))

    def hits(some: DataFrame) -> DataFrame:
        met = lines.join(F.broadcast(some), "_piece")
        return met.where(
            (F.col("_level").isNull() | (F.col("_level") == F.col("level")))
            & F.contains("_lower", "_anchor")
            & (F.col("_plain") | F.like("_lower", "_pattern"))
        ).select(*KEY_COLUMNS, "_ask", "_most")

    if not first_only:
        return [hits(table).join(F.broadcast(named), "_ask")]
    passes, below = [], 0
    most = [ask[3] for _, ask in asks]
    for bound in (*LIMIT_CLASSES, max(most)):
        largest = max((limit for limit in most if below < limit <= bound), default=0)
        if largest:
            some = table.where((F.col("_most") > below) & (F.col("_most") <= largest))
            first = top_per_group(hits(some), ["_ask"], in_time_order(), largest, rank="_place")
            passes.append(first.join(F.broadcast(named), "_ask").where("_place <= top_k"))
        below = max(below, bound)
    return passes
