"""Searches for tables of requests; a single request is a table of one row.

A request table has ``query_id``, ``text`` and optionally ``level`` and ``top_k``. Log tables carry
the row ``id`` next to the stored columns (``sources.tables.with_row_id``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from timberline.fixed_values import (
    DEFAULT_TOP_K,
    EVENT_SEARCH_TOP_K,
    LEVELS,
    MAX_EVENTS,
    MIN_CANDIDATES,
    RESULT_COLUMNS,
)
from timberline.functions.labels import iso_time
from timberline.operators.cells import CellModel, nearest_in_cells
from timberline.operators.encoders import Encoder
from timberline.operators.keyword import keyword_matches
from timberline.operators.lsh import PLANES, PROBES, SEED, approximate_nearest
from timberline.operators.ranking import in_time_order, top_per_group
from timberline.operators.requests import accepted_requests, small_table, tidy_requests
from timberline.operators.rollups import levels_per_message, short_name
from timberline.operators.spread import spread_common_join
from timberline.operators.vectors import MAX_SHARED_QUERIES, nearest
from timberline.session import release_shuffles, settled

# Hashes of matched messages, 8 bytes each, that are broadcast to pick log lines.
MAX_SHARED_MESSAGES = 1_000_000
# Seed ids, 12 bytes each, that are broadcast to look up their lines.
MAX_SHARED_SEEDS = 100_000
MAX_LISTED_SEEDS = 1000
# Matched messages that are named in the scan, their characters, and values per list: up to so many
# values Parquet looks up one by one, in dictionaries and Bloom filters; of longer lists it knows the
# least and greatest only.
MAX_LISTED_MESSAGES, MAX_LISTED_TEXT, VALUES_PER_LIST = 64, 64_000, 10
# Stands for a message in the pairs of a search by many requests; a NULL message comes last, as in SQL.
NUMBER, LAST_NUMBER = "_number", 1 << 62
# Characters of a message that tell its range when messages are sorted.
RANGE_TEXT = 256


def keyword_search(
    requests: DataFrame,
    logs: DataFrame,
    default_top_k: int = DEFAULT_TOP_K,
    literal: bool = False,
    levels: Sequence[str] | None = LEVELS,
) -> DataFrame:
    """Per request the earliest lines whose message holds the text: result columns and ``rank``.

    Only keys of lines are matched and ranked, and a task hands on no more of them than a request
    asks for; the lines themselves are fetched for the ranked keys. ``levels`` are the levels that a
    request may name, None for any.
    """
    asked = tidy_requests(requests, default_top_k).select("query_id", "text", "level", "top_k")
    asked, largest = accepted_requests(asked, levels=levels)
    matches = keyword_matches(asked, logs, literal, first_only=True)
    ranked = top_per_group(matches, ["query_id"], in_time_order(), largest).where("rank <= top_k")
    lines = logs.select(*RESULT_COLUMNS)
    return ranked.select("query_id", "id", "rank").join(lines, "id").select("query_id", *RESULT_COLUMNS, "rank")


@dataclass(frozen=True)
class Index:
    """How an index of signatures was written, and how many of them a request probes."""

    probes: int = PROBES
    planes: int = PLANES
    seed: int = SEED
    columns = ("signature",)

    def nearest(self, queries: DataFrame, items: DataFrame, key: str, limit: int) -> DataFrame:
        return approximate_nearest(queries, items, key, limit, self.probes, self.planes, self.seed)


@dataclass(frozen=True)
class CellIndex:
    """The model that an index of cells was written by, and how many cells a request probes if not its default."""

    model: CellModel
    probes: int | None = None
    columns = ("cell", "folder")

    def nearest(self, queries: DataFrame, items: DataFrame, key: str, limit: int) -> DataFrame:
        return nearest_in_cells(queries, items, self.model, key, limit, self.probes)


def semantic_search(
    requests: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    encoder: Encoder,
    default_top_k: int = DEFAULT_TOP_K,
    index: Index | CellIndex | None = None,
    levels: Sequence[str] | None = LEVELS,
    level_sets: DataFrame | None = None,
) -> DataFrame:
    """Per request the lines whose message is closest in meaning to the text.

    ``levels`` are the levels that a request may name, None for any. With ``index`` the ``vectors`` are
    the rows of an index (``cells.read_cells``, or what ``lsh.write_index`` wrote) and the search is
    approximate; without it, exact. ``level_sets`` are the levels that each message of ``logs`` occurs at
    (``summaries.level_sets``); without them a request that names a level counts them from the lines.
    """
    asked = tidy_requests(requests, default_top_k).select("query_id", "text", "level", "top_k")
    asked, largest = accepted_requests(asked, levels=levels)
    return _nearest_lines(encoder.encode(asked, "text").drop("text"), largest, logs, vectors, index, level_sets)


def vector_search(
    asked: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    index: Index | CellIndex | None = None,
    level_sets: DataFrame | None = None,
) -> DataFrame:
    """As ``semantic_search`` for ready vectors: ``query_id, embedding, level, top_k``, any levels."""
    asked, largest = accepted_requests(asked.select("query_id", "embedding", "level", "top_k"))
    return _nearest_lines(asked, largest, logs, vectors, index, level_sets)


def _nearest_lines(
    asked: DataFrame,
    limit: int,
    logs: DataFrame,
    vectors: DataFrame,
    index: Index | CellIndex | None,
    level_sets: DataFrame | None = None,
) -> DataFrame:
    """Two stages: the best messages per request, then their lines.

    A level counts in both, so that messages without a line at that level do not use up places.
    ``limit`` is the largest number of lines that a request asks for.
    """
    rows = small_table(asked, MAX_SHARED_QUERIES)
    # Either way the encoder has run once, and what follows starts from its result.
    if rows is None:
        asked = settled(asked, "requests")
    else:
        asked = asked.sparkSession.createDataFrame(rows, asked.schema)
    levels = None if rows is None else rows["level"].drop_null().unique().to_pylist()
    numbers = None
    if rows is None and index is None:
        numbers = _message_numbers(vectors, logs)
        vectors, logs, level_sets = (_short_names(table) for table in (vectors, logs, level_sets))
        if asked.where("level IS NOT NULL").isEmpty():
            levels = []
    queries = asked.select(
        "query_id",
        "embedding",
        F.greatest(F.col("top_k"), F.lit(MIN_CANDIDATES)).alias("top_k"),
        F.when(F.col("level").isNotNull(), F.array("level")).alias("scope"),
        # Lines are counted whatever their level.
        *([F.when(F.col("level").isNull(), F.col("top_k")).alias("_enough")] if numbers is not None else []),
    )
    items = vectors.select("normalized_message", "embedding", *(index.columns if index else ()))
    if levels is None or levels:
        # Only the asked levels count where they are known.
        if level_sets is None:
            scopes = levels_per_message(logs if levels is None else logs.where(F.col("level").isin(levels)))
        elif levels is None:
            scopes = level_sets
        else:
            scopes = level_sets.where(F.arrays_overlap("scopes", F.array(*map(F.lit, levels))))
        # If every request names a level, a message without lines at one can answer none.
        every = rows is not None and rows["level"].null_count == 0
        items = items.join(scopes, "normalized_message", "inner" if every else "left").withColumn(
            "scopes", F.coalesce("scopes", F.array().cast("array<string>"))
        )
    places = max(limit, MIN_CANDIDATES)
    if numbers is not None:
        matches = nearest(queries, _with_number(items, numbers), NUMBER, places)
    elif index is None:
        matches = nearest(queries, items, "normalized_message", places)
    else:
        matches = index.nearest(queries, items, "normalized_message", places)
    matches = matches.select("query_id", NUMBER if numbers is not None else "normalized_message", "similarity")
    # Two readers follow; the vectors are scanned once.
    matches = settled(matches, "matches")
    wanted = matches.join(asked.select("query_id", "level", "top_k"), "query_id")
    if numbers is not None:
        release_shuffles(logs.sparkSession)
        wanted = settled(wanted, "wanted")
    return (
        _lines_of(wanted, logs, limit, rows, numbers=numbers)
        .where("rank <= top_k")
        .select("query_id", *RESULT_COLUMNS, "similarity", "rank")
    )


def _message_numbers(vectors: DataFrame, logs: DataFrame) -> DataFrame:
    """Every message that has a row in ``vectors`` once, by its short name, with a number that orders as
    the messages do, its rows there and its lines in ``logs``.

    Whole messages are moved once, to be sorted; what they leave on disk is released.
    """
    release_shuffles(vectors.sparkSession)
    messages = vectors.where("normalized_message IS NOT NULL").select("normalized_message")
    # Ranges are cut by beginnings, of which the driver is sent samples.
    ranges = messages.repartitionByRange(F.substring("normalized_message", 1, RANGE_TEXT))
    ordered = ranges.sortWithinPartitions("normalized_message").withColumn(NUMBER, F.monotonically_increasing_id())
    # A message of several rows has them side by side.
    numbers = _short_names(ordered).groupBy("normalized_message").agg(
        F.min(NUMBER).alias(NUMBER), F.count(F.lit(1)).alias("_rows")
    )
    lines = _short_names(logs.select("normalized_message")).groupBy("normalized_message").agg(F.count(F.lit(1)).alias("_lines"))
    named = numbers.join(lines, "normalized_message", "left")
    named = settled(named.withColumn("_lines", F.coalesce("_lines", F.lit(0)).cast("bigint")), "numbers")
    release_shuffles(vectors.sparkSession)
    return named


def _short_names(table: DataFrame | None) -> DataFrame | None:
    return None if table is None else table.withColumn("normalized_message", short_name("normalized_message"))


def _with_number(table: DataFrame, numbers: DataFrame) -> DataFrame:
    """The rows with their message's number and lines in place of the message's short name."""
    found = table.join(numbers, "normalized_message", "left").drop("normalized_message", "_rows")
    return found.withColumns(
        {NUMBER: F.coalesce(NUMBER, F.lit(LAST_NUMBER)), "_lines": F.coalesce("_lines", F.lit(0)).cast("bigint")}
    )


def _lines_of(
    wanted: DataFrame,
    logs: DataFrame,
    limit: int,
    rows: pa.Table | None,
    skip: str | None = None,
    numbers: DataFrame | None = None,
) -> DataFrame:
    """Ranked lines of the matched messages, at most ``limit`` per request.

    No result holds more than ``limit`` lines of a message and level, so the lines are cut down to
    that before they meet the requests, and no request meets more of them than it asks for. A message
    that owns most lines then costs no more than any other, however many requests match it. ``rows``
    are the requests when they are few. With ``numbers``, messages of ``logs`` are short names and
    matched by their numbers.
    """
    skipped = int(skip is not None)
    per_message = limit + skipped
    lines = logs.select(*RESULT_COLUMNS, "normalized_message")
    key = "normalized_message"
    if numbers is not None:
        numbered = numbers.select("normalized_message", NUMBER)
        lines, key = lines.join(numbered, "normalized_message").drop("normalized_message"), NUMBER
    few = rows is not None and rows.num_rows * max(limit, MIN_CANDIDATES) <= MAX_SHARED_MESSAGES
    listed = _listed_messages(wanted) if few and rows.num_rows * max(limit, MIN_CANDIDATES) <= MAX_LISTED_MESSAGES else None
    if listed is not None:
        lines = lines.where(_any_of("normalized_message", listed))
    elif few:
        # At most one 8-byte hash per request and place; a collision only lets a line through to
        # the join on the full message below.
        hashes = wanted.select(F.xxhash64("normalized_message").alias("_hash")).distinct()
        lines = (
            lines.withColumn("_hash", F.xxhash64("normalized_message"))
            .join(F.broadcast(hashes), "_hash", "left_semi")
            .drop("_hash")
        )
    else:
        # Lines of messages that nothing asks for are left out before any are ranked.
        matched = wanted.select(key).distinct()
        lines = lines.join(matched, key, "left_semi")
    first = top_per_group(lines, [key, "level"], in_time_order(), per_message, rank="_place")
    asked = wanted.withColumnRenamed("level", "_level")
    if few:
        found = asked.join(first, key)
    else:
        # Most of many requests may match one message.
        found = spread_common_join(asked, first, [key], "query_id")
    found = found.where("_level IS NULL OR _level = level")
    found = found.where(F.col("_place") <= F.col("top_k") + skipped).drop("_place")
    if skip is not None:
        found = found.where(F.col("id") != F.col(skip))
    order = [F.desc("similarity"), *in_time_order()]
    return top_per_group(found, ["query_id"], order, limit)


def _listed_messages(wanted: DataFrame) -> list[str] | None:
    """The matched messages, if they are short enough to be named in a scan."""
    messages = [row[0] for row in wanted.select("normalized_message").distinct().collect()]
    return messages if sum(map(len, messages)) <= MAX_LISTED_TEXT else None


def _any_of(column: str, values: list) -> Column:
    """Whether a column has one of the values, in lists short enough to skip row groups without one."""
    starts = range(0, max(1, len(values)), VALUES_PER_LIST)
    return reduce(or_, [F.col(column).isin(values[at : at + VALUES_PER_LIST]) for at in starts])


def similar_logs(
    seeds: DataFrame, logs: DataFrame, vectors: DataFrame, default_top_k: int = DEFAULT_TOP_K
) -> DataFrame:
    """Per seed (``seed_id``, optionally ``top_k``) the lines closest to that line.

    The seed itself is left out, other lines with its message are not. A seed that does not exist
    or has no vector gives no rows; a seed that repeats counts once. Neighbours are looked up once per
    distinct seed message.
    """
    top_k = F.col("top_k") if "top_k" in seeds.columns else F.lit(None).cast("int")
    seeds = seeds.select("seed_id", F.coalesce(top_k, F.lit(default_top_k)).cast("int").alias("top_k"))
    seeds, limit = accepted_requests(seeds, "seed_id")
    rows = small_table(seeds, MAX_SHARED_SEEDS)
    places = max(limit, MIN_CANDIDATES)

    few = rows is not None and rows.num_rows * places <= MAX_SHARED_MESSAGES
    numbers, key = (None, "normalized_message") if few else (_message_numbers(vectors, logs), NUMBER)
    if not few:
        vectors, logs = _short_names(vectors), _short_names(logs)
    numbered = logs if few else logs.join(numbers, "normalized_message")
    looked_up = numbered.select(F.col("id").alias("seed_id"), F.col(key).alias("_message"), *([] if few else ["_rows"]))
    if rows is not None:
        ids = rows["seed_id"].to_pylist()
        if len(ids) <= MAX_LISTED_MESSAGES:
            looked_up = looked_up.where(_any_of("seed_id", ids))
        elif len(ids) <= MAX_LISTED_SEEDS:
            # Named in the scan, the ids skip files and row groups by their min/max statistics.
            looked_up = looked_up.where(F.col("seed_id").isin(ids))
        seeds = F.broadcast(seeds.sparkSession.createDataFrame(rows, seeds.schema))
    # One row per seed, read several times below; the lines are looked up once.
    located = looked_up.join(seeds, "seed_id")
    if not few:
        # Each row of its message's vector may bring up the seed, which is left out; of a seed with several
        # lines it is not known how many are.
        alone = F.count(F.lit(1)).over(Window.partitionBy("seed_id")) == 1
        own = F.when(alone, F.col("top_k") + F.col("_rows") * F.col("_rows"))
        located = located.withColumn("_enough", own).drop("_rows")
    located = settled(located, "seeds")
    stored = vectors.select("normalized_message", "embedding")
    if not few:
        stored = _with_number(stored, numbers)
    most = F.greatest(F.max("top_k"), F.lit(MIN_CANDIDATES)).alias("top_k")
    enough = [] if few else [F.when(F.count_if(F.col("_enough").isNull()) == 0, F.max("_enough")).alias("_enough")]
    seed_messages = located.groupBy(F.col("_message").alias("query_id")).agg(most, *enough)
    queries = stored.select(F.col(key).alias("query_id"), "embedding").join(seed_messages, "query_id")
    matches = settled(nearest(queries, stored, key, places), "matches")
    wanted = (
        # Most seeds may carry one message.
        spread_common_join(located, matches.withColumnRenamed("query_id", "_message"), ["_message"], "seed_id")
        .where(F.col("rank") <= F.greatest(F.col("top_k"), F.lit(MIN_CANDIDATES)))
        .where("true" if few else "_enough IS NULL OR _before < _enough")
        .select(
            F.col("seed_id").alias("query_id"),
            key,
            "similarity",
            "top_k",
            F.lit(None).cast("string").alias("level"),
        )
    )
    if not few:
        release_shuffles(logs.sparkSession)
        wanted = settled(wanted, "wanted")
    return (
        _lines_of(wanted, logs, limit, rows, "query_id", numbers)
        .where("rank <= top_k")
        .select(F.col("query_id").alias("seed_id"), *RESULT_COLUMNS, "similarity", "rank")
    )


def compare_search(
    requests: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    encoder: Encoder,
    default_top_k: int = DEFAULT_TOP_K,
    levels: Sequence[str] | None = LEVELS,
) -> DataFrame:
    """Both searches side by side; ``method`` tells them apart."""
    by_meaning = semantic_search(requests, logs, vectors, encoder, default_top_k, levels=levels)
    by_keyword = keyword_search(requests, logs, default_top_k, levels=levels)
    return by_meaning.withColumn("method", F.lit("semantic")).unionByName(
        by_keyword.withColumn("method", F.lit("keyword")), allowMissingColumns=True
    )


def nearest_events(
    requests: DataFrame,
    logs: DataFrame,
    vectors: DataFrame,
    encoder: Encoder,
    top_k: int = EVENT_SEARCH_TOP_K,
    max_events: int = MAX_EVENTS,
) -> DataFrame:
    """The first distinct event ids among each request's results: ``query_id, rank, event_id``.

    Results are lines, so a frequent message can fill all ``top_k`` places with one event.
    """
    open_requests = requests.select("query_id", "text")
    found = semantic_search(open_requests, logs, vectors, encoder, top_k)
    first_seen = (
        found.where(F.coalesce("event_id", F.lit("")) != "")
        .groupBy("query_id", "event_id")
        .agg(F.min("rank").alias("first_rank"))
    )
    return top_per_group(first_seen, ["query_id"], [F.asc("first_rank")], max_events).select(
        "query_id", "rank", "event_id"
    )


def rendered(results: DataFrame) -> DataFrame:
    """Search results for export, with ISO 8601 event times."""
    return results.withColumn("log_timestamp", iso_time(F.col("log_timestamp")))
