"""Exact nearest neighbours by cosine similarity, for tables of query vectors.

The items are never shuffled when the query vectors fit a checked size: every task compares its own
batches with all queries by one matrix product and keeps the best few per query, so what leaves a
task is bounded by queries x k. With many queries and few items the items are sent instead, and
nothing is shuffled at all. When both are large, the items are stored once and every block of queries
reads them from end to end in a task of its own, so neither side is copied on disk and only the best few
per query leave a task. A block is as large as a task can hold, for the items are read once per block.

The matrix product, in single precision, only shortlists. Shortlisted pairs are scored again in element
order, in double precision, so that equal vectors get equal scores and ties are broken by key, whatever
the batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.fixed_values import MAX_TOP_K
from timberline.operators.ranking import top_per_group
from timberline.operators.requests import small_table
from timberline.session import settled

# Query vectors held by every task: this many rows and numbers at most (64 MB of doubles).
MAX_SHARED_QUERIES = 4096
MAX_SHARED_NUMBERS = 8_000_000
# Characters of item names that are shared in place of the queries.
MAX_SHARED_TEXT = 16_000_000
# Rows and numbers per block at most (25 MB of doubles); tables with less are cut into so many blocks,
# unless these would have fewer rows than are worth a task.
QUERY_BLOCK, ITEM_BLOCK, BLOCK_NUMBERS = 49_152, 49_152, 3_200_000
LEAST_BLOCKS, WORTH_A_TASK = 6, 2048
# Tasks in which large tables meet at least: the items are read in ranges where the query blocks are fewer.
LEAST_TASKS = 24
# Items that a task scores at once: this many rows and numbers at most.
ITEMS_AT_ONCE, NUMBERS_AT_ONCE = 16_384, 3_200_000
# Results of one block at most, by the queries' own limits.
BLOCK_RESULTS = 2_000_000
# Cells of one score matrix in a task (32 MB of floats), and queries that are scored at once at most.
SCORE_CELLS, MAX_PART = 8_000_000, 512
# Cells of a piece of it, as long as few scores count (0.5 MB of floats).
PIECE_CELLS = 131_072
# Shortlisted pairs that are scored together (12 MB of doubles for 384 numbers each).
PAIRS_AT_ONCE = 4096
# Of rounding, per number of a vector, in a dot product of unit vectors in single precision; twice the bound.
SLACK = 2.0**-22
# Items whose best is compared in place of each, to see which scores can be among the best.
CONTENDERS = 256


def nearest(
    queries: DataFrame,
    items: DataFrame,
    key: str,
    limit: int = MAX_TOP_K,
    max_shared: int = MAX_SHARED_QUERIES,
) -> DataFrame:
    """The best items per query: ``query_id, <key>, similarity, rank``.

    ``queries`` has ``query_id`` (unique) and ``embedding``; ``items`` has ``key`` (unique) and
    ``embedding``. Items without a vector are left out. A query may carry ``scope`` (set of texts or
    NULL for no restriction) and the items ``scopes``: then only items that share a text compete.
    ``limit`` is the number kept per query; an optional query column ``top_k`` lowers it per query, and
    no more than that leave a task. Scopes may be numbers in place of texts.

    Items may carry ``_lines``, a count, and queries ``_enough`` (NULL for any number): an item whose
    betters hold that many lines together is left out, though it keeps its place. The result then has
    ``_before``, the lines of the items that are strictly better, and the item's own ``_lines``.
    """
    scoped = "scope" in queries.columns and "scopes" in items.columns
    own = F.greatest(F.lit(1), F.least("top_k", F.lit(limit))).cast("int").alias("limit")
    limited = "top_k" in queries.columns
    counted = "_lines" in items.columns and "_enough" in queries.columns
    asked = queries.where(F.col("embedding").isNotNull()).select(
        "query_id",
        "embedding",
        *(["scope"] if scoped else []),
        *([own, F.coalesce("top_k", F.lit(0)).cast("int").alias("most")] if limited else []),
        *([F.col("_enough").cast("bigint")] if counted else []),
    )
    stored = items.where(F.col("embedding").isNotNull()).select(
        key, "embedding", *(["scopes"] if scoped else []), *([F.col("_lines").cast("bigint")] if counted else [])
    )
    order = [F.desc("similarity"), F.asc(key)]
    shared = small_table(asked, max_shared)
    if shared is not None and _numbers(shared) <= MAX_SHARED_NUMBERS:
        ranked = top_per_group(_scan(shared, asked, stored, key, limit), ["query_id"], order, limit)
        if counted:
            ranked = _enough_lines(ranked, key)
    else:
        size = stored.agg(
            F.count(F.lit(1)).alias("rows"),
            F.sum(F.size("embedding")).alias("numbers"),
            F.sum(F.length(F.col(key).cast("string"))).alias("text"),
        ).first()
        few = size.rows <= max_shared and (size.numbers or 0) <= MAX_SHARED_NUMBERS
        if few and (size.text or 0) <= MAX_SHARED_TEXT:
            ranked = _answer_in_place(asked, stored, key, limit)
        else:
            # Own limits are kept there.
            return _meet_in_blocks(asked, stored, key, limit, size.rows, size.numbers or 0)
    if limited:
        own_limit = queries.groupBy("query_id").agg(F.max("top_k").alias("top_k"))
        ranked = ranked.join(own_limit, "query_id").where("rank <= top_k").drop("top_k")
    return ranked


def _numbers(queries: pa.Table) -> int:
    return pc.sum(pc.list_value_length(queries["embedding"])).as_py() or 0


def _enough_lines(ranked: DataFrame, key: str) -> DataFrame:
    """``_before`` per query, and only the items that its enough lines reach."""
    by_query = Window.partitionBy("query_id").orderBy(F.desc("similarity"))
    through = F.sum("_lines").over(by_query.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    same = F.sum("_lines").over(Window.partitionBy("query_id", "similarity"))
    kept = ranked.withColumn("_before", through - same).where("_enough IS NULL OR _before < _enough")
    return kept.select("query_id", key, "similarity", "rank", "_lines", "_before")


def _result_schema(queries: DataFrame, items: DataFrame, key: str, *further: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField(key, items.schema[key].dataType),
            T.StructField("similarity", T.DoubleType()),
            T.StructField("rank", T.LongType()),
            *(T.StructField(name, T.LongType()) for name in further),
        ]
    )


def _scan(shared: pa.Table, queries: DataFrame, items: DataFrame, key: str, limit: int) -> DataFrame:
    """One pass over the items where they lie, with all query vectors in every task."""
    sent = items.sparkSession.sparkContext.broadcast(shared)
    further = ("_lines", "_enough") if "_lines" in items.columns else ()

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = Vectors.of(sent.value, "query_id")
        parts = [Leaders(part, limit) for part in asked.parts()]
        for batch in batches:
            stored = Vectors.of(pa.Table.from_batches([batch]), key)
            for leaders in parts:
                leaders.challenge(stored)
        for leaders in parts:
            yield from leaders.rows(key, further)

    return items.mapInArrow(best_of_task, _result_schema(queries, items, key, *further))


def _answer_in_place(queries: DataFrame, items: DataFrame, key: str, limit: int) -> DataFrame:
    """Every query meets all items in its own task, so its ranks are final there."""
    sent = queries.sparkSession.sparkContext.broadcast(items.toArrow())
    counted = "_lines" in items.columns

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stored = Vectors.of(sent.value, key)
        for batch in batches:
            for part in Vectors.of(pa.Table.from_batches([batch]), "query_id").parts(len(stored.names)):
                leaders = Leaders(part, limit)
                leaders.challenge(stored)
                if counted:
                    yield from _finished(list(leaders.rows(key, ("_lines", "_enough"))), key, limit)
                else:
                    yield from leaders.rows(key)

    return queries.mapInArrow(answer, _result_schema(queries, items, key, *(("_lines", "_before") if counted else ())))


def _blocks(rows: int, block: int, dimension: int) -> int:
    most = max(1, min(block, BLOCK_NUMBERS // max(1, dimension)))
    return max(1, -(-rows // most), min(LEAST_BLOCKS, -(-rows // WORTH_A_TASK)))


def _meet_in_blocks(
    queries: DataFrame, items: DataFrame, key: str, limit: int, item_rows: int, item_numbers: int
) -> DataFrame:
    """Every query block meets all items in a task of its own; where the blocks are few, a range of them.

    A task is sent its queries once, and the stored items one after the other, of which it holds a few.
    """
    own = F.col("limit") if "limit" in queries.columns else F.lit(limit)
    size = queries.agg(F.count(F.lit(1)).alias("rows"), F.sum(own.cast("bigint")).alias("results")).first()
    dimension = -(-item_numbers // max(1, item_rows))
    query_blocks = max(
        _blocks(size.rows, QUERY_BLOCK, dimension),
        -(-(size.results or 0) // BLOCK_RESULTS),
        min(LEAST_TASKS, -(-size.rows // WORTH_A_TASK)),
    )
    ranges = min(_blocks(item_rows, ITEM_BLOCK, dimension), -(-LEAST_TASKS // query_blocks))
    at_once = max(1, min(ITEMS_AT_ONCE, NUMBERS_AT_ONCE // max(1, dimension)))
    counted = "_lines" in items.columns
    further = (*(("_lines", "_enough") if counted else ()), *(("most",) if "most" in queries.columns else ()))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """All queries of a block as one value, and a row without one, which meets the items."""
        held = [batch for batch in batches if batch.num_rows]
        if held:
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, held[0].schema) as stream:
                for batch in held:
                    stream.write_batch(batch)
            values = pa.array([sink.getvalue().to_pybytes(), None], pa.binary())
            yield pa.RecordBatch.from_arrays([values, pa.array([False, True])], ["_queries", "_none"])

    def best_of_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: list[pa.Table] = []
        parts: list[Leaders] = []
        waiting: list[pa.RecordBatch] = []

        def challenge() -> None:
            stored = Vectors.of(pa.Table.from_batches(waiting), key)
            waiting.clear()
            if not parts:
                of_block = Vectors.of(pa.concat_tables(asked), "query_id")
                parts.extend(Leaders(part, limit) for part in of_block.parts(at_once))
            for leaders in parts:
                leaders.challenge(stored)

        for batch in batches:
            sent = batch.column("_queries")
            if sent.null_count < len(sent):
                asked.extend(pa.ipc.open_stream(value.as_buffer()).read_all() for value in sent.drop_null())
                batch = batch.filter(pc.is_null(sent))
            for at in range(0, batch.num_rows, at_once):
                waiting.append(batch.slice(at, at_once))
                if sum(map(len, waiting)) >= at_once:
                    challenge()
        if waiting:
            challenge()
        found = [rows for leaders in parts for rows in leaders.rows(key, further)]
        yield from _finished(found, key, limit) if ranges == 1 else found

    # Each query block is read once, before the items; the row numbers begin anew in every range.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    stored = settled(items, "items").coalesce(ranges).withColumn("_first", place == 0)
    asked = queries.repartition(query_blocks, "query_id").mapInArrow(packed, "_queries binary, _none boolean")
    # The condition is tried on every pair; to look at the queries there would copy them each time.
    met = stored.join(asked.hint("shuffle_replicate_nl"), F.col("_first") | F.col("_none")).drop("_first", "_none")
    if ranges == 1:
        return met.mapInArrow(
            best_of_block, _result_schema(queries, items, key, *(("_lines", "_before") if counted else ()))
        )
    best = met.mapInArrow(best_of_block, _result_schema(queries, items, key, *further))
    # No query has more than its own few rows of every range.
    by_query = Window.partitionBy("query_id")
    ranked = best.withColumn("rank", F.row_number().over(by_query.orderBy(F.desc("similarity"), F.asc(key))).cast("bigint"))
    ranked = ranked.where(F.col("rank") <= limit)
    if "most" in further:
        ranked = ranked.withColumn("most", F.max("most").over(by_query)).where("rank <= most").drop("most")
    return _enough_lines(ranked, key) if counted else ranked


def _finished(found: list[pa.RecordBatch], key: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The rows of queries of which a task has all: ranked, up to their own limits and enough lines."""
    if not found:
        return
    table = pa.Table.from_batches(found).combine_chunks()
    names = _whole(table["query_id"]).dictionary_encode("encode").indices
    ordered = pa.table({"query": names, "similarity": table["similarity"], "name": table[key]})
    keys = [("query", "ascending"), ("similarity", "descending"), ("name", "ascending")]
    order = pc.sort_indices(ordered, sort_keys=keys, null_placement="at_start")
    table, query = table.take(order), names.take(order).to_numpy()
    starts = np.flatnonzero(np.diff(query, prepend=-1))
    group = np.cumsum(np.diff(query, prepend=-1) != 0) - 1
    rank = np.arange(len(query)) - starts[group] + 1
    kept = rank <= limit
    columns = {"query_id": table["query_id"], key: table[key], "similarity": table["similarity"], "rank": pa.array(rank)}
    if "most" in table.column_names:
        kept &= rank <= np.maximum.reduceat(table["most"].to_numpy(), starts)[group]
    if "_lines" in table.column_names:
        lines, similarity = table["_lines"].to_numpy(), table["similarity"].to_numpy()
        through = np.cumsum(lines) - lines
        # The first of equally good items has the lines of all better ones before it.
        fresh = (np.diff(query, prepend=-1) != 0) | (np.diff(similarity, prepend=np.inf) != 0)
        before = through[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] - through[starts][group]
        enough = pc.fill_null(table["_enough"], np.iinfo(np.int64).max).to_numpy()
        kept &= before < enough
        columns |= {"_lines": table["_lines"], "_before": pa.array(before)}
    yield from pa.table(columns).filter(pa.array(kept)).combine_chunks().to_batches()


@dataclass
class Vectors:
    """Rows of one batch as a matrix: their names, numbers, unit rows, scopes and own limits."""

    names: pa.Array
    numbers: np.ndarray
    lengths: np.ndarray
    unit: np.ndarray
    scope: pa.Array | None
    scopes: pa.Array | None
    limits: np.ndarray | None
    further: dict[str, pa.Array]

    @classmethod
    def of(cls, table: pa.Table, name: str) -> Vectors:
        table = table.combine_chunks()
        lists = _whole(table["embedding"])
        rows, sizes = len(lists), pc.unique(pc.list_value_length(lists)).to_pylist()
        if len(sizes) > 1:
            raise ValueError(f"vectors of different lengths in one table: {sorted(sizes)}")
        numbers = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        numbers = numbers.reshape(rows, sizes[0] if sizes else 0)
        lengths = np.sqrt(_summed((numbers * numbers).T, rows))
        unit = (numbers / np.where(lengths == 0, 1.0, lengths)[:, None]).astype(np.float32)
        columns = table.column_names
        return cls(
            _whole(table[name]),
            numbers,
            lengths,
            unit,
            _whole(table["scope"]) if "scope" in columns else None,
            _whole(table["scopes"]) if "scopes" in columns else None,
            _whole(table["limit"]).to_numpy(zero_copy_only=False) if "limit" in columns else None,
            {name: _whole(table[name]) for name in ("_lines", "_enough", "most") if name in columns},
        )

    def parts(self, items: int = 0) -> list[Vectors]:
        """The rows cut so that one part's scores against a batch stay within SCORE_CELLS."""
        step = max(1, min(MAX_PART, SCORE_CELLS // max(1, items, 16_384)))
        return [self._slice(at, at + step) for at in range(0, len(self.names), step)]

    def _slice(self, low: int, high: int) -> Vectors:
        return Vectors(
            self.names[low:high],
            self.numbers[low:high],
            self.lengths[low:high],
            self.unit[low:high],
            self.scope[low:high] if self.scope is not None else None,
            None,
            self.limits[low:high] if self.limits is not None else None,
            {name: values[low:high] for name, values in self.further.items()},
        )


class Scopes:
    """Which items the queries of a part may find: those that share a scope, or all without one."""

    def __init__(self, wanted: pa.Array):
        lists = pa.concat_arrays([wanted])
        flat = pc.list_flatten(lists)
        self.known = flat.drop_null().unique()
        owners = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        column = pc.index_in(flat, self.known)
        named = column.is_valid().to_numpy(zero_copy_only=False)
        # The last column stands for items of no known scope.
        self.asking = np.zeros((len(lists), len(self.known) + 1), dtype=bool)
        self.asking[owners[named], column.drop_null().to_numpy()] = True
        self.asking[lists.is_null().to_numpy(zero_copy_only=False)] = True

    def open(self, scopes: pa.Array) -> np.ndarray:
        """One row per query and one column per item."""
        owners = pc.list_parent_indices(scopes).to_numpy(zero_copy_only=False)
        column = pc.index_in(pc.list_flatten(scopes), self.known)
        hits = column.is_valid().to_numpy(zero_copy_only=False)
        owners, column = owners[hits], column.drop_null().to_numpy()
        if np.bincount(owners, minlength=1).max() <= 1:
            place = np.full(len(scopes), len(self.known), dtype=np.int64)
            place[owners] = column
            return self.asking[:, place]
        inside = np.zeros((len(scopes), len(self.known) + 1), dtype=np.float32)
        inside[owners, column] = 1
        inside[:, -1] = 1 - inside[:, :-1].max(axis=1)
        return self.asking.astype(np.float32) @ inside.T > 0


class Leaders:
    """The best items seen so far for a part of the queries."""

    def __init__(self, queries: Vectors, limit: int):
        self.queries = queries
        own = queries.limits
        self.limits = np.full(len(queries.names), limit, dtype=np.int64) if own is None else own.astype(np.int64)
        self.scopes = None if queries.scope is None else Scopes(queries.scope)
        self.best = pd.DataFrame({"query": [], "name": [], "similarity": []})
        # Found since the best were last cut down, and how many these are.
        self.waiting: list[pd.DataFrame] = []
        self.found = 0
        self.floor = np.full(len(queries.names), -np.inf)
        self.slack = SLACK * max(1, queries.numbers.shape[1])

    def challenge(self, items: Vectors) -> None:
        if not len(items.names):
            return
        if items.numbers.shape[1] != self.queries.numbers.shape[1]:
            raise ValueError("query and item vectors differ in length")
        bar = (self.floor - self.slack).astype(np.float32)
        better = self._few_better(items.unit, bar) if self.scopes is None and np.isfinite(bar).all() else None
        query, item = self._better(items, bar) if better is None else better
        if not len(query):
            return
        # A name is held once, however many queries it is among the best of.
        named, which = np.unique(item, return_inverse=True)
        found = {
            "query": query,
            "name": items.names.take(pa.array(named)).to_pandas().to_numpy()[which],
            "similarity": self._exact(query, items, item),
        }
        if "_lines" in items.further:
            found["lines"] = items.further["_lines"].to_numpy(zero_copy_only=False)[item]
        self.waiting.append(pd.DataFrame(found))
        self.found += len(query)
        if not len(self.best) or self.found > self._room() // 4:
            self._cut()

    def _few_better(self, unit: np.ndarray, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
        """Pairs that reach the bar, by pieces whose scores stay in the cache; None if they are many."""
        step = max(1, PIECE_CELLS // len(bar))
        scores = np.empty((len(bar), step), dtype=np.float32)
        better = np.empty(scores.shape, dtype=bool)
        queries, found, count = self.queries.unit, [], 0
        for low in range(0, len(unit), step):
            piece = unit[low : low + step]
            if len(piece) < step:
                scores, better = scores[:, : len(piece)], better[:, : len(piece)]
            np.matmul(queries, piece.T, out=scores)
            np.greater_equal(scores, bar[:, None], out=better)
            at = np.flatnonzero(better)
            if len(at):
                query, item = np.divmod(at, len(piece))
                found.append((query, item + low))
                count += len(at)
                if count > self._room():
                    return None
        if not found:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        return np.concatenate([query for query, _ in found]), np.concatenate([item for _, item in found])

    def _better(self, items: Vectors, bar: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs that reach the bar; if these are too many, only those that can be among the best of this batch."""
        scores = self.queries.unit @ items.unit.T
        if self.scopes is not None:
            scores[~self.scopes.open(items.scopes)] = -np.inf
        better = scores >= bar[:, None]
        if np.count_nonzero(better) > self._room():
            # Too many beat the leaders so far: only the best of this batch can stay.
            bar = np.maximum(bar, self._least_of_best(scores) - np.float32(2 * self.slack))
            better = scores >= bar[:, None]
        query, item = np.divmod(np.flatnonzero(better), scores.shape[1])
        real = scores[query, item] > -np.inf
        return query[real], item[real]

    def _cut(self) -> None:
        """The best of those so far and those found since."""
        if not self.waiting:
            return
        both = pd.concat([self.best, *self.waiting] if len(self.best) else self.waiting, ignore_index=True)
        self.waiting, self.found = [], 0
        both = both.sort_values(["query", "similarity", "name"], ascending=[True, False, True])
        place, most = both.groupby("query").cumcount(), self.limits[both["query"].to_numpy(dtype=int)]
        self.best = both[place < most]
        last = both[place == most - 1]
        self.floor[last["query"].to_numpy(dtype=int)] = last["similarity"]

    def _least_of_best(self, scores: np.ndarray) -> np.ndarray:
        """Per query a score that as many items reach as are kept, and few more; -inf if there are too few.

        The best of every so many items are compared in place of all, one pass over the scores.
        """
        found = np.full(len(scores), -np.inf, dtype=np.float32)
        for limit in np.unique(self.limits[: len(scores)]).tolist():
            if limit >= scores.shape[1]:
                continue
            rows = np.flatnonzero(self.limits == limit)
            mine = scores if len(rows) == len(scores) else scores[rows]
            groups = max(CONTENDERS, 8 * limit)
            deep = mine.shape[1] // groups
            if deep > 1:
                whole = mine[:, : deep * groups].reshape(len(mine), deep, groups).max(axis=1)
                mine = np.concatenate([whole, mine[:, deep * groups :]], axis=1)
            at = mine.shape[1] - limit
            found[rows] = np.partition(mine, at, axis=1)[:, at]
        return found

    def _room(self) -> int:
        """Pairs that are cheaper to score than to cut down first."""
        return 2 * int(self.limits.sum())

    def _exact(self, query: np.ndarray, items: Vectors, item: np.ndarray) -> np.ndarray:
        dots = np.empty(len(query))
        for start in range(0, len(query), PAIRS_AT_ONCE):
            part = slice(start, start + PAIRS_AT_ONCE)
            products = self.queries.numbers[query[part]] * items.numbers[item[part]]
            dots[part] = _summed(products.T, len(products))
        lengths = self.queries.lengths[query] * items.lengths[item]
        return np.where(lengths == 0, 0.0, dots / np.where(lengths == 0, 1.0, lengths))

    def rows(self, key: str, further: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
        """The best items in order, per query of this part, with the items' lines or what the query says besides."""
        self._cut()
        if len(self.best):
            query = pa.array(self.best["query"].to_numpy(dtype=np.int64))
            more = {name: values.take(query) for name, values in self.queries.further.items()}
            if "_lines" in further:
                more["_lines"] = pa.array(self.best["lines"].to_numpy(dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    self.queries.names.take(query),
                    pa.array(self.best["name"]),
                    pa.array(self.best["similarity"].to_numpy(dtype=np.float64)),
                    pa.array(self.best.groupby("query").cumcount().to_numpy(dtype=np.int64) + 1),
                    *(more[name].cast(pa.int64()) for name in further),
                ],
                names=["query_id", key, "similarity", "rank", *further],
            )


def _summed(columns: np.ndarray, rows: int) -> np.ndarray:
    """Element-wise sum in the order given, the same for every row wherever it lies."""
    total = np.zeros(rows)
    for column in columns:
        total += column
    return total


def _whole(column: pa.ChunkedArray) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
