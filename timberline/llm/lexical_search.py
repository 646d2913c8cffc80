"""Ranked lexical search: branch and bound over prefix trees of the documents' term vectors."""

from __future__ import annotations

from bisect import insort
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from timberline.llm.tables import settled
from timberline.llm.words import chunks
from timberline.operators.ranking import top_per_group

CHUNK_BYTES = 4_000_000
MATRIX_BYTES = 48_000_000
BLOCK_ITEMS = 1000
BLOCK_BYTES = 1_000_000

# The bytes that separate terms, and the capitals that are lowered.
_SEPARATORS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
_TERM_BYTES = bytes(
    0x20 if value in _SEPARATORS else value + 32 if 0x41 <= value <= 0x5A else value for value in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in order: runs of ASCII letters, digits and other characters, A-Z lowered."""
    return (text or "").encode().translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class Items:
    """A block of items: its rows, its distinct terms, and each item's terms by number, once each."""

    rows: list[Row]
    terms: list[bytes]
    numbers: list[np.ndarray]


def item_blocks(items: DataFrame, identifier: str, text: str) -> Iterator[Items]:
    """Items in blocks of bounded number and size of texts; a longer item is a block of its own."""
    held, size = [], 0
    for row in items.select(F.col(identifier).alias("id"), F.col(text).alias("text")).toLocalIterator():
        length = len(row.text or "")
        if held and (len(held) == BLOCK_ITEMS or size + length > BLOCK_BYTES):
            yield _block(held)
            held, size = [], 0
        held.append(row)
        size += length
    if held:
        yield _block(held)


def _block(rows: list[Row]) -> Items:
    number: dict[bytes, int] = {}
    numbers = [
        np.array([number.setdefault(term, len(number)) for term in dict.fromkeys(terms_of(row.text))], np.int64)
        for row in rows
    ]
    return Items(rows, list(number), numbers)


def _restrictor(terms: list[bytes]):
    def restrict(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {term: at for at, term in enumerate(terms)}
        for chunk in chunks(batches, "_text", CHUNK_BYTES):
            sizes, ends, found, times = [], [0], [], []
            for text in chunk.column("_text"):
                own = terms_of(text.as_py())
                counts = Counter(map(number.get, own))
                counts.pop(None, None)
                sizes.append(len(own))
                found += counts.keys()
                times += counts.values()
                ends.append(len(found))
            ends = pa.array(ends, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (found, times)]
            yield pa.RecordBatch.from_arrays(
                [chunk.column("_id"), pa.array(sizes, pa.int64()), *lists], names=["_id", "n", "terms", "times"]
            )

    return restrict


def _document_counter(count: int):
    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(count, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=count)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["term", "df"])

    return documents


@dataclass(frozen=True)
class Collection:
    """What ranking knows of all documents: each term's weight and place by frequency, N and L."""

    weight: np.ndarray
    place: np.ndarray
    documents: int
    total: int


def _collection(vectors: DataFrame, count: int) -> Collection:
    """One row per term of the block comes to the driver."""
    documents, total = vectors.agg(
        F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0).cast("long"))
    ).first()
    partial = vectors.select("terms").mapInArrow(_document_counter(count), "term int, df long")
    df = np.zeros(count, np.int64)
    for term, found in partial.groupBy("term").agg(F.sum("df")).collect():
        df[term] = found
    weight = [math.floor(1000 * math.log((2 * documents + 2) / (2 * one + 1))) for one in df.tolist()]
    place = np.empty(count, np.int64)
    place[np.lexsort((np.arange(count), -df))] = np.arange(count)
    return Collection(np.array(weight, np.int64), place, documents, total)


class Best:
    """The best rows of one item so far: (-score, no identifier, identifier), best first."""

    def __init__(self, limit: int):
        self.limit = limit
        self.rows: list[tuple] = []

    @property
    def least(self) -> int:
        """The score below which nothing counts any more."""
        return -self.rows[-1][0] if len(self.rows) == self.limit else 1

    def add(self, score: int, identifiers: list) -> None:
        for identifier in identifiers:
            row = (-score, identifier is None, identifier)
            if len(self.rows) == self.limit:
                if row >= self.rows[-1]:
                    break
                self.rows.pop()
            insort(self.rows, row)


class PrefixTree:
    """Documents by their terms in the order of falling frequency, so that they share beginnings.

    Documents with the same terms, times and m are one leaf. A node is a stretch of the sorted leaves
    that share a path; nodes without a branch are left out. Leaves and nodes are rows of one matrix of
    times per term: a node's row holds the highest of its subtree, beside the lowest m.
    """

    def __init__(self, paths: list[np.ndarray], times: list[np.ndarray], m: list[int], identifiers: list, limit: int):
        leaves: dict[tuple, list] = {}
        for path, counts, least, identifier in zip(paths, times, m, identifiers, strict=True):
            key = (path.astype(">u4").tobytes(), counts.tobytes(), least)
            own = leaves.setdefault(key, [])
            insort(own, (identifier is None, identifier))
            del own[limit:]  # no item can list more of documents that are equal to it
        keys = sorted(leaves)
        self.identifiers = [[identifier for _, identifier in leaves[key]] for key in keys]
        steps = [np.frombuffer(key[0], ">u4").astype(np.int64) for key in keys]
        self.columns, column = np.unique(np.concatenate([np.zeros(0, np.int64), *steps]), return_inverse=True)
        counts = [np.frombuffer(key[1], np.int64) for key in keys]
        shared = [_shared(a, b) for a, b in zip(steps, steps[1:])]
        self.children = _branches(shared, len(keys))
        most = max((int(one.max()) for one in counts if len(one)), default=0)
        self.times = np.zeros((len(keys) + len(self.children), len(self.columns)), np.min_scalar_type(most))
        row = np.repeat(np.arange(len(keys)), [len(one) for one in steps])
        self.times[row, column] = np.concatenate([np.zeros(0, np.int64), *counts])
        self.m = np.array([key[2] for key in keys] + [0] * len(self.children), np.int64)
        self.leaves = len(keys)
        for at, below in enumerate(self.children, self.leaves):  # a node comes after those below it
            self.times[at] = self.times[below].max(axis=0)
            self.m[at] = self.m[below].min()
        self.root = np.array([len(self.m) - 1] if keys else [], np.int64)

    def search(self, places: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Depth first, the branch with the highest bound first; a branch below the least is cut off."""
        at = np.searchsorted(self.columns, places)
        here = at < len(self.columns)
        here[here] = self.columns[at[here]] == places[here]
        at, weights = at[here], weights[here]
        if not len(at):
            return
        stack = [(math.inf, int(node)) for node in self.root]
        while stack:
            bound, node = stack.pop()
            if bound < best.least:
                continue
            below = self.children[node - self.leaves] if node >= self.leaves else np.array([node])
            scores = self.scores(below, at, weights)
            inner = []
            for child in np.argsort(-scores, kind="stable").tolist():
                score, one = int(scores[child]), int(below[child])
                if score < best.least:
                    break
                if one < self.leaves:
                    best.add(score, self.identifiers[one])
                else:
                    inner.append((score, one))
            stack += reversed(inner)

    def scores(self, rows: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Scores of leaves, and for nodes no less than the score of any leaf below."""
        times = self.times[rows[:, None], at].astype(np.int64)
        parts = 1_000_000_000 * times // np.maximum(1000 * times + 8 * self.m[rows, None], 1)
        return parts @ weights


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    size = min(len(a), len(b))
    differ = a[:size] != b[:size]
    return int(differ.argmax()) if differ.any() else size


def _branches(shared: list[int], leaves: int) -> list[np.ndarray]:
    """The children of every branching node of sorted paths, from the lengths neighbours share."""
    found: list[np.ndarray] = []
    open_nodes: list[tuple[int, list[int]]] = []  # (shared length, children so far)
    for leaf in range(leaves):
        node, depth = leaf, shared[leaf] if leaf < len(shared) else -1
        while open_nodes and open_nodes[-1][0] > depth:
            open_nodes[-1][1].append(node)
            found.append(np.array(open_nodes.pop()[1]))
            node = leaves + len(found) - 1
        if depth < 0:
            break
        if open_nodes and open_nodes[-1][0] == depth:
            open_nodes[-1][1].append(node)
        else:
            open_nodes.append((depth, [node]))
    return found


SCALED = 90


def _searcher(items: Items, known: Collection, limit: int):
    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(limit) for _ in items.numbers]
        wanted = [known.place[numbers] for numbers in items.numbers]
        weights = [known.weight[numbers] for numbers in items.numbers]
        kind = None
        for batch in batches:
            kind = batch.schema.field("_id").type
            for tree in _trees(batch, known, limit):
                for places, weight, own in zip(wanted, weights, best, strict=True):
                    tree.search(places, weight, own)
        if kind is None:
            return
        rows = [(at, identifier, -score) for at, own in enumerate(best) for score, _, identifier in own.rows]
        item, identifier, score = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int32()), pa.array(identifier, kind), pa.array(score, pa.int64())],
            names=["_item", "_id", "_score"],
        )

    return search


def _trees(batch: pa.RecordBatch, known: Collection, limit: int) -> Iterator[PrefixTree]:
    """Trees over as many rows as keep the matrix of times within its bound."""
    most = pc.max(batch.column("times").flatten()).as_py() or 0
    width = max(1, len(known.place)) * np.min_scalar_type(most).itemsize
    rows = max(64, MATRIX_BYTES // (2 * width))
    for begin in range(0, batch.num_rows, rows):
        piece = batch.slice(begin, rows)
        terms = piece.column("terms")
        sizes = terms.value_lengths().to_numpy()
        ends = np.cumsum(sizes)
        numbers = terms.flatten().to_numpy()
        times = piece.column("times").flatten().to_numpy().astype(np.int64)
        place = known.place[numbers]
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((place, row))
        place, times = place[order], times[order]
        some = np.flatnonzero(sizes)
        n = piece.column("n").to_numpy()[some]
        m = 100 - SCALED + SCALED * n * known.documents // max(1, known.total)
        starts = ends - sizes
        yield PrefixTree(
            [place[starts[at] : ends[at]] for at in some],
            [times[starts[at] : ends[at]] for at in some],
            m.tolist(),
            piece.column("_id").take(pa.array(some)).to_pylist(),
            limit,
        )


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    limit: int = 10,
    identifier: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``limit`` highest-scoring documents of each item: item_id, rank, doc_id, score.

    A score sums, over an item's distinct terms, the term's weight by rareness times a share that
    rises with its times in the document and falls with the document's length; integers throughout.
    Documents are reduced to the terms of a block of items and their lengths in one pass, and counted.
    Each task then lays its vectors into prefix trees, searches them item by item and hands on at
    most ``limit`` rows per item; equal scores go by rising identifier, null last.

    Items come to the driver in blocks of up to 1000 rows and a megabyte of text; each block is a pass
    over the documents. Repeated item rows are items of their own; null, empty and term-less items
    give no rows, nor do null, empty and term-less documents. Repeated documents are ranked each. Empty
    tables give an empty one. Other columns are ignored, whatever their names.
    """
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    item_type = items.schema[item].dataType
    found = None
    for block in item_blocks(items, item, item_text):
        vectors = settled(
            base.mapInArrow(_restrictor(block.terms), f"_id {id_type}, n long, terms array<int>, times array<int>"),
            "term-vectors",
        )
        known = _collection(vectors, len(block.terms))
        scored = vectors.where("n > 0").mapInArrow(
            _searcher(block, known, limit), f"_item int, _id {id_type}, _score long"
        )
        order = [F.desc("_score"), F.asc_nulls_last("_id")]
        ranked = top_per_group(scored, ["_item"], order, limit)
        names = docs.sparkSession.createDataFrame(
            [(at, row.id) for at, row in enumerate(block.rows)], f"_item int, _name {item_type.simpleString()}"
        )
        part = ranked.join(F.broadcast(names), "_item").select(
            F.col("_name").alias(item),
            F.col("rank").cast("int").alias("rank"),
            F.col("_id").alias(identifier),
            F.col("_score").alias("score"),
        )
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame(
            [], f"`{item}` {item_type.simpleString()}, rank int, `{identifier}` {id_type}, score long"
        )
    return found
