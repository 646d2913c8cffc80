"""Removal of passages that occur more than once, counted exactly in super-k-mer buckets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.tables import row_key, shuffle_parts
from timberline.llm.words import Words, chunks, rolled, text_buffers, words_of

PACKED = (
    "bucket int, texts binary, size bigint, lengths binary, starts binary, flags binary, keys binary, "
    "known_keys binary, known_begin binary, known_end binary"
)
RANGE = "_key struct<a:bigint,b:bigint>, begin int, end int"
KEY = np.dtype([("a", "<i8"), ("b", "<i8")])


@dataclass(frozen=True)
class Passages:
    """Windows of ``width`` words; their minimisers are runs of ``minimiser`` words."""

    width: int = 35
    minimiser: int = 4
    chunk_bytes: int = 5_000_000
    buckets_per_part: int = 4


def _windows(words: Words, width: int) -> np.ndarray:
    """The first words of all windows that lie within one row."""
    counts = np.maximum(np.diff(words.first) - width + 1, 0)
    skipped = np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
    return np.arange(counts.sum()) + skipped


def _sorted_runs(hashes: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows in sorted order, and whether each equals the one before it, word by word."""

    def same_as_before(order: np.ndarray, key: np.ndarray) -> np.ndarray:
        same = np.zeros(len(order), bool)
        same[1:] = key[order[1:]] == key[order[:-1]]
        return same

    def differ(order: np.ndarray, same: np.ndarray) -> np.ndarray:
        pairs = np.flatnonzero(same)
        wrong = np.zeros(len(pairs), bool)
        left, right = at[order[pairs]], at[order[pairs - 1]]
        for shift in range(width):
            wrong |= hashes[left + shift] != hashes[right + shift]
        return pairs[wrong]

    key = rolled(hashes, width)[at]
    order = np.argsort(key, kind="stable")
    same = same_as_before(order, key)
    wrong = differ(order, same)
    if len(wrong):  # two windows of one hash: a second hash parts them
        order = np.lexsort((rolled(hashes, width, salt=1)[at], key))
        same = same_as_before(order, key)
        same[differ(order, same)] = False
    return order, same


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The minimum of each ``span`` consecutive values, by doubling."""
    reach = 1
    while reach * 2 <= span:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = span - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def _ranges(covered: np.ndarray, row: np.ndarray, ordinal: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last entries of runs of covered windows that follow each other in a row."""
    at = np.flatnonzero(covered)
    if not len(at):
        return at, at
    cut = (row[at[1:]] != row[at[:-1]]) | (ordinal[at[1:]] != ordinal[at[:-1]] + 1)
    return at[np.concatenate([[True], cut])], at[np.concatenate([cut, [True]])]


def _packer(rule: Passages, buckets: int):
    import zstandard

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = zstandard.ZstdCompressor(level=8)
        for chunk in chunks(batches, "_text", rule.chunk_bytes):
            data, offsets = text_buffers(chunk.column("_text"))
            words = words_of(data, offsets)
            at = _windows(words, rule.width)
            if not len(at):
                continue
            hashes = words.hashes()
            row = words.row[at]
            ordinal = at - words.first[row]
            order, same = _sorted_runs(hashes, at, rule.width)
            again = same.copy()
            again[:-1] |= same[1:]
            repeated, later = np.zeros(len(at), bool), np.zeros(len(at), bool)
            repeated[order], later[order] = again, same
            least = _smallest(rolled(hashes, rule.minimiser), rule.width - rule.minimiser + 1)[at]
            # of windows that repeat here, the first travels for all of them
            sent = np.flatnonzero(~later)
            cut = np.ones(len(sent), bool)
            cut[1:] = (
                (at[sent[1:]] != at[sent[:-1]] + 1)
                | (row[sent[1:]] != row[sent[:-1]])
                | (least[sent[1:]] != least[sent[:-1]])
                | (repeated[sent[1:]] != repeated[sent[:-1]])
            )
            head = sent[cut]
            tail = sent[np.concatenate([cut[1:], [True]])]
            bucket = (least[head] % np.uint64(buckets)).astype(np.int32)
            by_bucket = np.argsort(bucket, kind="stable")
            head, tail, bucket = head[by_bucket], tail[by_bucket], bucket[by_bucket]
            left, right = words.start[at[head]], words.end[at[tail] + rule.width - 1]
            raw = data.tobytes()
            texts = [raw[x:y] for x, y in zip(left.tolist(), right.tolist(), strict=True)]
            lengths = (right - left).astype("<u4")
            starts, flags = ordinal[head].astype("<u4"), repeated[head].astype("u1")
            struct = chunk.column("_key")
            keys = np.empty(chunk.num_rows, KEY)
            for part, name in enumerate("ab"):
                keys[name] = struct.flatten()[part].to_numpy(zero_copy_only=False)
            smer_keys = keys[row[head]]
            known_first, known_last = _ranges(repeated, row, ordinal)
            known_key = keys[row[known_first]]
            known_begin = ordinal[known_first].astype("<i4")
            known_end = (ordinal[known_last] + rule.width).astype("<i4")
            edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
            shares = np.linspace(0, len(known_first), len(edges)).astype(np.int64)
            out: list[list] = [[] for _ in range(10)]
            for k in range(len(edges) - 1):
                x, y, p, q = edges[k], edges[k + 1], shares[k], shares[k + 1]
                joined = b"".join(texts[x:y])
                fields = (
                    int(bucket[x]), codec.compress(joined), len(joined), lengths[x:y].tobytes(),
                    starts[x:y].tobytes(), flags[x:y].tobytes(), smer_keys[x:y].tobytes(),
                    known_key[p:q].tobytes(), known_begin[p:q].tobytes(), known_end[p:q].tobytes(),
                )
                for column, value in zip(out, fields, strict=True):
                    column.append(value)
            kinds = [pa.int32(), pa.binary(), pa.int64(), *[pa.binary()] * 7]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(out, kinds, strict=True)],
                names=[part.split()[0] for part in PACKED.split(", ")],
            )

    return pack


def _counter(rule: Passages):
    import zstandard

    def count(table: pa.Table) -> pa.Table:
        codec = zstandard.ZstdDecompressor()
        columns = {name: table.column(name).to_pylist() for name in table.column_names}

        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(columns[name]), kind)

        sizes = columns["size"]
        texts = b"".join(
            codec.decompress(packed, max_output_size=size)
            for packed, size in zip(columns["texts"], sizes, strict=True)
        )
        offsets = np.concatenate([[0], np.cumsum(joined("lengths", "<u4").astype(np.int64))])
        words = words_of(np.frombuffer(texts, np.uint8), offsets)
        at = _windows(words, rule.width)
        row = words.row[at]
        ordinal = (at - words.first[row]) + joined("starts", "<u4").astype(np.int64)[row]
        order, same = _sorted_runs(words.hashes(), at, rule.width)
        same[:-1] |= same[1:]
        covered = np.zeros(len(at), bool)
        covered[order] = same
        covered &= joined("flags", "u1")[row] == 0
        first, last = _ranges(covered, row, ordinal)
        keys = np.concatenate([joined("keys", KEY)[row[first]], joined("known_keys", KEY)])
        begin = np.concatenate([ordinal[first].astype("<i4"), joined("known_begin", "<i4")])
        end = np.concatenate([(ordinal[last] + rule.width).astype("<i4"), joined("known_end", "<i4")])
        struct = pa.StructArray.from_arrays(
            [pa.array(np.ascontiguousarray(keys["a"])), pa.array(np.ascontiguousarray(keys["b"]))], ["a", "b"]
        )
        return pa.table({"_key": struct, "begin": pa.array(begin), "end": pa.array(end)})

    return count


def repeated_ranges(keyed: DataFrame, rule: Passages = Passages()) -> DataFrame:
    """Word ranges (_key, begin, end) covered by windows that occur more than once in ``keyed``.

    ``keyed`` has _key and _text. Consecutive windows that share their minimiser, the smallest hash
    of its runs of words, travel as one packed string to the minimiser's bucket; all windows with the
    same words meet there, are sorted, and neighbours are compared word by word. A task first sorts
    its own windows: of those that repeat within a chunk, one travels and the others are known to be
    repeated already. So a passage that any share of the documents hold comes to its bucket once per
    chunk.
    """
    buckets = rule.buckets_per_part * shuffle_parts(keyed)
    return (
        keyed.mapInArrow(_packer(rule, buckets), PACKED)
        .groupBy("bucket")
        .applyInArrow(_counter(rule), RANGE)
    )


def _remover(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches, "_text"):
        totals, gone, kept = [], [], []
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        ranges = batch.column("ranges").to_pylist()
        for text, found in zip(texts, ranges, strict=True):
            words = (text or b"").split()
            totals.append(len(words))
            if found:
                left, reached = [], 0
                for begin, end in sorted((x["begin"], x["end"]) for x in found):
                    left += words[reached:begin]
                    reached = max(reached, end)
                words = left + words[reached:]
            gone.append(totals[-1] - len(words))
            kept.append(b" ".join(words))
        names = [name for name in batch.schema.names if name not in ("_text", "ranges")]
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(name) for name in names],
                pa.array(totals, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ],
            names=[*names, "n_words", "n_removed", "kept_text"],
        )


def without_repeated_passages(
    docs: DataFrame, identifier: str = "doc_id", text: str = "text", rule: Passages = Passages()
) -> DataFrame:
    """One row per row of ``docs``: identifier, n_words, n_removed, kept_text.

    A word goes when a window of ``width`` words covers it whose words also start anywhere else, in
    the same document or another; all occurrences go. Windows are judged on the input. Kept words are
    joined by one space.

    Null text has no words, and documents shorter than a window lose none. Rows repeated in full are
    occurrences of their own, so they empty each other if a window fits. Null and repeated identifiers
    are allowed. An empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    keyed = docs.select(
        F.col(identifier).alias("_id"), row_key(identifier, text).alias("_key"), F.col(text).alias("_text")
    )
    ranges = (
        repeated_ranges(keyed.select("_key", "_text"), rule)
        .groupBy("_key")
        .agg(F.collect_set(F.struct("begin", "end")).alias("ranges"))
    )
    id_type = keyed.schema["_id"].dataType.simpleString()
    return (
        keyed.join(ranges, "_key", "left")
        .select("_id", "_text", "ranges")
        .mapInArrow(_remover, f"_id {id_type}, n_words bigint, n_removed bigint, kept_text string")
        .withColumnRenamed("_id", identifier)
    )
