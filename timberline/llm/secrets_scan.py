"""Secrets in texts: fixed patterns, and strings that a Markov model takes for random ones."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.words import chunks, text_buffers

# The patterns, their least lengths and the order of the kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = (("assign", 8), ("access", 16), ("hex", 32))
LIKELY = r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=])|AKIA|[0-9a-f]{32}"""
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"

SPANS = "spans array<struct<kind:string,start:bigint,end:bigint>>"


@dataclass(frozen=True)
class RandomStrings:
    """A run of the alphabet is reported from this length and mean log-likelihood ratio on."""

    shortest: int = 20
    least_ratio: float = 0.75
    prior_transitions: float = 5.0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, each kind leftmost and without overlaps."""
    found = [
        (one.start(), 0, one.end())
        for one in re.finditer(ASSIGN, text, re.IGNORECASE | re.ASCII)
        if len(one[2]) >= KINDS[0][1]
    ]
    for kind, pattern in ((1, ACCESS), (2, HEX)):
        least = KINDS[kind][1]
        found += [(one.start(), kind, one.end()) for one in re.finditer(pattern, text) if len(one[0]) >= least]
    return sorted(found)


def _symbols() -> np.ndarray:
    """The number of each byte in the alphabet, or the alphabet's size."""
    codes = np.full(256, len(ALPHABET), np.uint8)
    codes[np.frombuffer(ALPHABET.encode(), np.uint8)] = np.arange(len(ALPHABET))
    return codes


def _found_in(chunk: pa.RecordBatch) -> dict[int, list[tuple[int, int, int]]]:
    """The base spans of the rows that may have any, in code points."""
    column = chunk.column("_text")
    likely = pc.fill_null(pc.match_substring_regex(column, LIKELY), False).to_numpy(zero_copy_only=False)
    return {row: base_spans(column[row].as_py()) for row in np.flatnonzero(likely).tolist()}


def _byte_mask(data: np.ndarray, offsets: np.ndarray, spans: dict[int, list[tuple[int, int, int]]]) -> np.ndarray:
    """Which bytes the spans cover."""
    covered = np.zeros(len(data) + 1, np.int32)
    for row, found in spans.items():
        if not found:
            continue
        begin, end = int(offsets[row]), int(offsets[row + 1])
        points = np.append(np.flatnonzero((data[begin:end] & 0xC0) != 0x80), end - begin) + begin
        for start, _, stop in found:
            covered[points[start]] += 1
            covered[points[stop]] -= 1
    return np.cumsum(covered)[:-1] > 0


def _pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbol numbers of all bytes, and which bytes continue a run of the alphabet within a row."""
    code = _symbols()[data]
    inside = code < len(ALPHABET)
    follows = inside.copy()
    follows[1:] &= inside[:-1]
    heads = offsets[:-1]
    follows[heads[heads < len(data)]] = False
    return code, follows


def _transitions(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = len(ALPHABET)
    counts = np.zeros((2, width * width), np.int64)
    for chunk in chunks(batches, "_text"):
        data, offsets = text_buffers(chunk.column("_text"))
        if not len(data):
            continue
        secret = _byte_mask(data, offsets, _found_in(chunk))
        code, follows = _pairs(data, offsets)
        at = np.flatnonzero(follows)
        pair = code[at - 1].astype(np.int32) * width + code[at]
        known = secret[at] & secret[at - 1]
        counts[1] += np.bincount(pair[known], minlength=width * width)
        counts[0] += np.bincount(pair[~known], minlength=width * width)
    yield pa.RecordBatch.from_arrays(
        [pa.array([0, 1], pa.int32()), pa.array(list(counts), pa.list_(pa.int64()))], names=["label", "counts"]
    )


def random_ratio(docs: DataFrame, rule: RandomStrings = RandomStrings(), text: str = "text") -> np.ndarray:
    """Log-likelihood ratios of each transition: random strings against ordinary identifiers.

    Labelled samples are the corpus itself: transitions inside matches of the fixed patterns are
    random, all others ordinary. All texts count; a fixed number of sums comes to the driver. There
    are two models of random strings, so two matrices: the one learnt, and a uniform one for random
    strings of other alphabets. Rare transitions fall back on how often their second symbol occurs.
    """
    width = len(ALPHABET)
    sums = (
        docs.select(F.col(text).alias("_text"))
        .mapInArrow(_transitions, "label int, counts array<bigint>")
        .select("label", F.posexplode("counts").alias("pair", "n"))
        .where("n > 0")
        .groupBy("label", "pair")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = np.zeros((2, width * width))
    for label, pair, n in sums:
        counts[label, pair] = n
    counts = counts.reshape(2, width, width)
    share = counts.sum(axis=1) + np.array([[0.5], [1.0]])
    share /= share.sum(axis=1, keepdims=True)
    prior = rule.prior_transitions
    ordinary, learnt = (
        (counts[k] + prior * share[k]) / (counts[k].sum(axis=1, keepdims=True) + prior) for k in (0, 1)
    )
    return np.log(np.stack([learnt, np.full((width, width), 1 / width)]) / ordinary)


def _scanner(ratio: np.ndarray, rule: RandomStrings):
    width = len(ALPHABET)

    def random_runs(data: np.ndarray, offsets: np.ndarray, covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        code, follows = _pairs(data, offsets)
        inside = code < width
        begin = np.flatnonzero(inside & ~follows)
        ends = inside.copy()
        ends[:-1] &= ~(follows[1:])
        end = np.flatnonzero(ends) + 1
        long = end - begin >= rule.shortest
        begin, end = begin[long], end[long]
        free = np.concatenate([[0], np.cumsum(covered, dtype=np.int32)])
        open_runs = free[end] == free[begin]
        begin, end = begin[open_runs], end[open_runs]
        # only the long runs are scored
        size = end - begin - 1
        heads = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(begin + 1 - heads, size)
        pair = code[at - 1].astype(np.int32) * width + code[at]
        good = np.zeros(len(begin), bool)
        for model in ratio if len(begin) else ():
            good |= np.add.reduceat(model.ravel()[pair], heads) >= rule.least_ratio * size
        return begin[good], end[good]

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "_text", 4_000_000):
            data, offsets = text_buffers(chunk.column("_text"))
            spans = _found_in(chunk)
            if len(data):
                begin, end = random_runs(data, offsets, _byte_mask(data, offsets, spans))
                rows = np.searchsorted(offsets, begin, "right") - 1
                for row, x, y in zip(rows.tolist(), begin.tolist(), end.tolist(), strict=True):
                    start = int(((data[offsets[row] : x] & 0xC0) != 0x80).sum())
                    spans.setdefault(row, []).append((start, len(KINDS), start + y - x))
            names = [*[kind for kind, _ in KINDS], "random"]
            lists = [
                [{"kind": names[kind], "start": start, "end": end} for start, kind, end in sorted(spans.get(row, ()))]
                for row in range(chunk.num_rows)
            ]
            kept = [name for name in chunk.schema.names if name != "_text"]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [*[chunk.column(name) for name in kept], pa.array(lists, kind)], names=[*kept, "spans"]
            )

    return scan


def secrets(
    docs: DataFrame, rule: RandomStrings = RandomStrings(), identifier: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: identifier and spans (kind, start, end) in code points.

    Matches of the fixed patterns are all reported; they may overlap between kinds. Beside them a
    maximal run of the alphabet that touches none of them is reported as "random" if its mean ratio
    reaches ``least_ratio``. Spans are ordered by start, then by kind.

    Null and empty texts have no spans. Rows that repeat are scanned each. An empty table gives an
    empty one. Other columns are ignored, whatever their names.
    """
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    scan = _scanner(random_ratio(docs, rule, text), rule)
    return base.mapInArrow(scan, f"_id {id_type}, {SPANS}").withColumnRenamed("_id", identifier)
