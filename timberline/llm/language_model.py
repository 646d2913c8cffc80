"""A gated recurrent language model: training, scoring of whole documents, and a unigram base."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
import heapq
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from timberline.llm.tables import settled, shuffle_parts
from timberline.llm.words import chunks, lower_ascii, text_buffers, words_of

END_HASH = np.uint64(0x8F1BBCDCBFA53E0B)
SAFE_LOGIT = 60.0
LOGIT_ROWS = 1 << 11
LONG_RUN = 8
LOOK_UP_BITS = 16
SCORED_STEPS = 8
ADAM_BLOCK = 1 << 15
KEPT_FIRST, KEPT_SECOND, ADAM_LEAST = 0.9, 0.995, 1e-6
# Terms of a series, and steps after which a weight without gradient has come to rest: 0.9 ** 256 < 2e-12.
LATE_TERMS, LATE_STEPS = 5, 256


@dataclass(frozen=True)
class Shape:
    """Sizes of the network and of its training.

    Symbols are the most frequent tokens and one for all others; ``classes`` times ``members`` of them.
    Training documents are read to their ends in windows of ``window`` tokens, ``batch`` of them side by
    side; between windows the state is carried and the gradient is cut. Documents are dealt over
    ``rounds`` of averaging. ``stretch`` bounds nothing any more and is only still accepted.
    """

    classes: int = 64
    members: int = 64
    hidden: int = 24
    window: int = 32
    stretch: int = 96
    batch: int = 64
    rounds: int = 2
    rate: float = 0.01
    slots: int = 512
    scoring_window: int = 64
    chunk_bytes: int = 8_000_000
    slices: int = 64
    seed: int = 5

    @property
    def symbols(self) -> int:
        return self.classes * self.members

    @property
    def other(self) -> int:
        """The symbol of all tokens that have none of their own; the next number starts a text."""
        return self.symbols - 1


@dataclass
class Vocabulary:
    """Token hashes in ascending order with their symbols, and the counts of all training tokens."""

    hashes: np.ndarray
    symbols: np.ndarray
    counts: np.ndarray
    tokens: int
    distinct: int

    @property
    def plain(self) -> tuple:
        """What a broadcast can hold on executors without this package."""
        return self.hashes, self.symbols, self.counts, self.tokens, self.distinct

    def look_up(self, hashes: np.ndarray, other: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of tokens, and the counts of those that have one of their own."""
        if not len(self.hashes):
            return np.full(len(hashes), other), np.zeros(len(hashes), np.int64)
        last = len(self.hashes) - 1
        edges = np.searchsorted(self.hashes, np.arange(1 << LOOK_UP_BITS, dtype=np.uint64) << np.uint64(64 - LOOK_UP_BITS))
        most = int(np.diff(edges, append=last + 1).max())
        if most > 8:  # hashes that share their first bits; those of words do not
            at = np.minimum(np.searchsorted(self.hashes, hashes), last)
        else:
            at = np.minimum(edges[hashes >> np.uint64(64 - LOOK_UP_BITS)], last)
            for _ in range(1, most):
                at += (self.hashes[at] < hashes) & (at < last)
        own = self.hashes[at] == hashes
        return np.where(own, self.symbols[at], other), np.where(own, self.counts[at], 0)


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all rows, each row's words and one end, and the bounds of rows in them."""
    data, offsets = text_buffers(column)
    words = words_of(lower_ascii(data), offsets)
    bounds = words.first + np.arange(len(words.first))
    tokens = np.empty(bounds[-1], np.uint64)
    ends = bounds[1:] - 1
    is_word = np.ones(len(tokens), bool)
    is_word[ends] = False
    tokens[is_word] = words.hashes()
    tokens[ends] = END_HASH
    return tokens, bounds


def _segments(sorted_values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(sorted_values):
        return np.zeros(1, np.int64)
    change = np.flatnonzero(sorted_values[1:] != sorted_values[:-1]) + 1
    return np.concatenate([[0], change, [len(sorted_values)]])


def _order(numbers: np.ndarray, most: int) -> np.ndarray:
    """The stable order of numbers from 0 to ``most``; in few bytes each, which sort by radix."""
    return np.argsort(numbers.astype(np.min_scalar_type(most)), kind="stable")


def _sums(rows: np.ndarray, numbers: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct numbers, and for each the sum of its rows."""
    order = _order(numbers, most)
    ordered = numbers[order]
    edges = _segments(ordered)
    starts, sizes = edges[:-1], np.diff(edges)
    rows = np.take(rows, order, axis=0, mode="clip")
    sums = np.take(rows, starts, axis=0, mode="clip")
    every = np.ones(len(rows), rows.dtype)
    for at in np.flatnonzero(sizes >= LONG_RUN).tolist():
        np.matmul(every[: sizes[at]], rows[starts[at] : edges[at + 1]], out=sums[at])
    some = np.flatnonzero(sizes < LONG_RUN)  # most numbers: their second rows are added at once, then their third ones
    for further in range(1, LONG_RUN - 1):
        some = some[sizes[some] > further]
        sums[some] += np.take(rows, starts[some] + further, axis=0, mode="clip")
    return ordered[starts], sums


# ---------------------------------------------------------------------------------------- counting


def _counter(shape: Shape, buckets: int):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, "_text", shape.chunk_bytes):
            tokens, _ = tokens_of(chunk.column("_text"))
            hashes, counts = np.unique(tokens, return_counts=True)
            bucket = (hashes % np.uint64(buckets)).astype(np.int32)
            order = _order(bucket, buckets)
            edges = _segments(bucket[order])
            rows = [order[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(bucket[row[0]]) for row in rows], pa.int32()),
                    pa.array([hashes[row].tobytes() for row in rows], pa.binary()),
                    pa.array([counts[row].astype("<u4").tobytes() for row in rows], pa.binary()),
                ],
                names=["bucket", "hashes", "counts"],
            )

    return count


def _sum_bucket(rows: pd.DataFrame) -> pd.DataFrame:
    hashes = np.frombuffer(b"".join(rows["hashes"]), "<u8")
    counts = np.frombuffer(b"".join(rows["counts"]), "<u4").astype(np.int64)
    order = np.argsort(hashes, kind="stable")
    starts = _segments(hashes[order])[:-1]
    sums = np.add.reduceat(counts[order], starts)
    return pd.DataFrame(
        {
            "bucket": [rows["bucket"].iloc[0]],
            "hashes": [hashes[order][starts].tobytes()],
            "counts": [sums.astype("<i8").tobytes()],
            "tokens": [int(sums.sum())],
            "distinct": [len(sums)],
        }
    )


def token_counts(base: DataFrame, shape: Shape, buckets: int) -> DataFrame:
    """Counts of all tokens of the training documents, one row per bucket of hashes."""
    return settled(
        base.where("_train")
        .select("_text")
        .mapInArrow(_counter(shape, buckets), "bucket int, hashes binary, counts binary")
        .groupBy("bucket")
        .applyInPandas(_sum_bucket, "bucket int, hashes binary, counts binary, tokens bigint, distinct bigint"),
        "lm-counts",
    )


def vocabulary(counts: DataFrame, shape: Shape) -> Vocabulary:
    """The most frequent tokens, as many as there are symbols but one, and the totals."""
    most = shape.symbols - 1

    def magnitudes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
            found = np.bincount(np.log2(sums).astype(np.int64), minlength=64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(64)), pa.array(found)], names=["power", "n"])

    totals = counts.agg(F.sum("tokens"), F.sum("distinct")).first()
    sizes = counts.select("counts").mapInArrow(magnitudes, "power bigint, n bigint")
    above, least = 0, 1
    for row in sizes.groupBy("power").agg(F.sum("n").alias("n")).orderBy(F.col("power").desc()).collect():
        above += row["n"]
        least = 1 << row["power"]
        if above >= most:
            break

    def top(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<i8")
            sums = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<i8")
            some = sums >= least  # what is rarer is not among the most frequent
            yield pa.RecordBatch.from_arrays([pa.array(hashes[some]), pa.array(sums[some])], names=["hash", "n"])

    rows = (
        counts.select("hashes", "counts")
        .mapInArrow(top, "hash bigint, n bigint")
        .orderBy(F.col("n").desc(), "hash")
        .limit(most)
        .collect()
    )
    hashes = np.array([row["hash"] for row in rows], np.int64).view(np.uint64)
    sums = np.array([row["n"] for row in rows], np.int64)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], order, sums[order], totals[0] or 0, totals[1] or 0)


# ---------------------------------------------------------------------------------------- network


class Network:
    """Weights: input rows per symbol, recurrence, class output and member outputs, biases in their last rows."""

    def __init__(self, shape: Shape, vector: np.ndarray | None = None):
        self.shape = shape
        h, c, m = shape.hidden, shape.classes, shape.members
        sizes = {"inputs": (shape.symbols + 1, 3 * h), "inner": (h, 3 * h), "classes": (h + 1, c), "members": (c, h + 1, m)}
        total = sum(math.prod(size) for size in sizes.values())
        self.vector = np.zeros(total, np.float32) if vector is None else vector.astype(np.float32)
        self.parts: dict[str, np.ndarray] = self.views(self.vector, sizes)
        self.sizes = sizes
        self.rooms: dict[str, np.ndarray] = {}

    def room(self, name: str, size: tuple, kind: np.dtype) -> np.ndarray:
        """An array of any content that the next call for this name gets again, as long as its size is the same."""
        found = self.rooms.get(name)
        if found is None or found.shape != size or found.dtype != kind:
            found = self.rooms[name] = np.empty(size, kind)
        return found

    @staticmethod
    def views(vector: np.ndarray, sizes: dict[str, tuple]) -> dict[str, np.ndarray]:
        parts, at = {}, 0
        for name, size in sizes.items():
            count = math.prod(size)
            parts[name] = vector[at : at + count].reshape(size)
            at += count
        return parts

    def initialise(self, words: Vocabulary) -> "Network":
        """Small random weights, and biases at which the network is the unigram model of its symbols."""
        random, h = np.random.default_rng(self.shape.seed), self.shape.hidden
        for name in ("inputs", "inner"):
            self.parts[name][:] = random.normal(0, 0.1, self.sizes[name])
        self.parts["classes"][:] = random.normal(0, 0.1, self.sizes["classes"])
        self.parts["members"][:, :h] = random.normal(0, 0.1, (self.shape.classes, h, self.shape.members))
        mass = np.full(self.shape.symbols, 1e-3)
        mass[words.symbols] += words.counts
        mass[self.shape.other] += words.tokens - words.counts.sum() + 1
        mass = mass.reshape(self.shape.classes, self.shape.members)
        self.parts["classes"][:h] *= 0.1
        self.parts["members"][:, :h] *= 0.1
        self.parts["classes"][h] = np.log(mass.sum(axis=1) / mass.sum())
        self.parts["members"][:, h] = np.log(mass / mass.sum(axis=1, keepdims=True))
        return self

    def step(self, symbols: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, tuple]:
        h = self.shape.hidden
        given = self.parts["inputs"][symbols]
        held = state @ self.parts["inner"]
        gates = 1 / (1 + np.exp(-(given[:, : 2 * h] + held[:, : 2 * h])))
        keep, reset = gates[:, :h], gates[:, h:]
        fresh = np.tanh(given[:, 2 * h :] + reset * held[:, 2 * h :])
        return fresh + keep * (state - fresh), (symbols, state, keep, reset, fresh, held[:, 2 * h :])

    def forward(self, inputs: np.ndarray, state: np.ndarray, fresh: np.ndarray | None) -> tuple[np.ndarray, ...]:
        """``step`` over a window of (steps, rows) from a state of (unit, row): states before, gates, held, new, states after.

        Within a step all lies as (unit, row), so that gates are runs in memory. What is returned is
        overwritten by the next call for a window of this size.
        """
        steps, rows = inputs.shape
        h = self.shape.hidden
        kind = np.result_type(state, self.vector)
        given = self.room("given", (steps, 3 * h, rows), self.vector.dtype)
        taken = self.room("taken", (steps, rows, 3 * h), self.vector.dtype)
        given[:] = np.take(self.parts["inputs"], inputs, axis=0, out=taken, mode="clip").transpose(0, 2, 1)
        befores, states, new = (self.room(name, (steps, h, rows), kind) for name in ("befores", "states", "new"))
        held = self.room("held", (steps, 3 * h, rows), kind)
        begins = np.zeros(steps, bool) if fresh is None else fresh.any(axis=1)
        turned = np.ascontiguousarray(self.parts["inner"].T)
        turned[: 2 * h] *= -1  # gates need the exponential of what is taken off
        for t in range(steps):
            before, gate, reached, kept = befores[t], given[t, : 2 * h], new[t], held[t]
            before[:] = state
            if begins[t]:
                before[:, fresh[t]] = 0
            np.dot(turned, before, out=kept)
            np.subtract(kept[: 2 * h], gate, out=gate)
            np.exp(gate, out=gate)
            gate += 1
            np.reciprocal(gate, out=gate)
            np.multiply(gate[h:], kept[2 * h :], out=reached)
            reached += given[t, 2 * h :]
            np.tanh(reached, out=reached)
            state = np.subtract(before, reached, out=states[t])
            state *= gate[:h]
            state += reached
        return befores, given, held, new, states

    @staticmethod
    def runs(owner: np.ndarray) -> list[tuple[int, int, int]]:
        """The run (class, begin, end) of each class, of classes in ascending order."""
        edges = _segments(owner).tolist() if len(owner) else []
        return [(number, x, y) for number, x, y in zip(owner[edges[:-1]].tolist(), edges[:-1], edges[1:], strict=True)]

    def member_logits(self, states: np.ndarray, runs: list, out: np.ndarray) -> np.ndarray:
        weights = list(self.parts["members"])
        for number, x, y in runs:
            np.dot(states[x:y], weights[number], out=out[x:y])
        return out

    @staticmethod
    def bounded(logits: np.ndarray) -> None:
        """Takes each row's maximum off, if some logit is so large or small that its exponential might not fit."""
        if logits.size and not (logits.max() < SAFE_LOGIT and logits.min() > -SAFE_LOGIT):
            logits -= logits.max(axis=1, keepdims=True)

    @staticmethod
    def row_sums(values: np.ndarray) -> np.ndarray:
        return values @ np.ones(values.shape[1], values.dtype)

    @staticmethod
    def log_softmax_at(logits: np.ndarray, wanted: np.ndarray, safe: bool = False) -> np.ndarray:
        """The logarithm of each row's softmax at one column; overwrites the logits. ``safe``: none is too large."""
        if not safe:
            Network.bounded(logits)
        chosen = logits[np.arange(len(wanted)), wanted]
        return chosen - np.log(Network.row_sums(np.exp(logits, out=logits)))

    @staticmethod
    def softmax_error(logits: np.ndarray, wanted: np.ndarray, share: np.ndarray) -> np.ndarray:
        """The gradient of the weighted loss by the logits, in their place."""
        logits *= Network.unscaled_error(logits, wanted, share)
        return logits

    @staticmethod
    def unscaled_error(logits: np.ndarray, wanted: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Puts in the logits' place what has to be multiplied, row by row, by what is returned."""
        Network.bounded(logits)
        np.exp(logits, out=logits)
        sums = Network.row_sums(logits)
        logits[np.arange(len(wanted)), wanted] -= sums
        return (share / sums)[:, None]

    def log_chances(self, states: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithms: the class's chance times the member's within the class."""
        c, m = self.shape.classes, self.shape.members
        owner = targets // m
        order = _order(owner, c)
        owner, member = owner[order], targets[order] % m
        kind = np.result_type(states, self.vector)
        ordered = np.ones((len(targets), self.shape.hidden + 1), kind)
        np.take(states, order, axis=0, out=ordered[:, :-1], mode="clip")
        out = np.empty(len(targets), kind)
        # units within -1 and 1 and the one of the biases: no logit is larger than its column's weights together
        widest = max(float(np.abs(self.parts[name]).sum(axis=-2).max()) for name in ("classes", "members"))
        safe = widest < SAFE_LOGIT and bool(np.abs(ordered).max(initial=0) <= 1)
        for begin in range(0, len(targets), LOGIT_ROWS):  # so many logits stay in the cache
            part = slice(begin, begin + LOGIT_ROWS)
            rows, own = ordered[part], owner[part]
            logits = self.room("class_logits", (len(rows), c), kind)
            found = self.log_softmax_at(np.matmul(rows, self.parts["classes"], out=logits), own, safe)
            logits = self.member_logits(rows, self.runs(own), self.room("logits", (len(rows), m), kind))
            found += self.log_softmax_at(logits, member[part], safe)
            out[order[part]] = found
        return out

    def gradient(
        self,
        inputs: np.ndarray,
        targets: np.ndarray,
        weights: np.ndarray,
        state: np.ndarray,
        fresh: np.ndarray | None = None,
        grad: np.ndarray | None = None,
    ) -> tuple[np.ndarray, np.ndarray]:
        """The gradient of the mean loss over one window of (steps, rows), and the state after it.

        Where ``fresh`` holds a document begins: the state is cleared and no gradient flows back.
        ``grad`` is overwritten but for the input rows of other symbols than ``inputs``.
        """
        steps, rows = inputs.shape
        c, h, m = self.shape.classes, self.shape.hidden, self.shape.members
        befores, given, held, new, states = self.forward(inputs, state.T, fresh)
        begins = np.zeros(steps, bool) if fresh is None else fresh.any(axis=1)
        kind, count = states.dtype, steps * rows
        keep, reset = given[:, :h], given[:, h : 2 * h]
        if grad is None:
            grad = np.zeros_like(self.vector)
        parts = self.views(grad, self.sizes)
        flat, wanted = self.room("flat", (count, h + 1), kind), targets.ravel()
        flat[:, h] = 1
        flat.reshape(steps, rows, h + 1)[:, :, :h] = states.transpose(0, 2, 1)
        order = _order(wanted // m, c)
        ordered = np.take(flat, order, axis=0, out=self.room("ordered", (count, h + 1), kind), mode="clip")
        share = (weights.ravel()[order] / max(1.0, float(weights.sum()))).astype(np.float32)
        wanted = wanted[order]
        owner = wanted // m
        logits = np.matmul(ordered, self.parts["classes"], out=self.room("class_logits", (count, c), kind))
        # rows of few units are scaled rather than those of many errors
        scaled = self.room("scaled", (count, h + 1), kind)
        scale = self.unscaled_error(logits, owner, share)
        np.matmul(np.multiply(ordered, scale, out=scaled).T, logits, out=parts["classes"])
        back = logits @ self.parts["classes"][:h].T
        back *= scale
        runs = self.runs(owner)
        logits = self.member_logits(ordered, runs, self.room("logits", (count, m), kind))
        scale = self.unscaled_error(logits, wanted % m, share)
        np.multiply(ordered, scale, out=scaled)
        inner_back = self.room("inner_back", (count, h), kind)
        parts["members"][:] = 0
        grads, weights_back = list(parts["members"]), list(self.parts["members"][:, :h].transpose(0, 2, 1))
        for number, x, y in runs:
            own = logits[x:y]
            np.dot(scaled[x:y].T, own, out=grads[number])
            np.dot(own, weights_back[number], out=inner_back[x:y])
        inner_back *= scale
        back += inner_back
        inner_back[order] = back
        flows = self.room("flows", (steps, h, rows), kind)
        flows[:] = inner_back.reshape(steps, rows, h).transpose(0, 2, 1)
        # what the flow of a step is multiplied by, for all steps at once
        less = np.subtract(1, keep, out=self.room("less", (steps, h, rows), kind))
        to_keep = np.subtract(befores, new, out=self.room("to_keep", (steps, h, rows), kind))
        to_keep *= keep
        to_keep *= less
        to_new = np.multiply(new, new, out=new)
        np.subtract(1, to_new, out=to_new)
        to_new *= less
        to_held = self.room("to_held", (steps, 2, h, rows), kind)
        np.subtract(1, reset, out=less)
        less *= reset
        np.multiply(held[:, 2 * h :], less, out=to_held[:, 0])
        to_held[:, 1] = reset
        flow = np.zeros((h, rows), kind)
        d_held = self.room("d_held", (steps, 3, h, rows), kind)
        d_new = self.room("d_new", (steps, h, rows), kind)
        inner, d_rows = self.parts["inner"], d_held.reshape(steps, 3 * h, rows)
        turned_back = self.room("turned_back", (h, rows), kind)
        for t in range(steps - 1, -1, -1):
            flow += flows[t]
            np.multiply(flow, to_new[t], out=d_new[t])
            np.multiply(flow, to_keep[t], out=d_held[t, 0])
            np.multiply(d_new[t], to_held[t], out=d_held[t, 1:])
            flow *= keep[t]
            flow += np.dot(inner, d_rows[t], out=turned_back)
            if begins[t]:
                flow[:, fresh[t]] = 0
        along = self.room("along", (3, h, steps, rows), kind)
        along[:] = d_held.transpose(1, 2, 0, 3)
        parts["inner"][:] = befores.transpose(1, 0, 2).reshape(h, -1) @ along.reshape(3 * h, -1).T
        d_held[:, 2] = d_new
        d_given = self.room("d_given", (steps, rows, 3 * h), kind)
        d_given[:] = d_held.reshape(steps, 3 * h, rows).transpose(0, 2, 1)
        symbols, sums = _sums(d_given.reshape(-1, 3 * h), inputs.ravel(), self.shape.symbols)
        parts["inputs"][symbols] = sums
        return grad, states[-1].T.copy()


class Adam:
    """Adam's steps on a network's weights. Input rows without gradient are moved once they are needed.

    Such a row goes on moving by its running means alone: in the j-th step by scale * first * a ** j /
    (b ** j * root + least), with root the square root of the second mean, a = 0.9 and b ** 2 = 0.995.
    As 1 / (b ** j * root + least) is the sum over n of ((1 - b ** j) * part) ** n / (root + least), with
    part = root / (root + least), all its steps come to a polynomial in part, whose coefficients depend
    on the step of its last gradient only. Five terms give the sum to about 1e-6 of itself.
    """

    def __init__(self, net: Network, rate: float):
        self.net, self.rate, self.step = net, rate, 0
        self.grad = np.zeros_like(net.vector)
        # without the factors 0.1 and 0.005 of new gradients, which cancel out but for one of all steps
        self.first, self.second = np.zeros_like(net.vector), np.zeros_like(net.vector)
        self.factor, self.least = 0.1 / math.sqrt(0.005), ADAM_LEAST / math.sqrt(0.005)
        rows = net.parts["inputs"].shape
        self.rest = rows[0] * rows[1]
        self.rows = tuple(part[: self.rest].reshape(rows) for part in (net.vector, self.grad, self.first, self.second))
        self.done = np.zeros(rows[0], np.int64)
        self.due: tuple[np.ndarray, ...] = ()
        late = np.arange(LATE_STEPS, 0, -1)
        self.fading = KEPT_FIRST**late * (1 - KEPT_SECOND ** (late / 2)) ** np.arange(LATE_TERMS)[:, None]
        self.late = np.zeros((LATE_TERMS, 0))

    def need(self, symbols: np.ndarray) -> None:
        """Brings the input rows of distinct symbols to where all steps so far have moved them; ``apply`` has to follow."""
        rows, _, *means = self.rows
        done = self.done[symbols]
        if self.step >= self.late.shape[1]:
            self.late = np.concatenate([self.late, np.zeros((LATE_TERMS, 1024))], axis=1)
            self.fades = (np.array([[KEPT_FIRST], [KEPT_SECOND]]) ** np.arange(self.late.shape[1])).astype(np.float32)
        fades = self.fades[:, self.step - done, None]
        weights, first, second = (np.take(part, symbols, axis=0, mode="clip") for part in (rows, *means))
        root = np.sqrt(second)
        below = root + np.float32(self.least)
        root /= below
        terms = self.late[:, done].astype(np.float32)[:, :, None]
        moved = root * terms[-1]
        for term in terms[-2:0:-1]:
            moved += term
            moved *= root
        moved += terms[0]
        moved *= first
        moved /= below
        weights -= moved
        rows[symbols] = weights
        first *= fades[0]
        second *= fades[1]
        self.due = symbols, weights, first, second

    def apply(self) -> None:
        """One step along the gradient in ``grad``, of whose input rows only those of the last ``need`` are looked at."""
        self.step += 1
        symbols, *due = self.due
        given, rest = np.take(self.rows[1], symbols, axis=0, mode="clip"), self.grad[self.rest :]
        size = math.sqrt(float(rest @ rest) + float(given.ravel() @ given.ravel())) + 1e-8
        clip = min(1.0, 1.0 / size)
        scale = self.factor * self.rate * math.sqrt(1 - KEPT_SECOND**self.step) / (1 - KEPT_FIRST**self.step)
        self._move(due[0], given, *due[1:], clip, scale)
        for part, moved in zip((self.rows[0], *self.rows[2:]), due, strict=True):
            part[symbols] = moved
        self.done[symbols] = self.step
        for begin in range(self.rest, len(self.grad), ADAM_BLOCK):  # a block at a time, which stays in the cache
            part = slice(begin, begin + ADAM_BLOCK)
            self._move(self.net.vector[part], self.grad[part], self.first[part], self.second[part], clip, scale)
        count = min(self.step, LATE_STEPS)
        self.late[:, self.step - count : self.step] += scale * self.fading[:, LATE_STEPS - count :]

    def _move(self, weights, grad, first, second, clip: float, scale: float) -> None:
        """Dense steps; overwrites the gradient."""
        if clip < 1:
            grad *= clip
        first *= KEPT_FIRST
        first += grad
        grad *= grad
        second *= KEPT_SECOND
        second += grad
        np.sqrt(second, out=grad)
        grad += self.least
        np.divide(first, grad, out=grad)
        grad *= scale
        weights -= grad


# ---------------------------------------------------------------------------------------- training


@dataclass
class Streams:
    """Documents laid one behind another in slots, all as (steps, slots): ``owner`` is -1 behind the last."""

    owner: np.ndarray
    given: np.ndarray
    wanted: np.ndarray
    fresh: np.ndarray


def streams(symbols: np.ndarray, bounds: np.ndarray, most: int, start: int, place: np.ndarray | None = None) -> Streams:
    """Documents dealt to at most ``most`` slots, the longest first, so that slots are about equally long.

    In a slot they follow in the order of ``place``. ``start`` is given where a document begins.
    """
    sizes = np.diff(bounds)
    count = int(np.clip(sizes.sum() // max(int(sizes.max()), 64), 1, most))
    load = [(0, slot) for slot in range(count)]
    dealt: list[list[int]] = [[] for _ in range(count)]
    for doc in np.argsort(-sizes, kind="stable").tolist():
        reached, slot = heapq.heappop(load)
        dealt[slot].append(doc)
        heapq.heappush(load, (reached + int(sizes[doc]), slot))
    length = max(reached for reached, _ in load)
    owner = np.full((count, length), -1, np.int64)
    given = np.full((count, length), start, np.int64)
    wanted = np.zeros((count, length), np.int64)
    fresh = np.ones((count, length), bool)
    for slot, docs in enumerate(dealt):
        at = 0
        for doc in docs if place is None else sorted(docs, key=place.__getitem__):
            size = int(sizes[doc])
            own = symbols[bounds[doc] : bounds[doc + 1]]
            owner[slot, at : at + size] = doc
            wanted[slot, at : at + size] = own
            given[slot, at + 1 : at + size] = own[:-1]
            fresh[slot, at + 1 : at + size] = False
            at += size
    return Streams(owner.T, given.T, wanted.T, fresh.T)


def learn(net: Network, adam: Adam, symbols: np.ndarray, bounds: np.ndarray, place: np.ndarray) -> int:
    """Steps along whole documents, every token in one of them; returns the tokens learnt from."""
    shape = net.shape
    if len(bounds) < 2:
        return 0
    laid = streams(symbols, bounds, shape.batch, shape.symbols, place)
    state, used = np.zeros((laid.owner.shape[1], shape.hidden), np.float32), 0
    for begin in range(0, len(laid.owner), shape.window):
        part = slice(begin, begin + shape.window)
        inside = (laid.owner[part] >= 0).astype(np.float32)
        given, wanted, fresh = (np.ascontiguousarray(each[part]) for each in (laid.given, laid.wanted, laid.fresh))
        adam.need(np.flatnonzero(np.bincount(given.ravel())))
        _, state = net.gradient(given, wanted, inside, state, fresh, adam.grad)
        adam.apply()
        used += int(inside.sum())
    return used


def _trainer(shape: Shape, model):
    def train(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, vector = Vocabulary(*model.value[0]), model.value[1]
        net, used = Network(shape, vector), 0
        adam = Adam(net, shape.rate)
        for chunk in chunks(batches, "_text", shape.chunk_bytes):
            tokens, bounds = tokens_of(chunk.column("_text"))
            symbols, _ = words.look_up(tokens, shape.other)
            used += learn(net, adam, symbols, bounds, chunk.column("_place").to_numpy())
        if used:
            adam.need(np.arange(len(adam.done)))
            pieces = np.array_split(net.vector, shape.slices)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(shape.slices, dtype=np.int32)),
                    pa.array([used] * shape.slices, pa.int64()),
                    pa.array([piece.astype("<f4").tobytes() for piece in pieces], pa.binary()),
                ],
                names=["slice", "used", "weights"],
            )

    return train


def _average(rows: pd.DataFrame) -> pd.DataFrame:
    total = rows["used"].sum()
    mean = sum(np.frombuffer(w, "<f4").astype(np.float64) * (n / total) for w, n in zip(rows["weights"], rows["used"], strict=True))
    return pd.DataFrame({"slice": [rows["slice"].iloc[0]], "weights": [np.asarray(mean).astype("<f4").tobytes()]})


def trained(base: DataFrame, words: Vocabulary, shape: Shape) -> np.ndarray:
    """Rounds of local training in every task over its documents, then an average weighted by tokens.

    Every training document takes part in one round, with all its tokens. What the driver gets is one set of weights.
    """
    context = base.sparkSession.sparkContext
    vector = Network(shape).initialise(words).vector
    place = F.pmod(F.xxhash64("_id", F.lit(shape.seed)), F.lit(1 << 30))
    for number in range(shape.rounds):
        rows = (
            base.where("_train")
            .select("_text", place.alias("_place"))
            .where(F.pmod(F.xxhash64("_place"), F.lit(shape.rounds)) == number)
            .mapInArrow(_trainer(shape, context.broadcast((words.plain, vector))), "slice int, used bigint, weights binary")
            .groupBy("slice")
            .applyInPandas(_average, "slice int, weights binary")
            .orderBy("slice")
            .collect()
        )
        if rows:
            vector = np.frombuffer(b"".join(bytes(row["weights"]) for row in rows), "<f4")
    return vector


# ---------------------------------------------------------------------------------------- scoring


def document_scores(net: Network, symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The natural log-likelihood of each document's symbols.

    Slots are read in step; a slot's state is carried from window to window and cleared where a document
    begins.
    """
    shape = net.shape
    sizes = np.diff(bounds)
    if not len(sizes):
        return np.zeros(0)
    laid = streams(symbols, bounds, shape.slots, shape.symbols)
    length, count = laid.owner.shape
    total = np.zeros(len(sizes))
    state = np.zeros((shape.hidden, count), np.float32)
    for begin in range(0, length, shape.scoring_window):
        end = min(begin + shape.scoring_window, length)
        states = np.empty((end - begin, count, shape.hidden), np.float32)
        given, fresh = (np.ascontiguousarray(each[begin:end]) for each in (laid.given, laid.fresh))
        for t in range(0, end - begin, SCORED_STEPS):
            part = slice(t, t + SCORED_STEPS)
            reached = net.forward(given[part], state, fresh[part])[-1]
            state = reached[-1].copy()
            states[part] = reached.transpose(0, 2, 1)
        states, live, wanted = states.reshape(-1, shape.hidden), laid.owner[begin:end].ravel(), laid.wanted[begin:end].ravel()
        if live.min() < 0:  # behind a slot's last document
            used = np.flatnonzero(live >= 0)
            states, live, wanted = states[used], live[used], wanted[used]
        total += np.bincount(live, net.log_chances(states, wanted), len(sizes))
    return total


ASKED = "bucket int, rows int, hashes binary, repeats binary, owners binary"


def _scorer(shape: Shape, model, buckets: int, id_type):
    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        words, vector = Vocabulary(*model.value[0]), model.value[1]
        net, codec = Network(shape, vector), zstandard.ZstdCompressor(level=3)
        task = TaskContext.get().partitionId() << 32
        for number, chunk in enumerate(chunks(batches, "_text", shape.chunk_bytes)):
            name = task + number
            tokens, bounds = tokens_of(chunk.column("_text"))
            symbols, counts = words.look_up(tokens, shape.other)
            rows = len(bounds) - 1
            row = np.repeat(np.arange(rows), np.diff(bounds))
            own = symbols != shape.other
            known = np.bincount(row[own], minlength=rows)
            base = np.bincount(row[own], np.log10(counts[own] + 1.0), rows)
            chances = document_scores(net, symbols, bounds) / np.log(10)
            yield _rows(
                id_type,
                chunk=[name] * rows,
                _id=chunk.column("_id"),
                _train=chunk.column("_train"),
                ordinal=np.arange(rows, dtype=np.int32),
                n_tokens=np.diff(bounds),
                known=known,
                base=base,
                chances=chances,
            )
            # tokens without a symbol of their own are asked for in the buckets of their hashes
            rest = np.flatnonzero(~own)
            rest = rest[np.argsort(tokens[rest], kind="stable")]  # a token's places stay in the order of rows
            bucket = (tokens[rest] % np.uint64(buckets)).astype(np.int64)
            turn = _order(bucket, buckets)
            order, bucket = rest[turn], bucket[turn]
            hashes = tokens[order]
            edges = _segments(bucket)
            asked: dict[str, list] = {key: [] for key in ("bucket", "hashes", "repeats", "owners")}
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                if x == y:
                    continue
                runs = _segments(hashes[x:y])
                asked["bucket"].append(int(bucket[x]))
                asked["hashes"].append(hashes[x:y][runs[:-1]].tobytes())
                asked["repeats"].append(codec.compress(np.diff(runs).astype("<u4").tobytes()))
                asked["owners"].append(codec.compress(row[order[x:y]].astype("<u4").tobytes()))
            count = len(asked["bucket"])
            if count:
                yield _rows(id_type, chunk=[name] * count, rows=[rows] * count, **asked)

    return score


def _scored_schema(id_type) -> pa.Schema:
    return pa.schema(
        [
            ("chunk", pa.int64()), ("_id", id_type), ("_train", pa.bool_()), ("ordinal", pa.int32()),
            ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("chances", pa.float64()),
            ("bucket", pa.int32()), ("rows", pa.int32()), ("hashes", pa.binary()), ("repeats", pa.binary()),
            ("owners", pa.binary()),
        ]
    )


def _rows(id_type, **columns) -> pa.RecordBatch:
    count = len(columns["chunk"])
    schema = _scored_schema(id_type)
    arrays = [
        pa.array(columns[field.name], field.type)
        if field.name in columns and not isinstance(columns[field.name], pa.Array)
        else columns.get(field.name, pa.nulls(count, field.type))
        for field in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _answer(asked: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
    """For each chunk that asks: per document the sum of log10(count + 1) and the known tokens."""
    import zstandard

    codec = zstandard.ZstdDecompressor()
    hashes = np.frombuffer(b"".join(counted["hashes"]), "<u8")
    counts = np.frombuffer(b"".join(counted["counts"]), "<i8")
    sums, known = [], []
    for wanted, repeats, owners, rows in zip(
        asked["hashes"], asked["repeats"], asked["owners"], asked["rows"], strict=True
    ):
        own = np.frombuffer(wanted, "<u8")
        found = np.zeros(len(own), np.int64)
        if len(hashes):
            at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
            found = np.where(hashes[at] == own, counts[at], 0)
        times = np.frombuffer(codec.decompress(repeats), "<u4")
        owner = np.frombuffer(codec.decompress(owners), "<u4")
        sums.append(np.bincount(owner, np.repeat(np.log10(found + 1.0), times), rows).astype("<f8").tobytes())
        known.append(np.bincount(owner[np.repeat(found > 0, times)], minlength=rows).astype("<u4").tobytes())
    return pd.DataFrame({"chunk": asked["chunk"], "sums": sums, "known": known})


def _finish(totals: tuple[int, int, int, int]):
    tokens, distinct, own_tokens, own_distinct = totals
    every = np.log10(tokens + distinct + 1.0)
    others = np.log10((tokens - own_tokens) + (distinct - own_distinct) + 1.0)

    def finish(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        docs = docs.sort_values("ordinal", kind="stable")
        rest, known = np.zeros(len(docs)), docs["known"].to_numpy().copy()
        own = known.copy()
        for sums, more in zip(answers["sums"], answers["known"], strict=True):
            rest += np.frombuffer(sums, "<f8")
            known += np.frombuffer(more, "<u4")
        size = docs["n_tokens"].to_numpy()
        return pd.DataFrame(
            {
                "_id": docs["_id"],
                "_train": docs["_train"],
                "n_tokens": size,
                "n_known": known,
                "base_score": docs["base"].to_numpy() + rest - size * every,
                "score": docs["chances"].to_numpy() + rest - (size - own) * others,
            }
        )

    return finish


def language_scores(
    docs: DataFrame, held_out: Column, shape: Shape = Shape(), identifier: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: identifier, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased) and one end. Rows where ``held_out`` holds are not learnt
    from. ``base_score`` is the log10 probability under add-one unigram counts of all training tokens.
    ``score`` is that of the recurrent network over whole documents, its state carried across windows:
    chances of a class, of a symbol in the class, and for tokens without a symbol their share of the
    remaining counts plus one.

    Counts live in buckets of token hashes. A task asks each bucket for its tokens' counts once and
    gets sums per document back, so neither texts nor the counts are copied to every task; the driver
    holds the symbols, the weights and totals. Both have fixed sizes.

    Null and empty texts are the end token alone. Repeated rows count and are scored each; null
    identifiers are passed on. Without training rows all tokens are unknown. An empty table gives an
    empty one. Other columns are ignored, whatever their names.
    """
    buckets = shuffle_parts(docs)
    base = docs.select(
        F.col(identifier).alias("_id"),
        F.col(text).alias("_text"),
        (~F.coalesce(held_out, F.lit(False))).alias("_train"),
    )
    counts = token_counts(base, shape, buckets)
    words = vocabulary(counts, shape)
    vector = trained(base, words, shape)
    model = docs.sparkSession.sparkContext.broadcast((words.plain, vector))
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(base.schema["_id"].dataType)
    schema = (
        f"chunk bigint, _id {base.schema['_id'].dataType.simpleString()}, _train boolean, ordinal int, n_tokens bigint, "
        f"known bigint, base double, chances double, {ASKED}"
    )
    scored = settled(base.mapInArrow(_scorer(shape, model, buckets, id_type), schema), "lm-scored")
    answers = (
        scored.where("bucket is not null")
        .select("chunk", "bucket", "rows", "hashes", "repeats", "owners")
        .groupBy("bucket")
        .cogroup(counts.select("bucket", "hashes", "counts").groupBy("bucket"))
        .applyInPandas(_answer, "chunk bigint, sums binary, known binary")
    )
    totals = (words.tokens, words.distinct, int(words.counts.sum()), len(words.counts))
    id_name = base.schema["_id"].dataType.simpleString()
    return (
        scored.where("bucket is null")
        .select("chunk", "_id", "_train", "ordinal", "n_tokens", "known", "base", "chances")
        .groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInPandas(
            _finish(totals),
            f"_id {id_name}, _train boolean, n_tokens bigint, n_known bigint, base_score double, score double",
        )
        .select(
            F.col("_id").alias(identifier),
            (~F.col("_train")).alias("held_out"),
            "n_tokens",
            "n_known",
            F.lit(words.tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )
