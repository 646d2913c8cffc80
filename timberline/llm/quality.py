"""Quality scores learnt from heuristic labellers whose accuracies are estimated, not known."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.words import chunks, mixed, text_buffers, words_of

STATISTICS = (
    "words", "symbols", "capitals", "digits", "word_length", "variety", "commonest", "repeats", "bare", "lines",
)
GOOD, BAD, ABSTAIN = 0, 1, 2


@dataclass(frozen=True)
class Labeller:
    """Votes bad or good by ranges of one statistic, and else abstains."""

    statistic: str
    bad: tuple[float, float]
    good: tuple[float, float]
    least_words: int = 0

    def vote(self, table: dict[str, np.ndarray]) -> np.ndarray:
        value = table[self.statistic]
        votes = np.full(len(value), ABSTAIN)
        votes[(value >= self.good[0]) & (value <= self.good[1])] = GOOD
        votes[(value >= self.bad[0]) & (value <= self.bad[1])] = BAD
        votes[table["words"] < self.least_words] = ABSTAIN
        return votes


LABELLERS = (
    Labeller("symbols", (0.16, 1), (0, 0.12), 4),
    Labeller("capitals", (0.3, 1), (0, 0.2), 4),
    Labeller("variety", (0, 0.35), (0.45, 1), 20),
    Labeller("commonest", (0.2, 1), (0, 0.15), 20),
    Labeller("repeats", (0.08, 1), (0, 0.05), 12),
    Labeller("bare", (0.12, 1), (0, 0.08), 8),
    Labeller("word_length", (6.8, 1e9), (3.5, 6.5), 30),
    Labeller("lines", (0, 0.6), (0.8, 1), 40),
)


@dataclass(frozen=True)
class Scorer:
    """The hashed linear scorer and the bound of the sample it is fitted on."""

    labellers: tuple[Labeller, ...] = LABELLERS
    buckets: int = 2048
    steps: int = 400
    rate: float = 0.05
    decay: float = 1e-4
    sample_documents: int = 4000
    sample_bytes: int = 24_000_000
    rounds: int = 50
    chunk_bytes: int = 4_000_000
    chunk_rows: int = 2000


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _per_row(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _byte_classes() -> np.ndarray:
    """Lower-case letters and bytes of other characters 0, capitals 1, digits 2, white space 3, then each sign."""
    kinds = np.zeros(256, np.uint8)
    kinds[65:91] = 1
    kinds[48:58] = 2
    kinds[[9, 10, 11, 12, 13, 32]] = 3
    signs = [x for x in range(33, 127) if not chr(x).isalnum()]
    kinds[signs] = np.arange(4, 4 + len(signs))
    return kinds


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The statistics of each row. Rows without words have 0 words, and 0 or 1 where it is a share."""
    words = words_of(data, offsets)
    kinds = _byte_classes()[data]
    counts = np.diff(words.first)
    characters = _per_row((data & 0xC0) != 0x80, offsets)
    spaces = _per_row(kinds == 3, offsets)
    capitals = _per_row(kinds == 1, offsets)
    solid = np.maximum(characters - spaces, 1)
    hashes = words.hashes()
    row = words.row
    spot, size = np.unique(mixed(hashes ^ mixed(row.astype(np.uint64))), return_inverse=True)[1], None
    order = np.sort(row.astype(np.int64) * (1 << 32) + spot) if len(row) else np.zeros(0, np.int64)
    heads = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]])) if len(order) else order
    size = np.diff(np.append(heads, len(order)))
    owner = order[heads] >> 32
    commonest = np.zeros(len(counts))
    np.maximum.at(commonest, owner, size)
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    letters = np.concatenate([[0], np.cumsum((kinds < 3))])
    bare = letters[words.end] == letters[words.start]
    line_starts = np.concatenate([offsets[:-1][np.diff(offsets) > 0], np.flatnonzero(data == 10) + 1])
    line_starts = np.unique(line_starts[line_starts < len(data)])
    line_row = np.searchsorted(offsets, line_starts, "right") - 1
    line_words = np.searchsorted(words.start, line_starts)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes))])
    line_ends = np.append(line_words[1:], len(row))
    full = line_ends > line_words
    line_hash = mixed((sums[line_ends] - sums[line_words])[full] ^ mixed(line_row[full].astype(np.uint64)))
    lines = np.bincount(line_row[full], minlength=len(counts))
    distinct = np.bincount(line_row[full][np.unique(line_hash, return_index=True)[1]], minlength=len(counts))
    return {
        "words": counts.astype(np.float64),
        "symbols": _per_row(kinds > 3, offsets) / solid,
        "capitals": capitals / solid,
        "digits": _per_row(kinds == 2, offsets) / solid,
        "word_length": _share(characters - spaces, counts),
        "variety": _share(np.bincount(owner, minlength=len(counts)), counts),
        "commonest": _share(commonest, counts),
        "repeats": _share(np.bincount(row[again], minlength=len(counts)), counts),
        "bare": _share(np.bincount(row[bare], minlength=len(counts)), counts),
        "lines": np.where(lines > 0, _share(distinct, lines), 1.0),
    }


def patterns(table: dict[str, np.ndarray], labellers: tuple[Labeller, ...]) -> np.ndarray:
    """All votes on a row as one number, three values per labeller."""
    number = np.zeros(len(table["words"]), np.int64)
    for labeller in labellers:
        number = number * 3 + labeller.vote(table)
    return number


def features(data: np.ndarray, offsets: np.ndarray, table: dict[str, np.ndarray], buckets: int) -> np.ndarray:
    """Hashed features: shares of character-class trigrams, and each statistic's step on a scale."""
    rows = len(offsets) - 1
    kinds = _byte_classes()[data].astype(np.uint64)
    out = np.zeros((rows, buckets), np.float32)
    if len(kinds) > 2:
        grams = mixed((kinds[:-2] << np.uint64(16)) | (kinds[1:-1] << np.uint64(8)) | kinds[2:]) % np.uint64(buckets)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        within = row[2:] == row[:-2]
        flat = row[:-2][within] * buckets + grams[within].astype(np.int64)
        out += np.bincount(flat, minlength=rows * buckets).reshape(rows, buckets)
        out = np.sqrt(out / np.maximum(out.sum(axis=1, keepdims=True), 1))
    for number, name in enumerate(STATISTICS):
        value = np.log2(1 + table[name]) * 2 if name in ("words", "word_length") else table[name] * 40
        step = np.clip(value, 0, 63).astype(np.uint64)
        at = mixed(step + np.uint64((number + 1) << 32)) % np.uint64(buckets)
        np.add.at(out, (np.arange(rows), at.astype(np.int64)), 0.5)
    return out


def _counter(rule: Scorer):
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(3 ** len(rule.labellers), np.int64)
        for chunk in chunks(batches, "_text", rule.chunk_bytes, rule.chunk_rows):
            found = patterns(statistics(*text_buffers(chunk.column("_text"))), rule.labellers)
            sums += np.bincount(found, minlength=len(sums))
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["pattern", "n"])

    return count


def estimated(counts: dict[int, int], labellers: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns.

    Returned are the chance of being good for each pattern, and each labeller's estimated chances of
    voting good or bad, when it votes, on a good and on a bad document. Labellers count as independent
    given the class; they start as better than chance, which fixes the names of the classes. That one
    abstains is no evidence.
    """
    pattern = np.array(sorted(counts), np.int64)
    weight = np.array([counts[x] for x in pattern.tolist()], np.float64)
    votes = np.stack([pattern // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)])
    start = np.array([[0.97, 0.03], [0.6, 0.4]])  # alarms are rare on good documents, common on bad ones
    chances = np.repeat(start[None], labellers, axis=0)
    prior = np.array([0.7, 0.3])

    def expect(votes: np.ndarray) -> np.ndarray:
        evidence = np.concatenate([np.log(chances), np.zeros((labellers, 2, 1))], axis=2)
        logs = np.log(prior)[:, None] + sum(evidence[k][:, votes[k]] for k in range(labellers))
        odds = np.exp(logs - logs.max(axis=0))
        return odds / odds.sum(axis=0)

    for _ in range(rounds if len(pattern) else 0):
        share = expect(votes) * weight
        prior = (share.sum(axis=1) + 1) / (weight.sum() + 2)
        for k in range(labellers):
            hits = np.stack([np.bincount(votes[k], share[c], minlength=3)[:2] for c in (0, 1)])
            chances[k] = (hits + start) / (hits + start).sum(axis=1, keepdims=True)
    every = np.arange(3**labellers)
    return expect(np.stack([every // 3 ** (labellers - 1 - k) % 3 for k in range(labellers)]))[0], chances


def _trainer(rule: Scorer, posterior: np.ndarray):
    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels, used = [], [], 0
        for chunk in chunks(batches, "_text", rule.chunk_bytes, rule.chunk_rows):
            if used >= rule.sample_bytes:
                continue
            data, offsets = text_buffers(chunk.column("_text"))
            used += len(data)
            table = statistics(data, offsets)
            rows.append(features(data, offsets, table, rule.buckets))
            labels.append(posterior[patterns(table, rule.labellers)])
        if not rows:
            return
        x, y = np.concatenate(rows), np.concatenate(labels).astype(np.float32)
        weights, bias = np.zeros(x.shape[1]), 0.0
        first, second = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
        for step in range(1, rule.steps + 1):
            error = (1 / (1 + np.exp(-(x @ weights.astype(np.float32) + np.float32(bias))))) - y
            slope = np.append(x.T @ error / len(y) + rule.decay * weights, error.mean())
            first = 0.9 * first + 0.1 * slope
            second = 0.999 * second + 0.001 * slope**2
            move = rule.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
            weights, bias = weights - move[:-1], bias - move[-1]
        yield pa.RecordBatch.from_arrays(
            [pa.array([np.append(weights, bias).tolist()], pa.list_(pa.float64()))], names=["weights"]
        )

    return fit


def quality_scores(
    docs: DataFrame, rule: Scorer = Scorer(), identifier: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: identifier, posterior, score, predicted.

    Heuristic labellers vote good, bad or abstain on statistics of the whole text. Votes of all
    documents are counted by pattern, of which there are at most 3 to the power of the number of
    labellers; expectation-maximisation over these counts estimates each labeller's accuracy and the
    chance of being good of every pattern: ``posterior``. These chances are the labels of a linear
    model over hashed features, fitted on a bounded sample of ``sample_documents`` documents drawn by
    a hash: ``score``. ``predicted`` is 1, worth keeping, from a score of 0.5 on.

    Null and empty texts and texts without words are scored like any other: labellers mostly abstain.
    Repeated rows are scored each. An empty table gives an empty one. Other columns are ignored,
    whatever their names.
    """
    context = docs.sparkSession.sparkContext
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    found = (
        base.select("_text")
        .mapInArrow(_counter(rule), "pattern bigint, n bigint")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    counts = {row["pattern"]: row["n"] for row in found}
    posterior, _ = estimated(counts, len(rule.labellers), rule.rounds)
    total = max(1, sum(counts.values()))
    drawn = F.pmod(F.xxhash64("_id", "_text", F.lit("sample")), F.lit(total)) < rule.sample_documents
    fitted = (
        base.where(drawn)
        .select("_text")
        .limit(2 * rule.sample_documents)
        .repartition(1)
        .mapInArrow(_trainer(rule, posterior), "weights array<double>")
        .collect()
    )
    weights = np.array(fitted[0]["weights"]) if fitted else np.zeros(rule.buckets + 1)
    model = context.broadcast((posterior, weights))  # of a fixed size

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        posterior, weights = model.value
        for chunk in chunks(batches, "_text", rule.chunk_bytes, rule.chunk_rows):
            data, offsets = text_buffers(chunk.column("_text"))
            table = statistics(data, offsets)
            values = features(data, offsets, table, rule.buckets) @ weights[:-1] + weights[-1]
            values = 1 / (1 + np.exp(-np.clip(values, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [
                    chunk.column("_id"),
                    pa.array(posterior[patterns(table, rule.labellers)]),
                    pa.array(values),
                    pa.array((values >= 0.5).astype(np.int32)),
                ],
                names=["_id", "posterior", "score", "predicted"],
            )

    id_type = base.schema["_id"].dataType.simpleString()
    return base.mapInArrow(score, f"_id {id_type}, posterior double, score double, predicted int").withColumnRenamed(
        "_id", identifier
    )
