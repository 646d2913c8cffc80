"""Toxicity scores from bags of subwords: embeddings averaged into a linear softmax."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from timberline.llm.words import chunks, lower_ascii, mixed, text_buffers, words_of


@dataclass(frozen=True)
class Subwords:
    """Character n-grams, by bytes, of words between markers; averaged over segments of a text.

    Within a segment a word counts once, so that repetition is no evidence."""

    shortest: int = 3
    longest: int = 5
    buckets: int = 1 << 18
    segment_words: int = 24
    prior_grams: int = 200
    start_margin: float = 5.0
    dimensions: int = 4
    epochs: int = 10
    least_steps: int = 400
    rate: float = 0.5
    decay: float = 1e-7
    batch_docs: int = 64
    documents_per_label: int = 1000
    training_bytes: int = 8_000_000
    chunk_bytes: int = 1_000_000
    seed: int = 11


def gram_parts(data: np.ndarray, offsets: np.ndarray, rule: Subwords):
    """First segment of each row, and for each length the n-gram numbers and their segments, in order.

    A word is its bytes between a start and an end marker. Rows without words have no segment.
    """
    words = words_of(lower_ascii(data), offsets)
    counts = np.diff(words.first)
    per_row = -(-counts // rule.segment_words)
    row_segment = np.concatenate([[0], np.cumsum(per_row)])
    place = np.arange(len(words.start)) - np.repeat(words.first[:-1], counts)
    word_segment = (np.repeat(row_segment[:-1], counts) + place // rule.segment_words).astype(np.int32)
    # a word that repeats within its segment counts once
    _, kept = np.unique(words.hashes() ^ mixed(word_segment.astype(np.uint64)), return_index=True)
    kept.sort()
    starts, word_segment = words.start[kept], word_segment[kept]
    # all words with markers, one after the other
    size = words.end[kept] - starts
    begin = np.cumsum(size + 2) - (size + 2)
    total = int((size + 2).sum())
    parts = []
    if total:
        at = np.arange(total) - np.repeat(begin - starts + 1, size + 2)
        marked = words.data[np.clip(at, 0, len(words.data) - 1)]
        marked[begin] = 2
        marked[begin + size + 1] = 3
        left = (np.repeat(begin + size + 2, size + 2) - np.arange(total)).astype(np.int32)
        segment = np.repeat(word_segment, size + 2)
        value = np.zeros(total, np.uint64)
        for length in range(1, min(rule.longest, total) + 1):
            reach = total - length + 1
            value = value[:reach] * np.uint64(0x100000001B3) + marked[length - 1 :] + np.uint64(1)
            if length >= rule.shortest:
                fits = left[:reach] >= length
                parts.append(((mixed(value[fits]) % np.uint64(rule.buckets)).astype(np.uint32), segment[:reach][fits]))
    return row_segment, parts


def segments_of(data: np.ndarray, offsets: np.ndarray, rule: Subwords):
    """N-gram numbers in order of segments, first n-gram of each segment, first segment of each row."""
    row_segment, parts = gram_parts(data, offsets, rule)
    if not parts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), row_segment
    grams = np.concatenate([grams for grams, _ in parts])
    owners = np.concatenate([owners for _, owners in parts])
    order = np.argsort(owners, kind="stable")
    first = np.searchsorted(owners[order], np.arange(row_segment[-1]))
    return grams[order], first, row_segment


def _segments_in_pieces(data: np.ndarray, offsets: np.ndarray, rule: Subwords):
    """As ``segments_of``, a few rows at a time, so that only the n-gram numbers add up in memory."""
    grams, first, per_row, begin, held = [], [], [np.zeros(1, np.int64)], 0, 0
    while begin < len(offsets) - 1:
        end = int(np.searchsorted(offsets, offsets[begin] + rule.chunk_bytes, "right")) - 1
        end = max(end, begin + 1)
        piece = data[offsets[begin] : offsets[end]]
        found, heads, row_segment = segments_of(piece, offsets[begin : end + 1] - offsets[begin], rule)
        grams.append(found)
        first.append(heads + held)
        per_row.append(np.diff(row_segment))
        held += len(found)
        begin = end
    if not grams:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(1, np.int64)
    return np.concatenate(grams), np.concatenate(first), np.cumsum(np.concatenate(per_row))


def _segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of runs; every run has an entry, since a marked word has at least three bytes."""
    return np.add.reduceat(values, first, axis=0) if len(first) else values[:0]


def _pooled(scores: np.ndarray, row_segment: np.ndarray) -> np.ndarray:
    """The largest segment score of each row; rows without segments get minus infinity."""
    out = np.full(len(row_segment) - 1, -np.inf)
    some = np.flatnonzero(np.diff(row_segment))
    if len(some):
        out[some] = np.maximum.reduceat(scores, row_segment[some])
    return out


def train(data: np.ndarray, offsets: np.ndarray, labels: np.ndarray, rule: Subwords) -> tuple[np.ndarray, float]:
    """Embeddings and softmax are fitted jointly; returned is each n-gram's margin and the bias.

    A document counts as its segments do: the gradient of a toxic document goes to its segments in
    proportion to their exponentiated margins, that of any other to its highest ones as well.
    """
    random = np.random.default_rng(rule.seed)
    grams, first, row_segment = _segments_in_pieces(data, offsets, rule)
    if not len(first):
        return np.zeros(rule.buckets, np.float32), -rule.start_margin
    sizes = np.diff(np.append(first, len(grams)))
    smoothed = sizes + rule.prior_grams  # so that a segment of one word is no rash judge
    embedding = random.uniform(-0.5, 0.5, (rule.buckets, rule.dimensions)).astype(np.float32) / rule.dimensions
    softmax = random.normal(0, 0.5, (rule.dimensions, 2)).astype(np.float32)
    bias = np.array([rule.start_margin, -rule.start_margin], np.float32) / 2  # so that little evidence is none
    seen_embedding = np.full(rule.buckets, 1e-4, np.float32)
    seen_softmax, seen_bias = np.full((rule.dimensions, 2), 1e-2, np.float32), np.full(2, 1e-2, np.float32)
    rows = np.flatnonzero(np.diff(row_segment))
    scale = np.float32(rule.segment_words)
    weights = np.where(labels > 0, 0.5 / max(labels[rows].mean(), 1e-9), 0.5 / max(1 - labels[rows].mean(), 1e-9))
    epochs = max(rule.epochs, -(-rule.least_steps * rule.batch_docs // max(1, len(rows))))
    for epoch in range(epochs):
        rate = rule.rate * (1 - 0.7 * epoch / epochs)
        random.shuffle(rows)
        for begin in range(0, len(rows), rule.batch_docs):
            batch = np.sort(rows[begin : begin + rule.batch_docs])
            segs = np.concatenate([np.arange(row_segment[r], row_segment[r + 1]) for r in batch])
            per_row = row_segment[batch + 1] - row_segment[batch]
            bounds = np.cumsum(per_row) - per_row
            per_seg = sizes[segs]
            heads = np.cumsum(per_seg) - per_seg
            at = np.repeat(first[segs] - heads, per_seg) + np.arange(per_seg.sum())
            own = grams[at]
            weight = scale / smoothed[segs][:, None]
            mean = _segment_sums(embedding[own], heads) * weight
            logits = mean @ softmax + bias
            margin = logits[:, 1] - logits[:, 0]
            top = np.maximum.reduceat(margin, bounds)
            raised = np.exp(margin - np.repeat(top, per_row))
            whole = np.add.reduceat(raised, bounds)
            share = raised / np.repeat(whole, per_row)
            pooled = np.add.reduceat(share * margin, bounds)
            chance = 1 / (1 + np.exp(-np.clip(pooled, -30, 30)))
            error = (chance - labels[batch]) * weights[batch] / len(batch)
            pull = (np.repeat(error, per_row) * share).astype(np.float32)
            flow = np.stack([-pull, pull], axis=1)
            grad_softmax = mean.T @ flow
            grad_bias = flow.sum(axis=0)
            grad_mean = (flow @ softmax.T) * weight
            touched, spot = np.unique(own, return_inverse=True)
            spread = np.repeat(grad_mean, per_seg, axis=0)
            grad = np.stack(
                [np.bincount(spot, spread[:, d], len(touched)) for d in range(rule.dimensions)], axis=1
            ).astype(np.float32)
            grad += rule.decay * embedding[touched]
            seen_embedding[touched] += (grad**2).mean(axis=1)
            embedding[touched] -= rate * grad / np.sqrt(seen_embedding[touched])[:, None]
            seen_softmax += grad_softmax**2
            softmax -= 0.1 * rate * grad_softmax / np.sqrt(seen_softmax)
            seen_bias += grad_bias**2
            bias -= 0.1 * rate * grad_bias / np.sqrt(seen_bias)
    margin = (embedding @ (softmax[:, 1] - softmax[:, 0]) * scale).astype(np.float32)
    return margin, float(bias[1] - bias[0])


def fitting(sizes: np.ndarray, labels: np.ndarray, most: int) -> np.ndarray:
    """Rows, in order, that fit in the bound: half of it for each label, then what is left for those skipped.

    Rows too long for what is left are skipped, not those behind them. The shortest row of a label of
    which none fits is taken all the same.
    """
    taken, used = np.zeros(len(sizes), bool), 0
    for label in (0, 1):
        own, held = np.flatnonzero(labels == label), 0
        for row in own.tolist():
            if held + sizes[row] <= most // 2:
                taken[row] = True
                held += int(sizes[row])
        if len(own) and not taken[own].any():
            shortest = own[np.argmin(sizes[own])]
            taken[shortest] = True
            held = int(sizes[shortest])
        used += held
    for row in np.flatnonzero(~taken).tolist():
        if used + sizes[row] <= most:
            taken[row] = True
            used += int(sizes[row])
    return np.flatnonzero(taken)


def _trainer(rule: Subwords):
    def fit(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        if not table.num_rows:
            return
        table = table.sort_by([("_order", "ascending")])
        sizes = pc.binary_length(table.column("_text")).to_numpy()
        table = table.take(fitting(sizes, table.column("_label").to_numpy(), rule.training_bytes))
        data, offsets = text_buffers(table.column("_text"))
        margin, bias = train(data, offsets, table.column("_label").to_numpy().astype(np.float64), rule)
        yield pa.RecordBatch.from_arrays(
            [pa.array([margin.tobytes()], pa.binary()), pa.array([bias], pa.float64())], names=["margin", "bias"]
        )

    return fit


def fitted(
    docs: DataFrame,
    labels: DataFrame,
    rule: Subwords = Subwords(),
    identifier: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    held_out=None,
) -> tuple[bytes, float]:
    """Fits the model on a bounded sample of labelled documents, in one task; returns its weights.

    The sample is ``documents_per_label`` documents of each label, drawn by a hash of the identifier,
    and of these those that fit in ``training_bytes`` of text, half of it for each label first. Rows for which ``held_out`` holds are left out.
    Null labels, identifiers and texts are no training rows. Without both labels nothing is toxic.
    """
    known = labels.select(F.col(identifier).alias("_id"), F.col(label).cast("int").alias("_label")).where(
        F.col("_label").isin(0, 1)
    )
    if held_out is not None:
        known = known.where(~held_out(F.col("_id")))
    order = F.xxhash64("_id", F.lit(rule.seed))
    chosen = [
        known.where(F.col("_label") == value).orderBy(order, "_id").limit(rule.documents_per_label)
        for value in (0, 1)
    ]
    sample = chosen[0].union(chosen[1])
    texts = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text")).where("_text is not null")
    rows = (
        texts.join(F.broadcast(sample), "_id")  # of a size that the parameter bounds
        .select("_text", "_label", order.alias("_order"))
        .repartition(1)
        .mapInArrow(_trainer(rule), "margin binary, bias double")
        .collect()
    )
    if not rows:
        return np.zeros(rule.buckets, np.float32).tobytes(), -10.0
    return bytes(rows[0]["margin"]), rows[0]["bias"]


def _scorer(docs: DataFrame, model: tuple[bytes, float], rule: Subwords, text: str, keep_text: bool):
    weights = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        margin, bias = np.frombuffer(weights.value[0], np.float32), weights.value[1]
        for chunk in chunks(batches, text, rule.chunk_bytes):
            data, offsets = text_buffers(chunk.column(text))
            row_segment, parts = gram_parts(data, offsets, rule)
            sums, sizes = np.zeros(row_segment[-1]), np.full(row_segment[-1], float(rule.prior_grams))
            for grams, owners in parts:
                sums += np.bincount(owners, margin[grams], len(sums))
                sizes += np.bincount(owners, minlength=len(sums))
            mean = sums / sizes
            pooled = _pooled(mean, row_segment)
            values = 1 / (1 + np.exp(-np.clip(np.where(np.isfinite(pooled), pooled, 0) + bias, -500, 500)))
            names = [name for name in chunk.schema.names if keep_text or name != text]
            yield pa.RecordBatch.from_arrays(
                [*[chunk.column(name) for name in names], pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                names=[*names, "_toxic_score", "_toxic"],
            )

    return score


def scored(
    docs: DataFrame, model: tuple[bytes, float], rule: Subwords = Subwords(), identifier: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: identifier, score, predicted. The whole text's highest segment decides.

    Null texts and texts without words have no segment and get the score of the bias alone. All rows
    are scored, whatever repeats in them, null identifiers too. An empty table gives an empty one.
    Other columns are ignored, whatever their names.
    """
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    id_type = base.schema["_id"].dataType.simpleString()
    score = _scorer(docs, model, rule, "_text", keep_text=False)
    return base.mapInArrow(score, f"_id {id_type}, _toxic_score double, _toxic int").select(
        F.col("_id").alias(identifier), F.col("_toxic_score").alias("score"), F.col("_toxic").alias("predicted")
    )


def accepted(
    docs: DataFrame, model: tuple[bytes, float], rule: Subwords = Subwords(), text: str = "text"
) -> DataFrame:
    """The rows of ``docs``, with all columns, that are not predicted to be toxic."""
    schema = T.StructType(list(docs.schema.fields)).add("_toxic_score", T.DoubleType()).add("_toxic", T.IntegerType())
    score = _scorer(docs, model, rule, text, keep_text=True)
    return docs.mapInArrow(score, schema).where("_toxic = 0").select(*docs.columns)
