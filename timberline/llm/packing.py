"""Packing token pieces into sequences with a grouping genetic algorithm on islands."""

from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.tables import settled
from timberline.llm.words import Words, chunks, lower_ascii, text_buffers, words_of

PIECES = "piece int, start bigint, length bigint, ids_crc32 bigint"
TOKEN_CHUNK_BYTES = 8_000_000
ENCODED_AT_ONCE = 8192
WORDS_IN_A_LINE = 512
KNOWN_WORDS = 2_000_000
STOPS = ".,"
SPECIAL = b"<|"


@dataclass(frozen=True)
class Evolution:
    """A block of pieces is solved on ``islands`` islands; elites migrate after each epoch but the last."""

    block_items: int = 2048
    islands: int = 2
    epochs: int = 2
    generations: int = 8
    population: int = 4
    seed: int = 17


def _public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _without_stops(words: Words) -> tuple[Words, np.ndarray]:
    """Words without one stop or comma after an ASCII letter, and the number of the sign cut off.

    The tokenizer parts letters from signs before it looks for tokens, so both are encoded alone.
    """
    if not len(words.start):
        return words, np.zeros(0, np.int64)
    last, before = words.data[words.end - 1], words.data[np.maximum(words.end - 2, 0)]
    letter = ((before | 32) >= 97) & ((before | 32) <= 122) & (words.end - words.start > 1)
    stop = np.zeros(len(words.start), np.int64)
    for number, sign in enumerate(STOPS, 1):
        stop[letter & (last == ord(sign))] = number
    return Words(words.data, words.start, words.end - (stop > 0), words.first), stop


def _only_letters(word: str) -> bool:
    """Whether a word is letters only, also as the tokenizer writes it before it looks for tokens."""
    return word.isalpha() and (word.isascii() or unicodedata.normalize("NFC", word).lower().isalpha())


class _Encoded:
    """The ids of the words a task has met, by hash; emptied when there are very many."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        # which tokens end a run of letters, by id; none if the vocabulary doesn't say
        self.last = np.zeros(tokenizer.get_vocab_size() + 1, bool)
        if suffix:
            self.last[[number for token, number in tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.clear()

    def clear(self) -> None:
        self.hashes, self.ids = np.zeros(0, np.uint64), np.zeros(0, "<u4")
        self.place, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def look_up(self, hashes: np.ndarray, spelled: Callable[[np.ndarray], list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Where in ``ids`` each word's ids begin, and how many they are; new words are encoded."""
        if len(self.hashes) > KNOWN_WORDS:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.ones(len(hashes), bool)
        inside = at < len(self.hashes)
        new[inside] = self.hashes[at[inside]] != hashes[inside]
        places, counts, parts, held = [], [], [self.ids], len(self.ids)
        missing = np.flatnonzero(new)
        for begin in range(0, len(missing), ENCODED_AT_ONCE):
            ids, place, count = self.encoded(spelled(missing[begin : begin + ENCODED_AT_ONCE]))
            places.append(place + held)
            counts.append(count)
            parts.append(ids)
            held += len(ids)
        place, count = (np.concatenate([np.zeros(0, np.int64), *some]) for some in (places, counts))
        self.ids = np.concatenate(parts)
        self.place = np.insert(self.place, at[missing], place)
        self.count = np.insert(self.count, at[missing], count)
        self.hashes = np.insert(self.hashes, at[missing], hashes[missing])
        at = np.searchsorted(self.hashes, hashes)
        return self.place[at], self.count[at]

    def encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of all words, and where each word's begin and how many they are.

        Words of letters are encoded many in a line, and parted behind the tokens that end a run of letters.
        """
        plain = [at for at, word in enumerate(words) if _only_letters(word)] if self.last.any() else []
        lines = [plain[x : x + WORDS_IN_A_LINE] for x in range(0, len(plain), WORDS_IN_A_LINE)]
        found = self.tokenizer.encode_batch_fast(
            [" ".join([words[at] for at in line]) for line in lines], add_special_tokens=False
        )
        place, count, parts, held = np.zeros(len(words), np.int64), np.full(len(words), -1), [], 0
        for line, one in zip(lines, found, strict=True):
            ids = np.array(one.ids, "<u4")
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(line) and ends[-1] == len(ids):  # else the tokenizer parts words otherwise
                starts = np.concatenate([[0], ends[:-1]])
                place[line], count[line] = starts + held, ends - starts
                parts.append(ids)
                held += len(ids)
        rest = np.flatnonzero(count < 0)
        lists = [
            one.ids
            for one in self.tokenizer.encode_batch_fast([words[at] for at in rest.tolist()], add_special_tokens=False)
        ]
        count[rest] = [len(ids) for ids in lists]
        place[rest] = np.cumsum(count[rest]) - count[rest] + held
        parts.append(np.array([x for ids in lists for x in ids], "<u4"))
        return np.concatenate(parts), place, count


def _piecer(vocabulary: str, limit: int, end_id: int, with_ids: bool):
    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(vocabulary if "/" in vocabulary else _public_vocabulary(vocabulary))
        encode = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        foldable = encode("A Bc") == encode("a bc")
        known = _Encoded(tokenizer)
        stop_ids = np.array([0, *[encode(sign)[0] for sign in STOPS]], "<u4")
        for chunk in chunks(batches, "_text", TOKEN_CHUNK_BYTES):
            data, offsets = text_buffers(chunk.column("_text"))
            if foldable and SPECIAL not in data.tobytes():
                data = lower_ascii(data)
            words = words_of(data, offsets)
            words, stop = _without_stops(words)
            hashes, sample, word = np.unique(words.hashes(), return_index=True, return_inverse=True)
            raw = data.tobytes()

            def spelled(some: np.ndarray) -> list[str]:
                bounds = zip(words.start[sample[some]].tolist(), words.end[sample[some]].tolist(), strict=True)
                return [raw[x:y].decode() for x, y in bounds]

            place, count = known.look_up(hashes, spelled)
            ids = known.ids
            stopped = stop > 0
            per_word = count[word] + stopped
            reached = np.concatenate([[0], np.cumsum(per_word)])
            first = reached[words.first]
            row, piece, start, length, crc, tokens = [], [], [], [], [], []
            for k in range(chunk.num_rows):
                x, y = words.first[k], words.first[k + 1]
                at = np.repeat(place[word[x:y]] - (reached[x:y] - first[k]), per_word[x:y])
                own = np.append(ids[np.minimum(at + np.arange(len(at)), len(ids) - 1)], np.uint32(end_id)).astype("<u4")
                some = np.flatnonzero(stopped[x:y])
                own[reached[x + 1 : y + 1][some] - 1 - first[k]] = stop_ids[stop[x:y][some]]
                for number, begin in enumerate(range(0, len(own), limit)):
                    cut = own[begin : begin + limit]
                    row.append(k)
                    piece.append(number)
                    start.append(begin)
                    length.append(len(cut))
                    crc.append(zlib.crc32(cut.tobytes()))
                    if with_ids:
                        tokens.append(cut.astype(np.int32))
            names = [name for name in chunk.schema.names if name != "_text"]
            columns = [chunk.column(name).take(pa.array(row, pa.int64())) for name in names]
            numbers = [pa.array(piece, pa.int32()), *[pa.array(x, pa.int64()) for x in (start, length, crc)]]
            more = [pa.array(tokens, pa.list_(pa.int32()))] if with_ids else []
            yield pa.RecordBatch.from_arrays(
                [*columns, *numbers, *more],
                names=[*names, *[part.split()[0] for part in PIECES.split(", ")], *["ids"] * with_ids],
            )

    return pieces


def token_pieces(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    limit: int = 2048,
    end_id: int = 0,
    identifier: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Per piece of a document's ids: identifier, piece, start, length, ids_crc32 and, if asked, ids.

    ``vocabulary`` is a path on the executors, or a name in the public vocabulary folder. The white
    space at which words are cut separates tokens in this vocabulary and is dropped by it, so each
    distinct word of a chunk is encoded once. Null text counts as empty: one piece with the end id.
    """
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = f"_id {base.schema['_id'].dataType.simpleString()}, {PIECES}" + ", ids array<int>" * with_ids
    return base.mapInArrow(_piecer(vocabulary, limit, end_id, with_ids), schema).withColumnRenamed(
        "_id", identifier
    )


class Island:
    """Solutions of one block. A solution is a list of bins, a bin a list of item numbers."""

    def __init__(self, lengths: np.ndarray, limit: int, seed: int):
        self.lengths = lengths.tolist()
        self.limit = limit
        self.random = np.random.default_rng(seed)
        self.fewest = -(-sum(self.lengths) // limit)

    def load(self, one: list[int]) -> int:
        return sum(map(self.lengths.__getitem__, one))

    def fitness(self, bins: list[list[int]]) -> tuple[int, float]:
        """Fewer bins first, then a more uneven filling, which leaves room where it is of use."""
        return -len(bins), sum((self.load(one) / self.limit) ** 2 for one in bins)

    def best_fit(self, items: Iterable[int], bins: list[list[int]]) -> list[list[int]]:
        """Puts each item where it leaves the least room, the longest item first."""
        room = sorted((self.limit - self.load(one), at) for at, one in enumerate(bins))
        for item in items:
            size = self.lengths[item]
            at = bisect.bisect_left(room, (size, -1))
            if at < len(room):
                left, number = room.pop(at)
                bins[number].append(item)
            else:
                left, number = self.limit, len(bins)
                bins.append([item])
            if left > size:
                bisect.insort(room, (left - size, number))
        return bins

    def by_length(self, items: Iterable[int]) -> list[int]:
        return sorted(items, key=lambda item: (-self.lengths[item], item))

    def start(self, count: int) -> list[list[list[int]]]:
        """Best fit by falling length, then by lengths disturbed a little."""
        everything = range(len(self.lengths))
        found = [self.best_fit(self.by_length(everything), [])]
        while len(found) < count:
            noise = self.random.normal(1, 0.05 * len(found), len(self.lengths))
            order = np.argsort(-np.array(self.lengths) * noise, kind="stable").tolist()
            found.append(self.best_fit(order, []))
        return found

    def cross(self, giver: list[list[int]], taker: list[list[int]]) -> list[list[int]]:
        """Injects whole well-filled bins of one parent; bins of the other that clash are dissolved."""
        loads = np.array([self.load(one) for one in giver])
        well = np.flatnonzero(loads >= np.quantile(loads, 0.25))
        chosen = well[self.random.random(len(well)) < 0.5]
        child = [list(giver[at]) for at in chosen]
        inside = {item for one in child for item in one}
        displaced = []
        for one in taker:
            if inside.isdisjoint(one):
                child.append(list(one))
            else:
                displaced += [item for item in one if item not in inside]
        return self.best_fit(self.by_length(displaced), child)

    def mutate(self, bins: list[list[int]]) -> list[list[int]]:
        """Dissolves the emptiest bin and a few others and best-fits what was in them."""
        count = max(1, len(bins) // 20)
        loads = np.array([self.load(one) for one in bins])
        gone = {int(loads.argmin()), *self.random.integers(0, len(bins), count).tolist()}
        kept = [list(one) for at, one in enumerate(bins) if at not in gone]
        return self.best_fit(self.by_length(item for at in gone for item in bins[at]), kept)

    def evolve(self, found: list[list[list[int]]], generations: int) -> list[list[int]]:
        population = sorted(found, key=self.fitness, reverse=True)
        for _ in range(generations):
            if len(population[0]) == self.fewest or len(population) < 2:
                break
            other = int(self.random.integers(1, len(population)))
            children = [
                self.cross(population[0], population[other]),
                self.mutate(self.cross(population[other], population[0])),
            ]
            population = sorted([*population, *children], key=self.fitness, reverse=True)[: len(found)]
        return population[0]


SOLVED = "block bigint, island int, bins int, filled double, _piece bigint, length bigint, bin int, place bigint"


def _solver(limit: int, plan: Evolution, epoch: int):
    def solve(items: pd.DataFrame) -> pd.DataFrame:
        """Evolves one island. In later epochs the rows hold the elites of several origins."""
        block, island = int(items["block"].iloc[0]), int(items["island"].iloc[0])
        pieces = items.drop_duplicates("_piece").sort_values("_piece")
        number = dict(zip(pieces["_piece"].tolist(), range(len(pieces)), strict=True))
        world = Island(pieces["length"].to_numpy(), limit, hash((plan.seed, block, island, epoch)) & 0x7FFFFFFF)
        found = []
        if epoch:
            for _, elite in items.sort_values(["origin", "_piece"]).groupby("origin"):
                bins: dict[int, list[int]] = {}
                for piece, at in zip(elite["_piece"].tolist(), elite["bin"].tolist(), strict=True):
                    bins.setdefault(at, []).append(number[piece])
                found.append(list(bins.values()))
        if len(found) < plan.population:
            found += world.start(plan.population - len(found) + 1)[1 if epoch else 0 :]
        best = world.evolve(found, plan.generations)
        count, filled = world.fitness(best)
        ids = pieces["_piece"].to_numpy()
        order = [item for one in best for item in one]
        sizes = np.array([len(one) for one in best])
        lengths = pieces["length"].to_numpy()[order]
        ends = np.cumsum(lengths)
        heads = np.repeat((ends - lengths)[np.cumsum(sizes) - sizes], sizes)
        return pd.DataFrame(
            {
                "block": block,
                "island": np.int32(island),
                "bins": np.int32(-count),
                "filled": filled,
                "_piece": ids[order],
                "length": lengths,
                "bin": np.repeat(np.arange(len(best), dtype=np.int32), sizes),
                "place": ends - lengths - heads,
            }
        )

    return solve


def packed_pieces(pieces: DataFrame, limit: int = 2048, plan: Evolution = Evolution()) -> DataFrame:
    """Adds sequence_id and offset to a table with a column ``length`` between 1 and ``limit``.

    Pieces of full length are sequences of their own. The others are dealt by a hash into blocks of
    about ``block_items``; every block evolves on several islands, each one task. Crossover injects
    whole well-filled sequences of one parent, dissolves clashing ones of the other and best-fits
    what was displaced. After an epoch each island gets its neighbour's elite, and at the end the best
    island's solution stands. A block ends early when it needs no more sequences than its tokens fill.
    """
    pieces = settled(pieces.withColumn("_piece", F.monotonically_increasing_id()), "pieces")
    open_pieces = pieces.where(F.col("length") < limit)
    blocks = max(1, -(-open_pieces.count() // plan.block_items))
    dealt = open_pieces.select(
        "_piece",
        "length",
        F.pmod(F.xxhash64("_piece"), F.lit(blocks)).alias("block"),
        F.explode(F.array(*[F.lit(k) for k in range(plan.islands)])).alias("island"),
    )
    for epoch in range(plan.epochs):
        solved = settled(dealt.groupBy("block", "island").applyInPandas(_solver(limit, plan, epoch), SOLVED), "islands")
        target = F.array_distinct(F.array("island", F.pmod(F.col("island") + 1, F.lit(plan.islands))))
        dealt = solved.select(
            "_piece", "length", "block", "bin", F.col("island").alias("origin"), F.explode(target).alias("island")
        )
    rank = F.struct("bins", (-F.col("filled")).alias("filled"), "island")
    best = solved.groupBy("block").agg(F.min(rank)["island"].alias("island"))
    placed = solved.join(best, ["block", "island"]).select(
        "_piece", ((F.col("block") * (1 << 22) + F.col("bin")) * 2).alias("sequence_id"), F.col("place").alias("offset")
    )
    whole = pieces.where(F.col("length") >= limit).select(
        "*", (F.col("_piece") * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return pieces.where(F.col("length") < limit).join(placed, "_piece").unionByName(whole).drop("_piece")


def packed_documents(
    docs: DataFrame,
    vocabulary: str = "word_bpe_49k.json",
    limit: int = 2048,
    end_id: int = 0,
    identifier: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
    plan: Evolution = Evolution(),
) -> DataFrame:
    """One row per piece: identifier, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and the end id; only documents longer than ``limit`` are cut, into pieces of
    ``limit`` ids, the last of which may be shorter. Null and empty texts are one piece with the end
    id. Repeated rows and identifiers are documents of their own, null identifiers are passed on. An
    empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    return packed_pieces(
        token_pieces(docs, vocabulary, limit, end_id, identifier, text, with_ids), limit, plan
    )
