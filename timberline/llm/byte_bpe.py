"""Byte-level BPE: exact merges by backtracking over longest matches, and back to bytes."""

from __future__ import annotations

from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timberline.llm.words import chunks

CHUNK_BYTES = 4_000_000
LONG_TEXT = 1_000_000
MATCHES_AT_ONCE = 50_000
KNOWN_MATCHES = 600_000
KNOWN_LENGTH = 64
KNOWN_PAIRS = 500_000


def _ranks(vocabulary: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a path on the executor, or a name in the public folder."""
    import base64

    if "/" not in vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    with open(vocabulary, "rb") as lines:
        return {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}


class Merges:
    """The merges of one vocabulary. Bytes are written as the Latin-1 characters of the same numbers.

    A sequence of tokens is what the merges give exactly if each two neighbours are what the merges
    give for their joined bytes. So tokens are laid from left to right, the longest that begins here
    first; one that does not go with its left neighbour gives way to the next shorter, and a place at
    which none goes is never tried again. That takes time in proportion to the length.
    """

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        if any(bytes([value]) not in ranks for value in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.ranks = {piece.decode("latin-1"): rank for piece, rank in ranks.items()}
        self.shorter: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in self.ranks:
            if len(piece) > 1:
                self.automaton.add_word(piece, (len(piece) - 1, piece))
        self.automaton.make_automaton()

    def compatible(self, left: str, right: str) -> bool:
        """Whether the merges by their definition, the lowest rank first, keep two tokens apart."""
        rank, none = self.ranks.get, float("inf")
        parts = [*left, *right]
        joins = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        border, size = len(left) - 1, len(joins)  # the join of the last part of left and the first of right
        while size and (least := min(joins)) < none:
            at = joins.index(least)
            if at == border:
                return False
            border -= at < border
            del joins[at]
            size -= 1
            joined = parts[at] = parts[at] + parts.pop(at + 1)
            if at:
                joins[at - 1] = rank(parts[at - 1] + joined, none)
            if at < size:
                joins[at] = rank(joined + parts[at + 1], none)
        return size == 1

    def next_shorter(self, token: str) -> str | None:
        """The longest token that is a proper beginning of this one."""
        begins = (token[:size] for size in range(len(token) - 1, 0, -1))
        return next((begin for begin in begins if begin in self.ranks), None)

    def encode(self, text: str) -> list[int]:
        if (whole := self.ranks.get(text)) is not None:
            return [whole]
        size, pairs, shorter = len(text), self.pairs, self.shorter
        if len(pairs) >= KNOWN_PAIRS:
            pairs.clear()
        longest = list(text)  # the longest token that begins at each place
        for end, (length, token) in self.automaton.iter(text):
            longest[end - length] = token
        dead = set()
        laid: list[str] = []
        place, token, left = 0, longest[0], None
        while place < size:
            while token is not None:
                end = place + len(token)
                if end not in dead:
                    if left is None:
                        break
                    pair = (left, token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.compatible(left, token)
                    if fits:
                        break
                if token not in shorter:
                    shorter[token] = self.next_shorter(token)
                token = shorter[token]
            if token is not None:
                laid.append(token)
                left, place = token, end
                token = longest[place] if place < size else None
            elif laid:
                dead.add(place)
                token = laid.pop()
                left = laid[-1] if laid else None
                place -= len(token)
            else:
                raise ValueError("nothing in the vocabulary fits")
        return [self.ranks[token] for token in laid]


class Known(dict):
    """The ids of short matches a task has met; emptied when there are very many."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, match: str) -> tuple[int, ...]:
        ids = tuple(self.merges.encode(match.encode().decode("latin-1")))
        if len(match) <= KNOWN_LENGTH:
            if len(self) >= KNOWN_MATCHES:
                self.clear()
            self[match] = ids
        return ids


@lru_cache(maxsize=4)
def splitting(pattern: str) -> tuple[str, str, frozenset[str]]:
    """The pattern, the same for characters of a later Unicode version, and those characters.

    The pattern library may know a later Unicode version than the tokenizer library does, in which more
    characters are letters or numbers. They are found once, on the driver; only texts that hold one
    are split by the second pattern, whose classes leave them out.
    """
    import regex
    import tiktoken

    bytes_only = {bytes([value]): value for value in range(256)}
    everything = "".join(map(chr, chain(range(0xD800), range(0xE000, 0x110000))))
    careful, later = pattern, []
    for name in (r"\p{L}", r"\p{N}"):
        ours = regex.findall(name, everything)
        library = tiktoken.Encoding(name, pat_str=name, mergeable_ranks=bytes_only, special_tokens={})
        theirs = set(bytes(library.encode_ordinary("".join(ours))).decode())
        extra = [char for char in ours if char not in theirs]
        if extra:
            careful = careful.replace(name, f"[{name}--[{_ranges(extra)}]]")
            later += extra
    return pattern, careful, frozenset(later)


def _ranges(characters: list[str]) -> str:
    """Characters in rising order as the inside of a class."""
    numbers = np.array([ord(char) for char in characters])
    breaks = np.flatnonzero(np.diff(numbers) > 1)
    firsts = numbers[np.concatenate([[0], breaks + 1])].tolist()
    lasts = numbers[np.concatenate([breaks, [len(numbers) - 1]])].tolist()
    return "".join(f"\\U{first:08x}-\\U{last:08x}" for first, last in zip(firsts, lasts))


class Splitter:
    """Matches of a pattern as the tokenizer library finds them."""

    def __init__(self, plain: str, careful: str, later: frozenset[str]):
        import regex

        self.plain = regex.compile(plain)
        self.careful = regex.compile(careful, regex.VERSION1)
        self.later = later

    def matches(self, text: str) -> Iterator[list[str]]:
        """The matches in order, in lists of bounded size."""
        pattern = self.plain if text.isascii() or self.later.isdisjoint(text) else self.careful
        if len(text) <= LONG_TEXT:
            yield pattern.findall(text)
            return
        found = pattern.finditer(text)
        while block := [match.group() for match in islice(found, MATCHES_AT_ONCE)]:
            yield block


def _encoder(vocabulary: str, patterns: tuple[str, str, frozenset[str]]):
    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = splitter = None
        for chunk in chunks(batches, "_text", CHUNK_BYTES):
            if known is None:
                known = Known(Merges(_ranks(vocabulary)))
                splitter = Splitter(*patterns)
            ids, ends = array("i"), [0]
            for text in chunk.column("_text"):
                for block in splitter.matches(text.as_py() or ""):
                    ids.extend(chain.from_iterable(map(known.__getitem__, block)))
                ends.append(len(ids))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(ids, np.int32)))
            yield pa.RecordBatch.from_arrays([chunk.column("_id"), lists], names=["_id", "ids"])

    return encode


def _decoder(vocabulary: str):
    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelled = None
        for batch in batches:
            if spelled is None:
                ranks = _ranks(vocabulary)
                spelled = {rank: piece for piece, rank in ranks.items()}
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().tolist()
            ids = lists.values.to_numpy(zero_copy_only=False)
            present = lists.is_valid().to_pylist()
            decoded = [
                b"".join(map(spelled.__getitem__, ids[x:y].tolist())) if there else None
                for x, y, there in zip(ends, ends[1:], present)
            ]
            yield batch.append_column("decoded", pa.array(decoded, pa.binary()))

    return decode


def byte_pair_ids(
    docs: DataFrame,
    vocabulary: str = "byte_bpe_multi_50k.tiktoken",
    pattern: str | None = None,
    identifier: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Per row: identifier and ``ids``, the byte-level BPE ids of its whole text, without special tokens.

    ``vocabulary`` is a rank file: a path on the executors, or a name in the public vocabulary folder.
    Each match of ``pattern`` (by default the public one) is encoded by itself: by the token it is, else
    by the merges. A task holds one chunk of texts, or one text, and its ids; it remembers the ids of
    up to 600 000 short matches and whether up to 500 000 pairs of tokens go together.

    Null and empty texts give an empty list. Null and repeated identifiers and repeated rows stay as
    they are. An empty table gives an empty one. Other columns are ignored, whatever their names.
    """
    base = docs.select(F.col(identifier).alias("_id"), F.col(text).alias("_text"))
    schema = f"_id {base.schema['_id'].dataType.simpleString()}, ids array<int>"
    if pattern is None:
        import public_tokenizers

        pattern = public_tokenizers.PATTERN
    return base.mapInArrow(_encoder(vocabulary, splitting(pattern)), schema).withColumnRenamed("_id", identifier)


def byte_pair_bytes(table: DataFrame, vocabulary: str = "byte_bpe_multi_50k.tiktoken") -> DataFrame:
    """Adds ``decoded``, the bytes of a column ``ids``, to a table without a column of that name.

    An empty list gives no bytes, null gives null, an id that the vocabulary lacks is an error. Cast
    ``decoded`` to a string for the text; lists that end within a character are not whole UTF-8.
    """
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in table.schema.fields)
    return table.mapInArrow(_decoder(vocabulary), f"{fields}, decoded binary")
