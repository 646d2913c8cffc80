"""Words of many texts at once: NumPy over the bytes of an Arrow text column.

A word is a run of bytes other than space and the controls 0x09 to 0x0D; both are single bytes in
UTF-8, so no text is decoded to find its words. Words are known by 64 bits made of two polynomials
modulo different primes; modulo a power of two, some long words would meet for every base.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 8_000_000
CHUNK_ROWS = 100_000
_BLOCK = 1 << 15
_BASE = 0x9E3779B97F4A7C15 | 1
# Primes below 2 ** 31 and a base for each.
_FIELDS = ((2_147_483_647, 1_610_612_741), (2_147_483_629, 805_306_457))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if wide else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * kind().itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(
    batches: Iterable[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES, most_rows: int = CHUNK_ROWS
) -> Iterator[pa.RecordBatch]:
    """The rows again, cut so that a piece holds about ``limit`` bytes of text, or one row.

    Very short texts fill a piece by their number, ``most_rows``.
    """
    held: list[pa.RecordBatch] = []
    size = rows = 0
    for batch in batches:
        _, offsets = text_buffers(batch.column(text))
        begin = 0
        while begin < batch.num_rows:
            room = offsets[begin] + max(0, limit - size)
            end = min(int(np.searchsorted(offsets, room, "right")) - 1, begin + most_rows - rows)
            if end <= begin and held:
                yield _joined(held)
                held, size, rows = [], 0, 0
                continue
            end = max(end, begin + 1)
            held.append(batch.slice(begin, end - begin))
            size += int(offsets[end] - offsets[begin])
            rows += end - begin
            begin = end
            if size >= limit:
                yield _joined(held)
                held, size, rows = [], 0, 0
    if held:
        yield _joined(held)


def _joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(held) == 1:
        return held[0]
    return pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; all other bytes as they are."""
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


@dataclass
class Words:
    """All words of a chunk in order. ``first[d]`` to ``first[d + 1]`` are those of row d."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """A hash of each word's bytes: prefix sums of polynomials, in blocks of words.

        A polynomial is the sum of (byte + 1) * base ** place, modulo a prime.
        """
        out = np.empty(len(self.start), np.uint64)
        fields = [(np.uint64(p), _powers(base, p), _powers(pow(base, -1, p), p)) for p, base in _FIELDS]
        sums = np.zeros(_BLOCK + 1, np.uint64)  # below 2 ** 58
        begin = 0
        while begin < len(self.start):
            origin = int(self.start[begin])
            end = int(np.searchsorted(self.end, origin + _BLOCK, "right"))
            if end <= begin:  # one word longer than a block
                end = begin + 1
                length = self.end[begin:end] - self.start[begin:end]
                halves = [np.array([self._long_word(begin, _powers(base, p), p, base)], np.uint64) for p, base in _FIELDS]
            else:
                piece = self.data[origin : int(self.end[end - 1])].astype(np.uint64)
                piece += np.uint64(1)
                left, right = self.start[begin:end] - origin, self.end[begin:end] - origin
                length, halves = right - left, []
                for modulus, up, down in fields:
                    np.cumsum(piece * up[: len(piece)], out=sums[1 : len(piece) + 1])
                    half = sums[right]
                    half -= sums[left]
                    half %= modulus
                    half *= down[left]
                    half %= modulus
                    halves.append(half)
            both = halves[0] | halves[1] << np.uint64(32)
            out[begin:end] = mixed(both ^ length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
            begin = end
        return out

    def _long_word(self, at: int, up: np.ndarray, prime: int, base: int) -> int:
        total, shift = 0, 1
        for begin in range(int(self.start[at]), int(self.end[at]), _BLOCK):
            piece = self.data[begin : min(begin + _BLOCK, int(self.end[at]))].astype(np.uint64)
            part = int(((piece + np.uint64(1)) * up[: len(piece)]).sum(dtype=np.uint64))
            total = (total + part * shift) % prime
            shift = shift * pow(base, _BLOCK, prime) % prime
        return total


@cache
def _powers(base: int, prime: int) -> np.ndarray:
    """The powers of a base modulo a prime, from 0 to a block's length."""
    steps = np.ones(1, np.uint64)
    while len(steps) <= _BLOCK:
        steps = np.concatenate([steps, steps * np.uint64(pow(base, len(steps), prime)) % np.uint64(prime)])
    return steps[: _BLOCK + 1]


def words_of(data: np.ndarray, offsets: np.ndarray) -> Words:
    size = len(data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    start = inside.copy()
    end = inside.copy()
    if size:
        start[1:] &= ~inside[:-1]
        end[:-1] &= ~inside[1:]
        bounds = offsets[1:-1]
        here = bounds[bounds < size]
        start[here] = inside[here]
        before = bounds[bounds > 0] - 1
        end[before] = inside[before]
    starts = np.flatnonzero(start)
    return Words(data, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets))


def rolled(hashes: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """A hash of each ``width`` consecutive word hashes; fewer words than that give nothing."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    step = np.uint64(_BASE ^ (salt << 1))
    out = np.full(count, width, np.uint64)
    for shift in range(width):
        out = out * step + hashes[shift : shift + count]
    return mixed(out)
