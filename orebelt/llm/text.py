"""Words, shingles and rolling hashes of many texts at once, as numpy arrays over UTF-8 bytes.

All hashes are 64 bits wide and depend on the bytes alone, so every task on every machine gets the
same values. Texts are worked on in chunks of a bounded size; a longer text is a chunk of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps
from inspect import signature
from typing import NamedTuple

import numpy as np
import pyarrow as pa

U = np.uint64
CHUNK_BYTES = 1 << 18


def give_back() -> None:
    """Return freed memory to the system: a worker lives on, and other stages need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function of a group, or a generator over batches, that gives back its memory in the end."""

    @wraps(run)
    def wrapped(*args):
        try:
            found = run(*args)
            if isinstance(found, Iterator):
                return _until_done(found)
            return found
        finally:
            give_back()

    wrapped.__signature__ = signature(run)  # Spark tells by it whether a group's key is wanted
    return wrapped


def _until_done(found: Iterator) -> Iterator:
    try:
        yield from found
    finally:
        give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: every input bit moves every output bit."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd numbers."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)
        return mix(steps) | U(1)


def expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All the numbers ``first[i]``, ``first[i] + 1``, ... of ``size[i]``, one list after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


class Rolling:
    """Hashes of any byte range from one running sum: ``(P[end] - P[start]) * base ** -start``."""

    def __init__(self, seed: int, *, fold_case: bool = False):
        values = constants(256, seed)
        self.values = values[LOWER] if fold_case else values
        self.base = int(constants(1, seed + 1)[0])
        self.power, self.inverse = self._run(self.base, 1), self._run(self.base, 1)

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        run = np.full(n, base, U)
        run[0] = 1
        return np.multiply.accumulate(run)

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(data) >= len(self.power):
            n = max(len(data) + 1, CHUNK_BYTES)
            self.power = self._run(self.base, n)
            self.inverse = self._run(pow(self.base, -1, 1 << 64), n)
        out = np.zeros(len(data) + 1, U)
        np.cumsum(self.values[data] * self.power[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverse[start]


_folded = Rolling(11, fold_case=True)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each text begins; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    starts = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8), starts.astype(np.int64)


class Chunk(NamedTuple):
    first: int  # index of the first text
    data: np.ndarray
    starts: np.ndarray  # one more than there are texts

    @property
    def count(self) -> int:
        return len(self.starts) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The texts in order, as many at a time as fit into ``limit`` bytes, but one at least."""
    data, starts = text_bytes(column)
    first = 0
    while first < len(starts) - 1:
        last = int(np.searchsorted(starts, starts[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(starts) - 1)
        own = starts[first : last + 1]
        yield Chunk(first, data[own[0] : own[-1]], own - own[0])
        first = last


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray  # index of the text within the chunk
    hash: np.ndarray  # of the word with A-Z in lower case
    bounds: np.ndarray  # the words of text i are bounds[i]:bounds[i + 1]


def runs(chunk: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the longest runs of ``inside`` bytes begin and end; none spans two texts."""
    mark = np.zeros(len(chunk.data) + 2, np.int8)
    mark[1:-1] = inside
    step = np.diff(mark)
    start, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    cuts = np.unique(chunk.starts[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < len(chunk.data))]
    cuts = cuts[(mark[cuts] == 1) & (mark[cuts + 1] == 1)]
    return np.sort(np.r_[start, cuts]), np.sort(np.r_[end, cuts])


def lower(data: np.ndarray) -> np.ndarray:
    """A-Z and the Latin-1 capitals in lower case."""
    out = LOWER[data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    out[capital] += 32
    return out


def words(chunk: Chunk) -> Words:
    """Runs of bytes other than space and tab to carriage return."""
    start, end = runs(chunk, ~SPACE[chunk.data])
    text = np.searchsorted(chunk.starts, start, side="right") - 1
    hashed = mix(_folded.ranges(_folded.sums(chunk.data), start, end))
    return Words(start, end, text, hashed, np.searchsorted(start, chunk.starts))


def shingles(found: Words, size: int, factors: np.ndarray) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its ``size``-word shingles.

    A text with fewer words has its whole sequence as one shingle, a text without words none.
    """
    h, n = found.hash, len(found.hash)
    places = max(0, n - size + 1)
    full = np.zeros(places, U)
    for j in range(size):
        full += h[j : places + j][:places] * factors[j]
    full = mix(full)
    for a, b in zip(found.bounds, found.bounds[1:]):
        if b - a >= size:
            yield np.unique(full[a : b - size + 1])
        elif b > a:
            short = (h[a:b] * factors[: b - a]).sum(dtype=U) + U(int(b - a))
            yield mix(np.array([short], U))
        else:
            yield np.zeros(0, U)
