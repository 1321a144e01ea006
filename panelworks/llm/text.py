"""Whole texts as numpy arrays: slices of Arrow columns, words, and hashes of words and shingles."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)


def give_back() -> None:
    """Return what earlier tasks of this worker have freed to the system.

    Workers live through all stages of a job, and the allocators keep freed arrays for the next ones. What one
    stage held would be counted on top of what the next one needs.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def byte_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) for runs of rows of at most ``limit`` bytes.

    A null is an empty text. The bytes are those of the column, without a copy.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) else "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None and held.size else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _table(ranges: list[tuple[int, int]], inside: bool) -> np.ndarray:
    table = np.full(256, not inside)
    for a, b in ranges:
        table[a : b + 1] = inside
    return table


#: Bytes of words: everything but white space; digits, lower-case letters and all non-ASCII.
NOT_SPACE = _table([(0x20, 0x20), (0x09, 0x0D)], False)
ALNUM = _table([(0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF)], True)
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and for each text the range of its words."""
    inside = table[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~(inside[1:] & ~begins[1:])
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(starts, offsets)


@lru_cache(maxsize=1)
def _symbols() -> np.ndarray:
    return np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 ... base ** (count - 1) modulo 2 ** 64."""
    held = _powers.get(base)
    if held is None or len(held) < count:
        held = np.full(max(count, SLICE_BYTES + 1), base, np.uint64)
        held[0] = 1
        _powers[base] = held = np.cumprod(held, dtype=np.uint64)
    return held[:count]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a permutation of them)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``values`` (uint64), by prefix sums."""
    total = np.empty(len(values) + 1, np.uint64)
    total[0] = 0
    np.cumsum(values * powers(BASE, len(values)), out=total[1:])
    own = (total[ends] - total[starts]) * powers(INVERSE, len(values) + 1)[starts]
    return mixed(own + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(_symbols()[data], starts, ends)


#: Two primes and bases drawn for them.
FIELDS = ((2147483647, 1103515245), (2147483629, 1664525123))


@lru_cache(maxsize=4)
def _field_powers(prime: int, base: int, size: int) -> np.ndarray:
    """base ** 0 ... base ** (size - 1) modulo ``prime``, by doubling."""
    held = np.ones(1, np.uint64)
    while len(held) < size:
        held = np.concatenate([held, held * U64(pow(base, len(held), prime)) % U64(prime)])
    return held[:size]


def sure_word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """62-bit hash of each word by two polynomials modulo primes; unlike those modulo 2 ** 64 they have no words
    that collide for every base."""
    size = 1 << max(SLICE_BYTES, len(data)).bit_length()
    total = np.zeros(len(data) + 1, np.uint64)
    both = (ends - starts).astype(np.uint64)
    for prime, base in FIELDS:
        symbols = _symbols() % U64(prime)
        np.cumsum(symbols[data] * _field_powers(prime, base, size)[: len(data)] % U64(prime), out=total[1:])
        own = (total[ends] - total[starts]) % U64(prime) * _field_powers(prime, pow(base, -1, prime), size)[starts] % U64(prime)
        both = (both << U64(32)) ^ own
    return mixed(both ^ mixed((ends - starts).astype(np.uint64)))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive word hashes (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    factors = powers(BASE, n + 1)
    out = np.full(len(h) - n + 1, n, np.uint64)
    for j in range(n):
        out += h[j : len(h) - n + 1 + j] * factors[j + 1]
    return mixed(out)


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted values without repeats; a plain sort is faster here than ``np.unique``."""
    if not len(values):
        return values
    values = np.sort(values)
    keep = np.empty(len(values), bool)
    keep[0] = True
    np.not_equal(values[1:], values[:-1], out=keep[1:])
    return values[keep]


def output(schema: dict[str, pa.DataType], columns: dict[str, object]) -> pa.RecordBatch:
    fields = pa.schema(list(schema.items()))
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in fields], schema=fields)
