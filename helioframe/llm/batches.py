"""Arrow batches of texts as byte arrays: slicing by size, words, rolling word hashes.

Everything here works on whole texts. A slice holds complete rows; a row larger
than the slice size forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000

_U = np.uint64


def texts_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the n + 1 offsets between them; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = pa.array([""] * len(column), pa.large_string())
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    places = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose texts hold about ``size`` bytes at most."""
    for batch in batches:
        _, places = texts_of(batch.column(text))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(places, places[first] + size, "right")) - 1
            last = min(max(last, first + 1), batch.num_rows)
            yield batch.slice(first, last - first)
            first = last


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 flags, true for every byte that is in none of the ranges."""
    flags = np.ones(256, bool)
    for low, high in ranges:
        flags[low : high + 1] = False
    return flags


# Words are runs of bytes that are not white space: [^\x20\x09-\x0D]+
NOT_SPACE = byte_set((0x20, 0x20), (0x09, 0x0D))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> _U(33)
    x *= _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * _U(0xD1342543DE82EF95))


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, SLICE_BYTES + 1)
        _powers[:] = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _powers.append(np.multiply.accumulate(out))
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Sums from which ``span_hash`` gets the hash of any run of bytes."""
    up, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * up[: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs [start, end); equal bytes give equal hashes anywhere."""
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


class Words:
    """Words of all texts of a slice: ``doc``, ``start``, ``end`` (bytes), ``first`` (per text)."""

    def __init__(self, data: np.ndarray, places: np.ndarray, inside: np.ndarray = NOT_SPACE):
        self.data = LOWER[data]
        self.places = places
        word = inside[self.data]
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        before[places[:-1][places[:-1] < len(data)]] = False
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:]
        ends = places[1:] - 1
        after[ends[ends >= 0]] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, places)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(places) - 1), self.count)
        self._hashes: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            self._hashes = span_hash(prefix_hash(self.data), self.start, self.end)
        return self._hashes


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` consecutive words (across texts too; callers mask those)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = (out + hashes[i : i + n]) * _U(0xD6E8FEB86659FD93 + 2 * i)
        out ^= out >> _U(32)
    return mix(out)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
