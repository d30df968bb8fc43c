"""Byte-level helpers for Arrow batches: texts as one array of bytes, words, and their hashes.

All work on blocks of a bounded number of bytes; a text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_rng = np.random.default_rng(20240229)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(pattern_free: str) -> np.ndarray:
    """True for each byte value outside the given characters."""
    table = np.ones(256, bool)
    table[[ord(c) for c in pattern_free]] = False
    return table


#: ``[^\x20\x09-\x0D]`` and ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]``
NOT_SPACE = byte_class(" \t\n\x0b\x0c\r")
LOWER_ALNUM = byte_class("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))


def binary(column: pa.Array) -> pa.LargeBinaryArray:
    """Strings as bytes; null counts as empty."""
    return column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())


def offsets_of(column: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0) of runs of rows with at most ``most`` bytes."""
    column = binary(column)
    if not len(column):
        return
    offsets = offsets_of(column)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def _grown(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums modulo 2**64, from which ``span_hash`` names any stretch."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * _grown(len(data))[0], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the bytes from start to end; equal stretches get equal ones."""
    inverse = _grown(len(prefix))[1]
    name = (prefix[end] - prefix[start]) * inverse[start]
    return mixed(name + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes in ``table``, and where each text's words begin.

    The last array has one entry more than there are texts; no word spans two texts.
    """
    inside = table[data]
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[offsets < n]
    before[edges] = False
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def shingle_hash(names: np.ndarray, length: int) -> np.ndarray:
    """Names of all runs of ``length`` consecutive word names (texts' borders are not looked at)."""
    n = max(0, len(names) - length + 1)
    out = np.zeros(n, np.uint64)
    for j in range(length):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + names[j : j + n]
    return mixed(out)
