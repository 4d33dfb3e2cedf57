"""Vectorised word splitting and hashing over Arrow string columns, for use inside tasks.

Texts are handled as UTF-8 bytes. Every separator is an ASCII byte, so a split at bytes is a
split at characters. A word's hash depends on its bytes alone, and an n-gram's on its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 18  # bytes hashed at a time
CHUNK = 1 << 18  # bytes of whole texts handled at a time

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_WORD_BASE = 0xC2B2AE3D27D4EB4F
_WORD_INVERSE = pow(_WORD_BASE, -1, 1 << 64)
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)

SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64 bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(int(_BASE), SEGMENT), powers(int(_INVERSE), SEGMENT)


def text_chunks(column: pa.Array, most: int = CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of rows in them) of runs of whole texts; null: empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        end = min(end, n)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the end): byte spans of the words of each row."""
    inside = np.empty(len(data) + 1, bool)
    np.logical_not(separators[data], out=inside[:-1])
    inside[-1] = False
    before = np.empty(len(data) + 1, bool)
    before[0] = False
    before[1:] = inside[:-1]
    cut = offsets[1:-1]
    before[cut] = False
    starts = np.flatnonzero(inside & ~before)
    # a word ends where the next place is a separator or starts another row
    after = inside.copy()
    after[cut] = False
    ends = np.flatnonzero(inside[:-1] & ~after[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end], a segment at a time; a word may be longer than a segment."""
    out = np.empty(len(starts), np.uint64)
    done = 0
    while done < len(starts):
        lo = int(starts[done])
        stop = max(done + 1, int(np.searchsorted(ends, lo + SEGMENT - 1, "right")))
        hi = int(ends[stop - 1])
        n = hi - lo
        up, down = (_UP, _DOWN) if n < SEGMENT else (powers(int(_BASE), n + 1), powers(int(_INVERSE), n + 1))
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTES[data[lo:hi]] * up[:n], out=sums[1:])
        s, e = starts[done:stop] - lo, ends[done:stop] - lo
        out[done:stop] = (sums[e] - sums[s]) * down[s]
        done = stop
    return mix(out)


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n words each, one for every place that n words follow (rows are not told apart)."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    out = hashes[: len(hashes) - n + 1] * np.uint64(pow(_WORD_BASE, 1, 1 << 64))
    for k in range(1, n):
        out = out + hashes[k : len(hashes) - n + 1 + k] * np.uint64(pow(_WORD_BASE, k + 1, 1 << 64))
    return mix(out)


def rolling_long(hashes: np.ndarray, n: int) -> np.ndarray:
    """As rolling, by prefix sums, for many words."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * powers(_WORD_BASE, len(hashes)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(_WORD_INVERSE, len(hashes) - n + 1))
