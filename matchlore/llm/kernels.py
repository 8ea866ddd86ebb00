"""Array kernels over whole batches of texts: words, hashes of word and byte runs.

All of them work on UTF-8 bytes. A batch is cut between texts into pieces of
about ``PIECE`` bytes, so memory does not grow with the batch; a single longer
text is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 18
#: The ASCII white space that separates words: x20 and x09 to x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_powers = {True: np.ones(1, np.uint64), False: np.ones(1, np.uint64)}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``n + 1`` offsets between them; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64)[column.offset : column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets


def pieces(column: pa.Array, size: int = PIECE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``size`` bytes: first row, row after the last, bytes, offsets from 0."""
    data, offsets = utf8(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the hash base, or of its inverse, modulo 2**64."""
    have = _powers[inverse]
    if len(have) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        have = np.full(max(n, 2 * len(have)), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= 1 << 23:
            _powers[inverse] = have
    return have[:n]


class RunHashes:
    """Hashes of any runs of a sequence of integers, by differences of one prefix sum."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(n), out=self.sums[1:])
        self.inverse = powers(n + 1, True)

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Equal runs get equal hashes; runs of different length differ in what they sum."""
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64))


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``; no word crosses texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = ~SPACE[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of ``flags`` are set in each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[offsets])
