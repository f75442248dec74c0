"""Array kernels over a batch of texts, used inside tasks.

A batch is what Arrow hands over: one byte buffer and the offsets of its rows. Words are
maximal runs of bytes outside ``[\\x20\\x09-\\x0D]``; these bytes never occur inside a
multi-byte character, so words can be cut and hashed without decoding. Batches are cut
into slices of about a quarter of a megabyte (never inside a text), which bounds the scratch arrays by
the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICEBYTES = 250_000

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
        return x ^ (x >> U64(31))


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _STEP)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (kept by the worker, grown by doubling)."""
    table = _powers.get(base)
    if table is None or len(table) < n:
        size = 1 << max(n - 1, 1).bit_length()
        table = np.ones(1, dtype=np.uint64)
        while len(table) < size:
            with np.errstate(over="ignore"):
                table = np.concatenate([table, table * U64(pow(base, len(table), 1 << 64))])
        _powers[base] = table
    return table[:n]


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of ``symbols`` (an array of scrambled 64-bit symbols)."""
    n = len(symbols)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    with np.errstate(over="ignore"):
        np.cumsum(symbols * _power_table(_BASE, n), out=sums[1:])
        h = (sums[ends] - sums[starts]) * _power_table(_INVERSE, n + 1)[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _STEP)


@dataclass
class Texts:
    """Part of a batch: ``data`` (bytes as uint8) with rows at ``offsets[i]:offsets[i+1]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def raw(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()


def column_texts(column: pa.Array | pa.ChunkedArray, slice_bytes: int = SLICEBYTES) -> Iterator[Texts]:
    """Slices of a string column without copying it; null counts as empty."""
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    first = 0
    for chunk in chunks:
        chunk = chunk.fill_null("") if chunk.null_count else chunk
        kind = np.int64 if pa.types.is_large_string(chunk.type) else np.int32
        _, where, values = chunk.buffers()
        n = len(chunk)
        if n == 0:
            continue
        offsets = np.frombuffer(where, dtype=kind)[chunk.offset : chunk.offset + n + 1].astype(np.int64)
        data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.empty(0, np.uint8)
        i = 0
        while i < n:
            j = int(np.searchsorted(offsets, offsets[i] + slice_bytes, side="right")) - 1
            j = min(max(j, i + 1), n)
            yield Texts(first + i, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
            i = j
        first += n


@dataclass
class Words:
    """Words of a slice: byte spans, the row of each, and the first word of each row."""

    starts: np.ndarray
    ends: np.ndarray
    row: np.ndarray
    bounds: np.ndarray


def words(texts: Texts) -> Words:
    data, offsets = texts.data, texts.offsets
    n = len(data)
    inside = ~SPACE[data]
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], after[-1] = False, False
        before[1:], after[:-1] = inside[:-1], inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < n)]
        before[cuts] = False
        after[cuts - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    bounds = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(starts, ends, row, bounds)


def word_hashes(texts: Texts, found: Words, lower: bool = False) -> np.ndarray:
    data = LOWER[texts.data] if lower else texts.data
    return span_hashes(BYTE[data], found.starts, found.ends)


def windows(hashes: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word windows inside a row, and the position of each one's first word."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        total = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            total = mix(total + hashes[j : j + n] + U64(j + 1) * _STEP)
    at = np.flatnonzero(row[:n] == row[k - 1 :])
    return total[at], at


def code_points(data: np.ndarray) -> np.ndarray:
    """1 for each byte that begins a character of a UTF-8 buffer, else 0."""
    return (data & 0xC0) != 0x80
