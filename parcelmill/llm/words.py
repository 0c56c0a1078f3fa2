"""Words, word hashes and word windows of whole Arrow batches, as numpy arrays.

A batch's texts are one run of UTF-8 bytes, so that words are found and hashed for all of its documents
at once. Every function takes and returns plain arrays; Spark hands the batches out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Bytes of text that are looked at together; bounds the memory of a task. A longer document stands alone.
PIECE_BYTES = 2 << 20

_SEED = np.random.Generator(np.random.PCG64(20240601))
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2**64)

SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
# letters, digits and everything beyond ASCII
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[0x30:0x3A] = ALPHANUMERIC[0x41:0x5B] = ALPHANUMERIC[0x61:0x7B] = ALPHANUMERIC[0x80:] = True
NOT_SPACE = ~SPACES

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads each bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
        np.cumprod(out, out=out)
    return out


class _Powers:
    """Powers of a number and of its inverse modulo 2^64, kept for the longest run asked for so far."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = _powers(_BASE, n), _powers(_INVERSE, n)
        return (self.up[:n], self.down[:n]) if n <= 8 * PIECE_BYTES else (_powers(_BASE, n), _powers(_INVERSE, n))


_kept = _Powers()


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the offset of each; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def as_texts(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """The texts of bytes and offsets as an array that starts at its buffers' start, as some kernels need it."""
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(np.ascontiguousarray(at, np.int64)), pa.py_buffer(np.ascontiguousarray(data)))


def pieces(data: np.ndarray, at: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole documents of at most ``most`` bytes: first, end, their bytes and offsets."""
    i, n = 0, len(at) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(at, at[i] + most, "right")) - 1)
        yield i, j, data[at[i] : at[j]], at[i : j + 1] - at[i]
        i = j


class Words:
    """Words of some documents: byte spans, 64-bit hashes, and the first word of each document."""

    def __init__(self, data: np.ndarray, at: np.ndarray, members: np.ndarray = NOT_SPACE, lower: bool = False):
        if lower:
            data = LOWER[data]
        self.data, self.at, n = data, at, len(data)
        inside = members[data]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        edges = at[(at > 0) & (at < n)]  # a text ends where the next one starts
        begins[edges] = inside[edges]
        ends[edges - 1] = inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, at)
        self._hashes = None

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            n = len(self.data)
            up, down = _kept.get(n)
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(_BYTE[self.data] * up, out=sums[1:])
            self._hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts]) if n else np.zeros(0, np.uint64)
        return self._hashes

    @property
    def document(self) -> np.ndarray:
        """Of each word, the number of its document."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """Of each word, how many words its document has from there on."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self))


def window_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive hashes; runs over the edge of a document are left to the caller."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, np.uint64)
    up, down = _kept.get(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[k:] - sums[:-k]) * down[: n - k + 1] + np.uint64(k))


def span_hashes(hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of the run of hashes from each start to before each end; of equal length as ``window_hashes``."""
    up, down = _kept.get(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Least of each ``w`` consecutive values, by doubling."""
    if len(values) < w:
        return values[:0]
    out, span = values, 1
    while span < w:
        step = min(span, w - span)
        out = np.minimum(out[: len(out) - step], out[step:])
        span += step
    return out


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    edge = np.diff(np.concatenate(([0], mask.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def covered(n: int, starts: np.ndarray, length: int | np.ndarray) -> np.ndarray:
    """Mask over ``n`` places of those in any span ``[start, start + length)``."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + length, -1)
    return np.cumsum(marks[:-1]) > 0


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of each span, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    out = np.ones(total, np.int64)
    keep = counts > 0
    starts, counts = starts[keep].astype(np.int64), counts[keep].astype(np.int64)
    at = np.cumsum(counts)[:-1]
    out[0] = starts[0]
    out[at] = starts[1:] - starts[:-1] - counts[:-1] + 1
    return np.cumsum(out)
