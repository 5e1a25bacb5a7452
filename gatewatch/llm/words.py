"""Bytes, words and word windows of whole texts as numpy arrays, batch by batch.

Texts are handled as UTF-8 bytes. The six separators are single bytes that occur in no
longer UTF-8 sequence, so cutting bytes at separators cuts texts at words exactly. Hashes
are polynomials modulo 2**64 over random byte values, computed for all words of a slice
from one running sum, then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are handled in slices of about this many bytes, so that arrays stay small.
SLICE_BYTES = 1 << 19

_GAMMA = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (two multiply-xorshift rounds) of unsigned values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def sequence(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix((np.arange(n, dtype=np.uint64) + np.uint64(1 + (seed << 32))) * _GAMMA)


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, as long as asked for."""

    def __init__(self, seed: int):
        base = (int(sequence(1, seed)[0]) | 1) & 0xFFFFFFFFFFFFFFFF
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("_up", self.base), ("_down", self.inverse)):
                factors = np.full(size, base, dtype=np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))
        return self._up[:n], self._down[:n]


_BYTE_POWERS = {0: Powers(11), 1: Powers(12)}
_WORD_POWERS = {0: Powers(21), 1: Powers(22)}
_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_EXACT = {0: sequence(256, 31), 1: sequence(256, 32)}
_LOWER = {}
for _k, _values in _EXACT.items():
    _LOWER[_k] = _values.copy()
    _LOWER[_k][0x41:0x5B] = _values[0x61:0x7B]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, ends, data = column.buffers()
    if len(column) == 0 or ends is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(ends, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``lo`` to ``hi`` at a time with their bytes and offsets; a row is never cut."""
    data, offsets = text_bytes(column)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """Words of the texts of one slice.

    ``starts`` and ``ends`` are byte positions; words ``first[d]`` to ``first[d + 1]`` are
    those of text ``d``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        if len(data) == 0:
            self.starts = self.ends = np.zeros(0, np.int64)
        else:
            inside = ~_SEPARATOR[data]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            edges = offsets[1:-1]
            begins = edges[edges < len(data)]
            first[begins] = inside[begins]
            finals = edges[edges > 0] - 1
            last[finals] = inside[finals]
            self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def texts(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, lower: bool = False, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, of which there are two independent kinds."""
        return span_hashes(self.data, self.starts, self.ends, lower, which)


# Letters, digits and all bytes of longer UTF-8 sequences make words; case of A-Z and punctuation don't count.
_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


class Tokens:
    """Runs of letters and digits of the texts of one slice, as ``Words`` has runs of non-separators."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        inside = _WORD_BYTE[data] if len(data) else np.zeros(0, bool)
        padded = np.concatenate([[False], inside, [False]])
        begins, ends = inside & ~padded[:-2], inside & ~padded[2:]
        edges = offsets[1:-1]
        at = edges[edges < len(data)]
        begins[at] = inside[at]
        at = edges[edges > 0] - 1
        ends[at] = inside[at]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.hashes = span_hashes(data, self.starts, self.ends, lower=True)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False, which: int = 0) -> np.ndarray:
    """Hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    up, down = _BYTE_POWERS[which].up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER if lower else _EXACT)[which][data] * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * _GAMMA)


def window_hashes(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hashes of each ``size`` consecutive words of a slice, text bounds not minded."""
    n = len(hashes)
    if n < size:
        return np.zeros(0, np.uint64)
    up, down = _WORD_POWERS[which].up_to(n + 1)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    return mix((sums[size:] - sums[:-size]) * down[: n - size + 1] + _length_term(size))


def _length_term(size: int) -> np.uint64:
    return np.uint64(size * int(_GAMMA) & 0xFFFFFFFFFFFFFFFF)


def window_starts(first: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` words of one text begin."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    return ranges(first[:-1], counts)


def ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``begins[i], begins[i] + 1, ...``, ``counts[i]`` values each, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.cumsum(counts) - counts
    return np.repeat(begins - steps, counts) + np.arange(total)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
