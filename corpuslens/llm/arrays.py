"""Words of Arrow text columns as numpy arrays: boundaries, hashes and rolling windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_WINDOW_MULTIPLIER = np.uint64(0xD6E8FEB86659FD93)
#: Texts are worked on in slices of about so many bytes, so that memory stays small.
SLICE_BYTES = 2 << 20
#: Words that are hashed at a time.
CHUNK_WORDS = 1 << 15

#: Byte classes: True separates words.
SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_ASCII = np.arange(256)
LETTERS_ONLY = ~(((_ASCII | 0x20) >= 0x61) & ((_ASCII | 0x20) <= 0x7A) | (_ASCII >= 0x80))
FOLD = np.where((_ASCII >= 0x41) & (_ASCII <= 0x5A), _ASCII + 0x20, _ASCII).astype(np.uint8)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _MULTIPLIER)
_powers = np.ones(1, np.uint64)


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = 1 << max(6, (n - 1).bit_length())
        _powers = np.concatenate([np.ones(1, np.uint64), np.full(size, _MULTIPLIER)])
        _powers = np.multiply.accumulate(_powers)
    return _powers[:n]


def buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``limit`` bytes, of one text at least."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


class Words:
    """The words of texts ``first`` to ``last``: byte ``starts`` and ``ends``, ``doc``, ``hashes``."""

    def __init__(
        self,
        data: np.ndarray,
        offsets: np.ndarray,
        first: int,
        last: int,
        separators: np.ndarray = SPACE,
        fold: np.ndarray | None = None,
    ):
        at = offsets[first : last + 1] - offsets[first]
        self.bytes = data[offsets[first] : offsets[last]]
        solid = ~separators[self.bytes]
        n = len(solid)
        opens, closes = solid.copy(), solid.copy()
        opens[1:] &= ~solid[:-1]
        closes[:-1] &= ~solid[1:]
        inner = at[(at > 0) & (at < n)]  # words don't run on from text to text
        opens[inner] = solid[inner]
        closes[inner - 1] = solid[inner - 1]
        self.starts, self.ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.doc = np.searchsorted(at, self.starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=last - first).astype(np.int64)
        self._solid = self.bytes[solid] if fold is None else fold[self.bytes[solid]]
        self.sizes = self.ends - self.starts
        self.hashes = self.prefix_hashes(None)

    def prefix_hashes(self, length: int | None) -> np.ndarray:
        """64-bit hash of each word, or of its first ``length`` bytes; some words at a time."""
        out = np.empty(len(self.sizes), np.uint64)
        begin = 0
        for first in range(0, len(out), CHUNK_WORDS):
            sizes = self.sizes[first : first + CHUNK_WORDS]
            at = np.cumsum(sizes) - sizes
            n = int(at[-1] + sizes[-1])
            place = np.arange(n) - np.repeat(at, sizes)
            values = _BYTE[self._solid[begin : begin + n]] * _power(int(sizes.max()))[place]
            if length is not None:
                values[place >= length] = 0
                sizes = np.minimum(sizes, length)
            total = np.add.reduceat(values, at) + sizes.astype(np.uint64) * _MULTIPLIER
            out[first : first + len(sizes)] = mix(total)
            begin += n
        return out


def windows(hashes: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of all runs of ``width`` words within one text."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for k in range(1, width):
        total *= _WINDOW_MULTIPLIER
        total += hashes[k : k + n]
    whole = doc[:n] == doc[width - 1 :]
    return np.flatnonzero(whole), mix(total[whole])
