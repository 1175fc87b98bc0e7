"""Word n-grams of Arrow token lists and their counts, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors receive the kernel by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SPACE = pa.scalar(" ", pa.large_string())
# Tokens that are counted at once.
_SLICE_TOKENS = 1 << 20


def _slices(lists: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """Ranges of rows of about ``_SLICE_TOKENS`` tokens, of one row at least, and their numbers of tokens."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    first = 0
    while first < len(sizes):
        done = ends[first] - sizes[first]
        last = max(first + 1, int(np.searchsorted(ends, done + _SLICE_TOKENS, "right")))
        yield first, last, sizes[first:last]
        first = last


def _grams(tokens: pa.Array, row: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """For each width: rows and numbers of its n-grams, and the distinct n-grams by number."""
    coded = tokens.cast(pa.large_string()).dictionary_encode()
    words, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    gram, names = code, words
    for width in range(1, high + 1):
        if width > 1:
            whole = np.flatnonzero(row[: max(0, len(row) - width + 1)] == row[width - 1 :])
            # Shorter n-grams are known by their place: drop those that end with their row.
            kept, gram = np.unique(gram[np.searchsorted(place, whole)] * len(words) + code[whole + width - 1], return_inverse=True)
            if len(kept):
                names = pc.binary_join_element_wise(names.take(kept // len(words)), words.take(kept % len(words)), _SPACE)
            else:
                names = names[:0]
            place = whole
        else:
            place = np.arange(len(row))
        if width >= low:
            yield row[place], gram, names


def coded_terms(lists: pa.Array, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]]:
    """``(row, code, n, names)``: every row's distinct n-grams, by their place in ``names``, and how often each stands in it."""
    for first, last, sizes in _slices(lists):
        row = np.repeat(np.arange(last - first), sizes)
        for at, gram, names in _grams(lists[first:last].flatten(), row, low, high):
            if len(at):
                key, n = np.unique(at * len(names) + gram, return_counts=True)
                yield first + key // len(names), key % len(names), n, names


def row_terms(lists: pa.Array, low: int, high: int) -> Iterator[tuple[np.ndarray, pa.Array, np.ndarray]]:
    """``(row, term, n)``: every row's distinct n-grams and how often each stands in it."""
    for row, code, n, names in coded_terms(lists, low, high):
        yield row, names.take(code), n


def all_terms(lists: pa.Array, low: int, high: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """``(term, n)``: n-grams of some rows together; one may come again with other rows."""
    for first, last, sizes in _slices(lists):
        row = np.repeat(np.arange(last - first), sizes)
        for _, gram, names in _grams(lists[first:last].flatten(), row, low, high):
            if len(gram):
                yield names, np.bincount(gram, minlength=len(names))


def pack(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """One binary value for each range of ``values`` that begins at ``starts``."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def unpack(column: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows that :func:`pack` put together, and how many each row has."""
    parts = [c for c in column.chunks if len(c)]
    sizes = [pc.binary_length(c).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize for c in parts]
    data = []
    for c in parts:
        offsets = np.frombuffer(c.buffers()[1], np.int32)[c.offset : c.offset + len(c) + 1]
        raw = np.frombuffer(c.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        data.append(raw.view(kind))
    return np.concatenate([np.empty(0, kind), *data]), np.concatenate([np.empty(0, np.int64), *sizes])
