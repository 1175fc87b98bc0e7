"""Token ids of texts, by a public tokenizer that treats words apart."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
import os
import sys
import types

import numpy as np
import pyarrow as pa

from corpuslens.llm.arrays import FOLD, SPACE, buffer, mix

#: Parts of words whose ids a worker keeps, and bytes of a part that is kept; slots are twice the parts.
KEPT_PARTS, KEPT_BYTES = 1 << 19, 64
#: Bytes of text that are worked on at a time.
SLICE_BYTES = 1 << 20
_TOGETHER = 4096

#: Holds a worker's encoders from task to task: code that comes by value has no module to keep them.
_KEPT = "corpuslens_llm_encoders"

#: Byte classes: white space, letters, digits, signs. 0xC3 leads the letters from U+00C0 to U+00FF.
_GAP, _LETTER, _DIGIT, _SIGN = range(4)
_CODES = np.arange(256)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[((_CODES | 0x20) >= 0x61) & ((_CODES | 0x20) <= 0x7A) | (_CODES >= 0x80)] = _LETTER
_CLASS[(_CODES >= 0x30) & (_CODES <= 0x39)] = _DIGIT
_CLASS[SPACE] = _GAP
_LEAD, _TIMES, _DIVIDE = 0xC3, 0x97, 0xB7
_SECOND = np.uint64(0xD1B54A32D192ED03)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Keys of 128 bits in open addressing, each with a run of ids; emptied when it is full."""

    def __init__(self, parts: int):
        slots = 1 << (2 * parts - 1).bit_length()
        self._limit, self._mask = parts, np.uint64(slots - 1)
        self._first, self._second = np.zeros(slots, np.uint64), np.zeros(slots, np.uint64)
        self._at, self._count = np.zeros(slots, np.int64), np.zeros(slots, np.int32)
        self._ids = np.empty(1 << 16, "<u4")
        self._parts = self._filled = 0

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key, or -1."""
        slot = (first & self._mask).astype(np.int64)
        out = np.full(len(first), -1, np.int64)
        left = np.arange(len(first))
        while len(left):
            held = self._first[slot]
            hit = (held == first[left]) & (self._second[slot] == second[left])
            out[left[hit]] = slot[hit]
            on = ~hit & (held != 0)
            left, slot = left[on], (slot[on] + 1) & int(self._mask)
        return out

    def add(self, first: np.ndarray, second: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Distinct new keys with their numbers of ids, one run after the other."""
        if self._parts + len(first) > self._limit:
            self._first[:] = 0
            self._parts = self._filled = 0
        at = self._filled + np.cumsum(counts) - counts
        while self._filled + len(ids) > len(self._ids):
            self._ids = np.concatenate([self._ids, np.empty_like(self._ids)])
        self._ids[self._filled : self._filled + len(ids)] = ids
        self._filled += len(ids)
        self._parts += len(first)
        slot = (first & self._mask).astype(np.int64)
        left = np.arange(len(first))
        while len(left):
            free = np.flatnonzero(self._first[slot] == 0)
            # Of the keys that want one free slot, one gets it.
            self._at[slot[free]] = left[free]
            won = free[self._at[slot[free]] == left[free]]
            self._first[slot[won]], self._second[slot[won]] = first[left[won]], second[left[won]]
            self._at[slot[won]], self._count[slot[won]] = at[left[won]], counts[left[won]]
            on = np.ones(len(left), bool)
            on[won] = False
            left, slot = left[on], (slot[on] + 1) & int(self._mask)

    def runs(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self._at[slots], self._count[slots].astype(np.int64)

    def take(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self._ids[np.arange(total) + np.repeat(at - ends + counts, counts)]


class Parts:
    """The parts of texts' bytes that the tokenizer treats apart: ``starts``, ``ends``, ``simple``.

    Words are runs of bytes but ASCII white space. A simple word has ASCII bytes and letters from
    U+00C0 to U+00FF alone, no apostrophe and no ``<|``; its parts are its runs of letters, its
    digits, and its runs of signs. Any other word is one part. Parts don't run on from text to text.
    """

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        n = len(data)
        kind = _CLASS[data]
        odd = data >= 0x80
        if odd.any():
            high = np.flatnonzero(odd)
            lead = data[high] == _LEAD
            tail = np.zeros(len(high), bool)
            tail[1:] = lead[:-1] & (high[1:] == high[:-1] + 1)
            latin = lead | (tail & (data[high] != _TIMES) & (data[high] != _DIVIDE))
            odd[high[latin]] = False
        odd |= data == 0x27
        special = np.flatnonzero(data[:-1] == 0x3C) if n > 1 else np.empty(0, np.int64)
        odd[special[data[special + 1] == 0x7C]] = True
        solid = kind != _GAP
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        inner = edges[(edges > 0) & (edges < n)]
        opens[inner] = solid[inner]
        inside = opens.copy()
        word_starts = np.flatnonzero(opens)
        # Within a simple word a part begins where the class changes and at each digit.
        inside[1:] |= solid[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
        self.starts = np.flatnonzero(inside)
        complex_words = np.zeros(len(word_starts), bool)
        complex_words[np.searchsorted(word_starts, np.flatnonzero(odd & solid), "right") - 1] = True
        if complex_words.any():
            of = np.searchsorted(word_starts, self.starts, "right") - 1
            keep = opens[self.starts] | ~complex_words[of]
            self.starts, of = self.starts[keep], of[keep]
            self.simple = ~complex_words[of]
        else:
            self.simple = np.ones(len(self.starts), bool)
        closes = solid.copy()
        closes[:-1] &= ~solid[1:]
        closes[inner - 1] = solid[inner - 1]
        word_ends = np.flatnonzero(closes) + 1
        self.ends = np.minimum(
            np.append(self.starts[1:], n), word_ends[np.searchsorted(word_ends, self.starts, "right")] if len(word_ends) else 0
        )


def keys(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each run of bytes, eight bytes at a time; the first is never 0."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    first = sizes.astype(np.uint64) * _SECOND
    second = mix(first)
    left = np.arange(len(starts))
    for at in range(0, int(sizes.max(initial=0)), 8):
        if at:
            left = left[sizes[left] > at]
        room = np.minimum(sizes[left] - at, 8)
        value = eights[starts[left] + at] & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - room).astype(np.uint64)))
        first[left] = mix(first[left] ^ value)
        second[left] = (second[left] ^ (value >> np.uint64(29)) ^ value) * _SECOND
    return np.maximum(first, 1), mix(second)


class Encoder:
    """Ids of texts as little-endian 32-bit integers.

    With ``by_word`` a part of a word is encoded once and its ids are kept, up to KEPT_PARTS of them:
    right for a tokenizer that drops white space and never joins what it parts, as the default file
    does (it normalises by character, with lower case, then splits into letters, digits and signs).
    Parts are told by 128 bits of hash.
    """

    def __init__(self, path: str, by_word: bool):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._by_word = by_word
        self._table = Table(KEPT_PARTS) if by_word else None

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(x.ids, "<u4") for x in found]

    def _together(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids, and ids, of simple parts, encoded as one text that the tokenizer parts again."""
        found = self._tokenizer.encode_batch([" ".join(texts)], add_special_tokens=False)[0]
        counts = np.bincount(np.asarray(found.word_ids, np.int64), minlength=len(texts))
        if len(counts) == len(texts) and counts.all():
            return counts, np.asarray(found.ids, "<u4")
        each = self._plain(texts)
        return np.array([len(x) for x in each], np.int64), np.concatenate(each)

    def _encode(self, texts: list[str], simple: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The order in which the parts were encoded, their numbers of ids and their ids in it."""
        counts, ids = [np.empty(0, np.int64)], [np.empty(0, "<u4")]
        order = np.argsort(~simple, kind="stable")
        many = int(simple.sum())
        for at in range(0, len(texts), _TOGETHER):
            some = [texts[i] for i in order[at : at + _TOGETHER]]
            cut = min(max(many - at, 0), len(some))
            if cut:
                c, x = self._together(some[:cut])
                counts.append(c)
                ids.append(x)
            if cut < len(some):
                each = self._plain(some[cut:])
                counts.append(np.array([len(x) for x in each], np.int64))
                ids += each
        return order, np.concatenate(counts), np.concatenate(ids)

    def _slice(self, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a slice, and the number of each."""
        parts = Parts(data, edges)
        starts, sizes = parts.starts, parts.ends - parts.starts
        folded = FOLD[data]
        first, second = keys(folded, starts, sizes)
        slots = self._table.find(first, second)
        extra = None
        unknown = np.flatnonzero(slots < 0)
        at, counts = self._table.runs(slots)
        if len(unknown):
            _, once, which = np.unique(first[unknown], return_index=True, return_inverse=True)
            if (second[unknown[once]][which] != second[unknown]).any():  # two parts of one first hash
                once, which = np.arange(len(unknown)), np.arange(len(unknown))
            new = unknown[once]
            raw = data.tobytes()
            texts = [raw[a:b].decode() for a, b in zip(starts[new].tolist(), parts.ends[new].tolist())]
            order, n_ids, ids = self._encode(texts, parts.simple[new])
            begins = np.cumsum(n_ids) - n_ids
            place = np.empty(len(new), np.int64)
            place[order] = np.arange(len(new))
            counts[unknown], at[unknown] = n_ids[place][which], begins[place][which]
            extra = ids
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        out = np.empty(total, "<u4")
        if extra is None:
            out[:] = self._table.take(at, counts)
        else:
            known = np.repeat(slots >= 0, counts)
            places = np.arange(total) + np.repeat(at - ends + counts, counts)
            out[known] = self._table._ids[places[known]]
            out[~known] = extra[places[~known]]
            if len(once) <= self._table._limit // 4:
                kept = np.flatnonzero(sizes[new][order] <= KEPT_BYTES)
                new = new[order][kept]
                runs = np.arange(int(n_ids[kept].sum())) + np.repeat(begins[kept] - np.cumsum(n_ids[kept]) + n_ids[kept], n_ids[kept])
                self._table.add(first[new], second[new], n_ids[kept], extra[runs])
        of = np.searchsorted(edges, starts, "right") - 1
        return out, np.bincount(of, weights=counts, minlength=len(edges) - 1).astype(np.int64)

    def batches(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """``first, last, ids, counts`` of ranges of the texts, of about a megabyte each; null is empty."""
        data, offsets = buffer(texts)
        first, n = 0, len(offsets) - 1
        while first < n:
            last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, "right")) - 1
            last = min(max(last, first + 1), n)
            some = data[offsets[first] : offsets[last]]
            edges = offsets[first : last + 1] - offsets[first]
            if self._by_word:
                ids, counts = self._slice(some, edges)
            else:
                raw = some.tobytes()
                each = self._plain([raw[a:b].decode() for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())])
                counts = np.array([len(x) for x in each], np.int64)
                ids = np.concatenate([np.empty(0, "<u4"), *each])
            yield first, last, ids, counts
            first = last

    def ids(self, texts: Sequence[bytes | None]) -> list[bytes]:
        """Ids of each UTF-8 text; null is empty."""
        out = []
        for _, _, ids, counts in self.batches(pa.array(texts, pa.binary())):
            raw, ends = ids.tobytes(), (4 * np.cumsum(counts)).tolist()
            out += [raw[a:b] for a, b in zip([0, *ends], ends)]
        return out


def encoder(path: str, by_word: bool = True) -> Encoder:
    """This worker's encoder; kept between tasks."""
    kept = sys.modules.setdefault(_KEPT, types.ModuleType(_KEPT)).__dict__
    if (path, by_word) not in kept:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        kept[path, by_word] = Encoder(path, by_word)
    return kept[path, by_word]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The ids of texts with an id after each, and the numbers with it."""
    if end_id is None:
        return ids, counts
    out = np.empty(len(ids) + len(counts), "<u4")
    last = np.cumsum(counts + 1) - 1
    own = np.ones(len(out), bool)
    own[last] = False
    out[last], out[own] = end_id, ids
    return out, counts + 1
