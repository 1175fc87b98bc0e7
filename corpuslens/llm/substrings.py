"""Repeated passages found by fixed-block anchors and removed but for their first occurrence."""

from __future__ import annotations

from collections.abc import Iterator
import hashlib
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.arrays import Words, buffer, mix, slices, windows
from corpuslens.llm.expressions import free_name
from corpuslens.storage import stage

#: Words of a window that may not start twice.
WIDTH = 20
#: Text bytes to a slot of hashes, which meet in one task; slots at least and at most.
SLOT_BYTES, LEAST_SLOTS, MOST_SLOTS = 3 << 19, 32, 1 << 18

_COUNT, _COUNT_BYTES = "<II", 8
_NO_ID = np.iinfo(np.int64).min
_WORK = (
    "kind tinyint, doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
    "slot int, data binary, spans array<int>"
)
_DONE, _HASHES, _PENDING = 0, 1, 2


def _planes(x: np.ndarray) -> bytes:
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _from_planes(data: bytes, kind: str, n: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, n).T).view(kind).ravel()


def pack_places(hashes: np.ndarray, doc_ids: np.ndarray, places: np.ndarray) -> bytes:
    """Hashes as they are; ids as differences and places, both compressed by byte planes."""
    import zstandard

    steps = np.diff(doc_ids, prepend=np.int64(0)).astype("<i8")
    small = zstandard.ZstdCompressor(level=1).compress(_planes(steps) + _planes(places.astype("<u4")))
    return struct.pack(_COUNT, len(places), len(small)) + small + hashes.tobytes()


def unpack_places(data: bytes, kind: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import zstandard

    n, size = struct.unpack_from(_COUNT, data)
    plain = zstandard.ZstdDecompressor().decompress(data[_COUNT_BYTES : _COUNT_BYTES + size], max_output_size=12 * n)
    ids = np.cumsum(_from_planes(plain[: 8 * n], "<i8", n)) if n else np.empty(0, np.int64)
    places = _from_planes(plain[8 * n :], "<u4", n).astype(np.int64) if n else np.empty(0, np.int64)
    return np.frombuffer(data, kind, n, _COUNT_BYTES + size), ids, places


def _lists(doc_ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.ListArray]:
    """Distinct places of each document, ascending."""
    order = np.lexsort((places, doc_ids))
    doc_ids, places = doc_ids[order], places[order]
    fresh = np.ones(len(places), bool)
    fresh[1:] = (np.diff(doc_ids) != 0) | (np.diff(places) != 0)
    doc_ids, places = doc_ids[fresh], places[fresh]
    starts = np.flatnonzero(np.diff(doc_ids, prepend=doc_ids[:1] - 1)) if len(doc_ids) else np.empty(0, np.int64)
    ends = np.append(starts, len(doc_ids)).astype(np.int32)
    return doc_ids[starts], pa.ListArray.from_arrays(pa.array(ends), pa.array(places.astype(np.int32)))


def _by_slot(hashes: np.ndarray, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of each hash, and an order by slot that keeps places ascending."""
    slot = ((hashes >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int32)
    return slot, np.argsort(slot, kind="stable")


def _alike(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by hash, the start of each run of equal hashes, and each run's length."""
    order = np.argsort(hashes, kind="stable")
    ranked = hashes[order]
    starts = np.flatnonzero(np.diff(ranked, prepend=~ranked[:1]))
    return order, starts, np.diff(np.append(starts, len(ranked)))


class Anchors:
    """First pass: blocks of half a window, found by every rolling window of their length."""

    def __init__(self, width: int, slots: int):
        self.width, self.block, self.slots = width, width // 2, slots

    def probe(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rolling windows of a block's length, by slot of their hash; windows at whole multiples of
        it are the reference blocks. A hash that comes twice in a slice needs no one else to know
        its places for repeated: they go on as hits (null hash), with one block to be found by."""
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            for first, last in slices(offsets):
                found = Words(data, offsets, first, last)
                heads = np.cumsum(found.counts) - found.counts
                at, hashes = windows(found.hashes, found.doc, self.block)
                long_enough = found.counts[found.doc[at]] >= self.width
                at, hashes = at[long_enough], hashes[long_enough]
                if not len(at):
                    continue
                doc = found.doc[at]
                place = at - heads[doc]
                order, starts, sizes = _alike(hashes)
                several = np.zeros(len(hashes), bool)
                several[order] = np.repeat(sizes > 1, sizes)
                is_block = place % self.block == 0
                # One reference block of each repeated hash, if it has any.
                ranked_block = np.where(is_block[order], np.arange(len(order)), len(order))
                least = np.minimum.reduceat(ranked_block, starts)
                shown = order[least[(sizes > 1) & (least < len(order))]]
                send = ~several
                send[shown] = True
                chosen = np.flatnonzero(send)
                slot, by = _by_slot(hashes[chosen], self.slots)
                rows_slot, rows_data, rows_hit = [], [], []
                chosen = chosen[by]
                edges = np.flatnonzero(np.diff(slot[by], prepend=-1, append=-1))
                low = hashes.astype("<u4")
                for a, b in zip(edges, edges[1:]):
                    part = chosen[a:b]
                    rows_slot.append(int(slot[by[a]]))
                    rows_data.append(pack_places(low[part], ids[first + doc[part]], place[part]))
                    rows_hit.append(False)
                hit = np.flatnonzero(several)
                if len(hit):
                    rows_slot.append(int(hashes[0] % np.uint64(self.slots)))
                    rows_data.append(pack_places(low[:0], ids[first + doc[hit]], place[hit]))
                    rows_hit.append(True)
                yield pa.RecordBatch.from_pydict({"slot": pa.array(rows_slot, pa.int32()), "hit": rows_hit, "data": rows_data})

    def match(self, group: pa.Table) -> pa.Table:
        """Hits: windows that equal a reference block elsewhere. ``doc_id, places``."""
        hit = group.column("hit").to_pylist()
        data = group.column("data").to_pylist()
        known = [unpack_places(d, "<u4") if not h else None for d, h in zip(data, hit)]
        given = []
        for d, h in zip(data, hit):
            if h:
                n, size = struct.unpack_from(_COUNT, d)
                _, ids, places = unpack_places(d + bytes(4 * n), "<u4")
                given.append((ids, places))
        known = [k for k in known if k is not None]
        ids, places = np.empty(0, np.int64), np.empty(0, np.int64)
        if known:
            hashes, ids, places = (np.concatenate(x) for x in zip(*known))
            order, starts, sizes = _alike(hashes)
            block = places[order] % self.block == 0
            blocks = np.repeat(np.add.reduceat(block, starts, dtype=np.int64), sizes)
            found = order[blocks - block > 0]
            ids, places = ids[found], places[found]
        ids = np.concatenate([ids, *(g[0] for g in given)])
        places = np.concatenate([places, *(g[1] for g in given)])
        owners, lists = _lists(ids, places)
        return pa.table({"doc_id": pa.array(owners), "places": lists})


def _spans(removed: np.ndarray) -> np.ndarray:
    """Runs of True as starts and ends by turns."""
    edges = np.flatnonzero(np.diff(removed.astype(np.int8), prepend=0, append=0))
    return edges.astype(np.int32)


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def _finish(words: list[bytes], starts: np.ndarray, width: int) -> tuple[int, str, np.ndarray]:
    removed = _covered(starts, width, len(words))
    kept = [w for w, gone in zip(words, removed) if not gone] if removed.any() else words
    return int(removed.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), _spans(removed)


class Extension:
    """Second pass: windows around hits, compared as a whole, so that hits grow to exact repeats."""

    def __init__(self, width: int, slots: int):
        self.width, self.block, self.slots = width, width // 2, slots

    def extend(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Finished documents, window hashes by slot, and documents that wait for the answer.

        A document with an equal text of a lesser id is a copy, all of whose windows come earlier.
        Of equal windows in a slice only the first is asked about; the others are known to be later.
        """
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            ids = batch.column("doc_id").to_numpy()
            copies = batch.column("is_copy").to_numpy(zero_copy_only=False)
            all_places = batch.column("places")
            for first, last in slices(offsets):
                yield self._slice(data, offsets, ids, copies, all_places, first, last)

    def _slice(self, data, offsets, ids, copies, all_places, first, last) -> pa.RecordBatch:
        found = Words(data, offsets, first, last)
        heads = np.cumsum(found.counts) - found.counts
        n = len(found.hashes)
        near = np.zeros(n + 1, np.int32)
        waiting = np.zeros(last - first, bool)
        for d in range(last - first):
            places = all_places[first + d]
            if places.is_valid and len(places) and not copies[first + d] and found.counts[d] >= self.width:
                waiting[d] = True
                at = np.asarray(places.values, np.int64)
                np.add.at(near, heads[d] + np.maximum(at - (self.width - self.block), 0), 1)
                np.add.at(near, heads[d] + at + 1, -1)
        at, hashes = windows(found.hashes, found.doc, self.width)
        asked = (np.cumsum(near[:-1]) > 0)[at]
        at, hashes = at[asked], hashes[asked]
        doc = found.doc[at]
        owner, place = ids[first + doc], at - heads[doc]
        order = np.lexsort((place, owner, hashes))
        ranked = hashes[order]
        opens = np.diff(ranked, prepend=~ranked[:1]) != 0
        starts = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        lead = order[starts][run] if len(order) else order
        later = (owner[order] != owner[lead]) | (place[order] != place[lead])
        known = np.zeros(len(at), bool)
        known[order] = later
        ask = np.sort(order[starts])
        slot, by = _by_slot(hashes[ask], self.slots)
        ask = ask[by]
        columns: dict[str, list] = {k: [] for k in ("kind", "doc_id", "n_words", "n_removed", "kept_sha256", "slot", "data", "spans")}

        def add(**row):
            for k in columns:
                columns[k].append(row.get(k))

        edges = np.flatnonzero(np.diff(slot[by], prepend=-1, append=-1))
        for a, b in zip(edges, edges[1:]):
            part = ask[a:b]
            add(kind=_HASHES, slot=int(slot[by[a]]), data=pack_places(hashes[part].astype("<u8"), owner[part], place[part]))
        bounds = np.searchsorted(at, np.append(heads, n))
        raw = data[offsets[first] : offsets[last]].tobytes()
        base = offsets - offsets[first]
        for d in range(last - first):
            words = raw[base[first + d] : base[first + d + 1]].split()
            own = slice(bounds[d], bounds[d + 1])
            if copies[first + d] and len(words) >= self.width:
                gone = np.arange(len(words) - self.width + 1)
            elif waiting[d]:
                gone = place[own][known[own]]
                spans = _spans(_covered(gone, self.width, len(words)))
                add(kind=_PENDING, doc_id=int(ids[first + d]), n_words=len(words), data=b" ".join(words), spans=spans)
                continue
            else:
                gone = np.empty(0, np.int64)
            n_removed, sha, spans = _finish(words, gone, self.width)
            add(kind=_DONE, doc_id=int(ids[first + d]), n_words=len(words), n_removed=n_removed, kept_sha256=sha, spans=spans)
        kinds = (pa.int8(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns.values(), kinds)], names=list(columns))

    def first_places(self, group: pa.Table) -> pa.Table:
        """Windows whose sequence starts earlier elsewhere: ``doc_id, places``."""
        hashes, ids, places = (np.concatenate(x) for x in zip(*(unpack_places(d, "<u8") for d in group.column("data").to_pylist())))
        order = np.lexsort((places, ids, hashes))
        ranked = hashes[order]
        opens = np.diff(ranked, prepend=~ranked[:1]) != 0
        lead = order[np.flatnonzero(opens)][np.cumsum(opens) - 1]
        later = order[(ids[order] != ids[lead]) | (places[order] != places[lead])]
        owners, lists = _lists(ids[later], places[later])
        return pa.table({"doc_id": pa.array(owners), "places": lists})

    def finish(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that waited, with the removed words of both answers."""
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "n_words", "n_removed", "kept_sha256", "spans")}
            for row in zip(*(batch.column(k) for k in ("doc_id", "data", "spans", "places"))):
                doc_id, data, spans, places = row
                words = data.as_py().split()
                gone = np.asarray(places.values, np.int64) if places.is_valid else np.empty(0, np.int64)
                removed = _covered(gone, self.width, len(words))
                for a, b in np.asarray(spans.values).reshape(-1, 2):
                    removed[a:b] = True
                kept = [w for w, g in zip(words, removed) if not g]
                values = (doc_id.as_py(), len(words), int(removed.sum()), hashlib.sha256(b" ".join(kept)).hexdigest(), _spans(removed))
                for k, v in zip(out, values):
                    out[k].append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def find_repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, spans`` for each row of ``docs``.

    Words are runs of characters but ASCII white space. A word is removed if a window of ``width``
    words over it also starts earlier, by ``doc_id``, then by place; windows are those of the input.
    ``spans`` are the removed runs of words, starts and ends by turns: the maximal exact repeats.
    ``kept_sha256`` is that of the kept words joined by one space. Null text has no words; texts of
    fewer than ``width`` words lose none. A row without an id has no place: it loses no words and
    no one loses any to it. Rows of one id share their places, so a repeated row is no earlier than
    the other; ids are meant to name texts. Other columns are not read; an empty table gives no rows.

    Two equal windows hold, whatever the alignment, a whole block of half their width that starts at
    a multiple of it in one of them. So the blocks of all texts are the index and every rolling
    window of their length probes it; both are dealt by hash into slots whose number follows the
    text. Hits are extended by comparing the windows around them as a whole. A slice of texts sends
    each hash once, so a passage that many documents share makes no slot large.
    """
    identity = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(_NO_ID)).alias("doc_id")
    given = docs.select(identity, F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = given.filter(F.col("doc_id") != _NO_ID)
    size = given.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    slots = min(max(size // SLOT_BYTES, LEAST_SLOTS), MOST_SLOTS)
    anchors, extension = Anchors(width, slots), Extension(width, slots)
    hits = stage(
        placed.mapInArrow(anchors.probe, "slot int, hit boolean, data binary")
        .groupBy("slot").applyInArrow(lambda group: anchors.match(group), "doc_id bigint, places array<int>"),
        "repeats-hits",
    )
    digests = placed.select("doc_id", F.md5("text").alias("digest"))
    firsts = stage(
        digests.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"),
        "repeats-texts",
    )
    copies = digests.join(firsts, "digest").filter("doc_id > least").select("doc_id").distinct()
    merged = hits.groupBy("doc_id").agg(F.flatten(F.collect_list("places")).alias("places"))
    known = stage(merged.join(copies.withColumn("is_copy", F.lit(True)), "doc_id", "full"), "repeats-known")
    work = stage(
        # What texts are joined to grows with them, so it is never broadcast, at any size.
        given.join(known.hint("merge"), "doc_id", "left")
        .select("doc_id", "text", "places", F.coalesce("is_copy", F.lit(False)).alias("is_copy"))
        .mapInArrow(extension.extend, _WORK),
        "repeats-work",
    )
    answers = (
        work.filter(F.col("kind") == _HASHES).select("slot", "data").groupBy("slot")
        .applyInArrow(lambda group: extension.first_places(group), "doc_id bigint, places array<int>")
        .groupBy("doc_id").agg(F.flatten(F.collect_list("places")).alias("places"))
    )
    result = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, spans array<int>"
    done = work.filter(F.col("kind") == _DONE).select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
    waited = (
        work.filter(F.col("kind") == _PENDING).select("doc_id", "data", "spans").join(answers, "doc_id", "left")
        .mapInArrow(extension.finish, result)
    )
    return done.union(waited).withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(_NO_ID)))


def cut_repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the removed words cut out of ``text``, each with the white space before it.

    ``n_chars``, where there is one, is that of the new text. A row of a null id, which no span can
    name, keeps its text.
    """
    own, spans_of = free_name(docs, "_id"), free_name(docs, "_spans")
    found = stage(
        find_repeats(docs, width, doc_id, text).filter("n_removed > 0 AND doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias(own)).agg(F.first("spans").alias(spans_of)),
        "repeats-spans",
    )
    at = docs.columns.index(text)
    joined = docs.join(found.hint("merge"), F.col(doc_id) == F.col(own), "left").drop(own)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(len(schema_names))
            texts = batch.column(at).to_pylist()
            for i in np.flatnonzero(np.asarray(spans.is_valid())):
                raw = texts[i].encode()
                found = Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), 0, 1)
                parts, done = [], 0
                for a, b in np.asarray(spans[int(i)].values).reshape(-1, 2):
                    start = int(found.ends[a - 1]) if a else 0
                    parts.append(raw[done:start])
                    done = int(found.ends[b - 1])
                texts[i] = b"".join([*parts, raw[done:]]).decode().strip()
            arrays = [c for c in batch.columns[: len(schema_names)]]
            arrays[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names=schema_names)

    schema_names = docs.columns
    changed = joined.select(*[F.col(c) for c in docs.columns], spans_of).mapInArrow(cut, schema)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.char_length(text).cast(docs.schema["n_chars"].dataType))
    return changed
