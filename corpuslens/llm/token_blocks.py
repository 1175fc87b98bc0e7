"""Token ids in files of patched frame-of-reference blocks."""

from __future__ import annotations

from collections.abc import Iterator
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslens.llm.tokens import encoder, tokenizer_path, with_end
from corpuslens.storage import stage, work_path

#: Ids to a block; share of a block's ids that its width must hold, the others are exceptions.
BLOCK, PERCENTILE = 1024, 0.9
#: Documents to a range of ids, which one task writes; ids from which on it begins another file.
FILE_DOCS, FILE_IDS = 2048, 1 << 22
#: Ranges whose files are placed together.
_NEAR = 1024

_MAGIC = b"PFORIDS1"
_HEAD = "<8sQQQQ"  # magic, documents, ids, ids to a block, blocks
_BLOCK_HEAD = "<IBH"  # least id, width, exceptions


def _room(width: int) -> tuple[str, int]:
    """A big-endian integer type that holds ``width`` bits, and its own bits."""
    return (">u2", 16) if width <= 16 else (">u4", 32)


def encode_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> list[bytes]:
    """Blocks of ``block`` ids: least id, width, packed low bits of the differences, exceptions.

    The width is that of the difference at the percentile. Where a difference has more bits, its
    place and its high bits follow the packed low bits. The last block may be shorter.
    """
    n = len(ids)
    if n == 0:
        return []
    count = -(-n // block)
    padded = np.full(count * block, ids[-1], np.uint32)
    padded[:n] = ids
    rows = padded.reshape(count, block)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    at = min(block - 1, int(block * percentile))
    widths = np.frexp(np.partition(rest, at, axis=1)[:, at].astype(np.float64))[1].astype(np.uint8)
    out: list[bytes] = [b""] * count
    for width in np.unique(widths):
        for chosen in np.array_split(which := np.flatnonzero(widths == width), -(-len(which) // 256)):
            part = rest[chosen]
            kind, room = _room(int(width))
            bits = np.unpackbits(part.astype(kind).view(np.uint8).ravel()).reshape(len(chosen), block, room)
            packed = np.packbits(bits[:, :, room - width :].reshape(len(chosen), -1), axis=1)
            high = part >> np.uint32(width) if width < 32 else np.zeros_like(part)
            for k, b in enumerate(chosen):
                size = min(block, n - b * block)
                places = np.flatnonzero(high[k, :size])
                head = struct.pack(_BLOCK_HEAD, least[b], width, len(places))
                body = packed[k, : (size * int(width) + 7) // 8].tobytes()
                out[b] = head + body + places.astype("<u2").tobytes() + high[k, places].astype("<u4").tobytes()
    return out


def decode_blocks(blocks: list[memoryview], sizes: list[int]) -> list[np.ndarray]:
    """The ids of each block; blocks of one width and size are unpacked together."""
    alike: dict[tuple[int, int], list[int]] = {}
    heads = [struct.unpack_from(_BLOCK_HEAD, b) for b in blocks]
    for i, ((_, width, _), size) in enumerate(zip(heads, sizes)):
        alike.setdefault((width, size), []).append(i)
    out: list[np.ndarray] = [np.empty(0, np.uint32)] * len(blocks)
    at = struct.calcsize(_BLOCK_HEAD)
    for (width, size), members in alike.items():
        kind, room = _room(width)
        used = (size * width + 7) // 8
        for some in (members[k : k + 256] for k in range(0, len(members), 256)):
            packed = np.frombuffer(b"".join(blocks[i][at : at + used] for i in some), np.uint8)
            bits = np.zeros((len(some), size, room), np.uint8)
            if width:
                unpacked = np.unpackbits(packed.reshape(len(some), used), axis=1, count=size * width)
                bits[:, :, room - width :] = unpacked.reshape(len(some), size, width)
            low = np.packbits(bits.ravel()).view(kind).reshape(len(some), size).astype(np.uint32)
            for row, i in zip(low, some):
                least, _, many = heads[i]
                if many:
                    places = np.frombuffer(blocks[i], "<u2", many, at + used)
                    high = np.frombuffer(blocks[i], "<u4", many, at + used + 2 * many)
                    row[places] |= high << np.uint32(width)
                out[i] = row + np.uint32(least)
    return out


def _file_bytes(doc_ids: list[int | None], counts: list[int], ids: np.ndarray, block: int) -> bytes:
    blocks = encode_blocks(ids, block)
    starts = np.cumsum([0, *map(len, blocks)])
    absent = np.array([d is None for d in doc_ids], np.uint8)
    known = np.array([d or 0 for d in doc_ids], "<i8")
    head = struct.pack(_HEAD, _MAGIC, len(doc_ids), len(ids), block, len(blocks))
    parts = [head, absent.tobytes(), known.tobytes(), np.array(counts, "<u8").tobytes(), starts.astype("<u8").tobytes()]
    return b"".join([*parts, *blocks])


class TokenFile:
    """A file of blocks; reads any run of ids from the blocks that hold it."""

    def __init__(self, data: bytes):
        magic, docs, self.n_ids, self.block, blocks = struct.unpack_from(_HEAD, data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        at = struct.calcsize(_HEAD)
        absent = np.frombuffer(data, np.uint8, docs, at)
        known = np.frombuffer(data, "<i8", docs, at := at + docs)
        self.doc_ids = [None if a else int(d) for a, d in zip(absent, known)]
        self.counts = np.frombuffer(data, "<u8", docs, at := at + 8 * docs).astype(np.int64)
        self._starts = np.frombuffer(data, "<u8", blocks + 1, at := at + 8 * docs).astype(np.int64)
        self._body = memoryview(data)[at + 8 * (blocks + 1) :]

    def ids(self, start: int, end: int) -> np.ndarray:
        first, last = start // self.block, -(-end // self.block)
        found = decode_blocks(
            [self._body[self._starts[b] : self._starts[b + 1]] for b in range(first, last)],
            [min(self.block, self.n_ids - b * self.block) for b in range(first, last)],
        )
        joined = np.concatenate(found) if found else np.empty(0, np.uint32)
        return joined[start - first * self.block : end - first * self.block]


def _open(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    end_id: int | None = 2,
    block: int = BLOCK,
    doc_id: str = "doc_id",
    text: str = "text",
    by_word: bool = True,
) -> DataFrame:
    """Write the ids of all texts in ascending ``doc_id`` order; returns ``shard, number, file, n_docs, n_ids``.

    Null text is empty; a null id comes first, rows of one id follow each other by text, and repeated
    rows are written as often as they come. Other columns are not read. A shard is a range of ids; its
    files are numbered, and end at FILE_IDS ids or with the document that reaches them, so that long
    texts don't meet in memory. A file is named for this attempt alone; the manifest, committed by
    Spark, names the files that count, so a task that is lost and run again leaves no trace.
    ``folder`` must be shared by all executors.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    files = max(1, -(-rows.count() // FILE_DOCS))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer, by_word)
        shard, number = TaskContext.get().partitionId(), 0
        doc_ids: list[int | None] = []
        counts: list[np.ndarray] = []
        ids: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal number
            held, name = np.concatenate(ids), f"ids-{shard:06d}-{number:06d}-{uuid.uuid4().hex}.pfor"
            filesystem, base = _open(folder)
            filesystem.create_dir(base, recursive=True)
            with filesystem.open_output_stream(f"{base}/{name}") as out:
                out.write(_file_bytes(doc_ids, np.concatenate(counts).tolist(), held, block))
            row = {"shard": [shard], "number": [number], "file": [name], "n_docs": [len(doc_ids)], "n_ids": [len(held)]}
            number += 1
            for x in (doc_ids, counts, ids):
                x.clear()
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            names = batch.column("doc_id").to_pylist()
            for first, last, found, each in encode.batches(batch.column("text")):
                found, each = with_end(found, each, end_id)
                doc_ids += names[first:last]
                counts.append(each)
                ids.append(found)
                if sum(map(len, ids)) >= FILE_IDS:
                    yield close()
        if doc_ids:
            yield close()

    ordered = rows.repartitionByRange(files, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    schema = "shard bigint, number bigint, file string, n_docs bigint, n_ids bigint"
    return stage(ordered.mapInArrow(write, schema), "token-manifest")


def read_token_files(manifest: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, and ``ids`` on request, from the files.

    ``start`` counts the ids of all documents before. The files before a file come from the manifest,
    which has one row for each of them: sums over neighbouring shards first, then within them, so that
    one task places one row for every _NEAR shards.
    """
    earlier = lambda w: F.coalesce(F.sum("n_ids").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = F.expr(f"shard div {_NEAR}").alias("near")
    sums = manifest.groupBy(near).agg(F.sum("n_ids").alias("n_ids"))
    sums = sums.select("near", earlier(Window.orderBy("near")).alias("before"))
    within = manifest.select("*", near).withColumn("base", earlier(Window.partitionBy("near").orderBy("shard", "number")))
    placed = within.join(sums, "near").withColumn("base", F.col("base") + F.col("before")).drop("before", "near")
    files = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, base = _open(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with filesystem.open_input_stream(f"{base}/{row['file']}") as source:
                    held = TokenFile(source.read())
                ends = np.cumsum(held.counts)
                out: dict[str, list] = {"doc_id": held.doc_ids, "start": (ends - held.counts + row["base"]).tolist(), "n_tokens": held.counts.tolist()}
                all_ids = held.ids(0, held.n_ids).astype("<u4")
                each = np.split(all_ids, ends[:-1]) if len(ends) else []
                out["ids_crc32"] = [zlib.crc32(x.tobytes()) for x in each]
                types = [pa.int64()] * 4
                if with_ids:
                    out["ids"] = [x.tolist() for x in each]
                    types.append(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), types)], names=list(out))

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * with_ids
    return placed.repartition(files, "shard", "number").mapInArrow(read, schema)


def encode_documents(docs: DataFrame, tokenizer: str | None = None, end_id: int | None = 2) -> DataFrame:
    """Write all documents' ids under the session's shared folder and read them back."""
    folder = work_path(docs.sparkSession, "token-files")
    manifest = write_token_files(docs, folder, tokenizer or tokenizer_path(), end_id)
    return read_token_files(manifest, folder)
