"""Documents cut into pieces and packed into sequences by vector best-fit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.mixing import source_blocks
from corpuslens.llm.tokens import encoder, tokenizer_path, with_end
from corpuslens.storage import stage

#: Pieces that are packed together, in one task; each such group leaves at most a few open sequences.
GROUP_PIECES = 16_384
#: The same where a stored order is followed: a sequence's pieces come from so many neighbours.
ORDERED_PIECES = 2_048
#: Columns of a stored row's place.
PLACE = ("_part", "_file", "_row")
_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


@dataclass(frozen=True)
class Capacities:
    """What a sequence holds: tokens, pieces, and the sum of squared piece lengths (attention).

    ``weights`` are those of the three residuals, each a share of its capacity. ``rule`` is ``norm``,
    which takes the bin whose weighted residuals are least after the piece is placed, or ``dot``,
    which takes the bin whose weighted residuals have the largest dot product with the piece.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"


def best_fit(lengths: np.ndarray, capacities: Capacities = Capacities()) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece: longest first, into the open bin the rule picks, else a new one.

    A bin is open to a piece only if tokens, documents and attention all have room for it. A piece
    beyond a capacity by itself has a bin of its own. Ties go to the oldest bin.
    """
    limits = np.array([capacities.tokens, capacities.documents, capacities.attention], np.int64)
    weights = np.asarray(capacities.weights)
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    left = np.zeros((64, 3), np.int64)
    names = np.zeros(64, np.int64)
    used, made = 0, 0
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1, lengths[i] * lengths[i]], np.int64)
        room = left[:used] - need
        fits = np.flatnonzero((room >= 0).all(axis=1))
        if len(fits):
            if capacities.rule == "dot":
                score = -((left[fits] / limits) * (need / limits) * weights).sum(axis=1)
            else:
                score = ((room[fits] / limits) ** 2 * weights).sum(axis=1)
            least = np.flatnonzero(score == score.min())
            k = fits[least[np.argmin(names[fits[least]])]]
            offsets[i] = limits[0] - left[k, 0]
            left[k] = room[k]
        else:
            if used == len(left):
                left, names = np.concatenate([left, np.zeros_like(left)]), np.concatenate([names, np.zeros_like(names)])
            k, used = used, used + 1
            left[k], names[k], made = limits - need, made, made + 1
        bins[i] = names[k]
        if (left[k] <= 0).any():  # nothing fits any more
            used -= 1
            left[k], names[k] = left[used], names[used]
    return bins, offsets


def cut_pieces(
    docs: DataFrame, tokenizer: str, length: int = 2048, end_id: int = 0, with_ids: bool = False,
    doc_id: str = "doc_id", text: str = "text", by_word: bool = True, carry: Sequence[str] = (),
) -> DataFrame:
    """Pieces of all documents: ``doc_id, piece, start, length, ids_crc32``, and ``ids`` on request.

    A document is its text's ids, then ``end_id``; null text is empty. Only documents of more than
    ``length`` ids are cut. Repeated rows give repeated pieces. Of the other
    columns only those of ``carry``, which are bigint, are read and repeated for each piece.
    """
    schema = _PIECES + ", ids binary" * with_ids + "".join(f", `{c}` bigint" for c in carry)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, by_word)
        heads = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
        for batch in batches:
            for first, last, ids, counts in encode.batches(batch.column("text")):
                ids, counts = with_end(ids, counts, end_id)
                pieces = np.maximum(1, -(-counts // length))
                origin = np.repeat(np.arange(last - first), pieces)
                piece = np.arange(len(origin)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * length
                size = np.minimum(counts[origin] - start, length)
                begins = (np.cumsum(counts) - counts)[origin] + start
                parts = [ids[a : a + n].tobytes() for a, n in zip(begins.tolist(), size.tolist())]
                from_row = pa.array(origin + first, pa.int64())
                arrays = [batch.column("doc_id").take(from_row), pa.array(piece, pa.int32()), pa.array(start, pa.int64())]
                arrays += [pa.array(size, pa.int64()), pa.array([zlib.crc32(x) for x in parts], pa.int64())]
                arrays += [pa.array(parts, pa.binary())] * with_ids
                arrays += [batch.column(c).take(from_row) for c in carry]
                yield pa.RecordBatch.from_arrays(arrays, names=[*heads, *carry])

    columns = [F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), *carry]
    return docs.select(*columns).mapInArrow(cut, schema)


def with_place(docs: DataFrame) -> DataFrame:
    """``docs``, read from a table that one write stored, with the columns of PLACE.

    Parquet promises no order when it is read, so a row's place is taken from where it is stored: the
    number of the writer's part, of the part's file, and the row's index in the file.
    """
    name = F.col("_metadata.file_name")
    return docs.select(
        "*",
        F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("bigint").alias(PLACE[0]),
        F.regexp_extract(name, r"-c(\d+)\.", 1).try_cast("bigint").alias(PLACE[1]),
        F.col("_metadata.row_index").alias(PLACE[2]),
    )


def in_order_of_openers(bins: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``bins`` numbered anew by the place of the piece that opened each."""
    opened = bins[offsets == 0]
    number = np.empty(len(opened), np.int64)
    number[opened] = np.arange(len(opened))
    return number[bins]


def pack_pieces(
    pieces: DataFrame, capacities: Capacities = Capacities(), order: Sequence[str] = (),
    ordered_pieces: int = ORDERED_PIECES,
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; they must be a stored table, as it is read twice.

    Pieces are dealt by hash into groups of about GROUP_PIECES, whatever documents they are of, and
    each group is packed by best_fit. A group wastes little more than one sequence.

    With the columns ``order``, which are dropped, pieces are put in that order and groups are runs of
    about ``ordered_pieces`` of them. Sequences are numbered by group, then by the place of the
    piece that opened them, so they follow the order to within a group.
    """
    number = pieces.count()
    groups = max(1, -(-number // (ordered_pieces if order else GROUP_PIECES)))
    kept = [f for f in pieces.schema.fields if f.name not in order]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    by = ["_index"] if order else ["doc_id", "piece"]

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(by, kind="stable", na_position="first").reset_index(drop=True)
        bins, offsets = best_fit(part["length"].to_numpy(), capacities)
        if order:
            bins = in_order_of_openers(bins, offsets)
        sequence = bins + (int(part["_group"].iloc[0]) << 32)
        return part.drop(columns=["_group", "_index"], errors="ignore").assign(sequence_id=sequence, offset=offsets)

    if order:
        places = [F.col(c) for c in (*order, "piece")]
        dealt = source_blocks(pieces.withColumn("_all", F.lit(0)), places, "_all").drop("_all", *order)
        dealt = dealt.withColumn("_group", F.expr(f"_index * {groups} div {max(1, number)}"))
    else:
        group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
        dealt = pieces.withColumn("_group", group)
    return dealt.groupBy("_group").applyInPandas(
        lambda part: pack(part), f"{fields}, sequence_id bigint, offset bigint"
    )


def pack_documents(
    docs: DataFrame, tokenizer: str | None = None, capacities: Capacities = Capacities(),
    end_id: int = 0, with_ids: bool = False, in_stored_order: bool = False,
) -> DataFrame:
    """Pack whole documents; one row for each piece. An empty table gives no rows.

    ``in_stored_order`` asks for sequences in the order in which the rows of ``docs``, a table just
    read, are stored.
    """
    carry = PLACE if in_stored_order else ()
    read = docs.select("doc_id", "text")
    placed = with_place(read) if in_stored_order else read
    pieces = cut_pieces(placed, tokenizer or tokenizer_path(), capacities.tokens, end_id, with_ids, carry=carry)
    return pack_pieces(stage(pieces, "pieces"), capacities, carry)


def sequences(packed: DataFrame) -> DataFrame:
    """``sequence_id, doc_ids, ids`` of pieces packed with their ids; a sequence's pieces are few."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    joined = packed.groupBy("sequence_id").agg(parts.alias("parts"))
    return joined.select(
        "sequence_id",
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"),
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
    )
