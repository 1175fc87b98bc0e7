"""Similarity join of documents by Jaccard over word n-grams: MinHash bands, then full sets."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.arrays import Words, buffer, mix, slices, windows
from corpuslens.llm.components import components
from corpuslens.llm.expressions import free_name
from corpuslens.storage import stage

WORDS, SIMILARITY, RECALL, HASHES = 5, 0.8, 0.9999, 128
#: Texts, and their n-grams, that meet in one side of a task.
CELL_TEXTS, CELL_NGRAMS = 384, 400_000

_GRAM_BITS = np.uint64(52)
_GRAM = np.uint64((1 << 52) - 1)
_SALT = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """Fewest bands of the most rows within ``hashes`` that find a pair of ``similarity`` with ``recall``."""
    for rows in range(hashes, 0, -1):
        missed = 1 - similarity**rows
        for bands in range(1, hashes // rows + 1):
            if 1 - missed**bands >= recall:
                return bands, rows
    raise ValueError("no banding reaches this recall; allow more hashes")


def ngrams(data: np.ndarray, offsets: np.ndarray, first: int, last: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and 52-bit hash of each distinct n-gram, sorted by both.

    A text of fewer than ``width`` words has them all as its one n-gram.
    """
    found = Words(data, offsets, first, last)
    at, grams = windows(found.hashes, found.doc, width)
    docs, hashes = [found.doc[at]], [grams]
    heads = np.cumsum(found.counts) - found.counts
    for n in range(1, width):
        short = np.flatnonzero(found.counts == n)
        total = np.full(len(short), np.uint64(n)) * _SALT
        for k in range(n):
            total = mix(total + found.hashes[heads[short] + k])
        docs.append(short)
        hashes.append(total)
    doc, gram = np.concatenate(docs), np.concatenate(hashes)
    keys = np.sort((doc.astype(np.uint64) << _GRAM_BITS) | (gram >> np.uint64(12)))
    keys = keys[np.flatnonzero(np.diff(keys, prepend=~keys[:1]))]
    return (keys >> _GRAM_BITS).astype(np.int64), keys & _GRAM


def _small_slices(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Slices of under 4096 texts, as a text's number must fit beside its n-gram."""
    for first, last in slices(offsets):
        for at in range(first, last, 4000):
            yield at, min(at + 4000, last)


def _set_hashes(doc: np.ndarray, gram: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return mix(np.add.reduceat(mix(gram ^ _SALT), starts))


@dataclass(frozen=True)
class Banding:
    width: int
    bands: int
    rows: int

    def multipliers(self) -> tuple[np.ndarray, np.ndarray]:
        n = self.bands * self.rows
        drawn = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * _SALT)
        return (drawn[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (drawn[n:] >> np.uint64(32)).astype(np.uint32)

    def sign(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``doc_id, n_ngrams, text_key, bands`` of each text; a text without words has no key or band."""
        scale, shift = self.multipliers()
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            for first, last in _small_slices(offsets):
                doc, gram = ngrams(data, offsets, first, last, self.width)
                starts = np.flatnonzero(np.diff(doc, prepend=-1))
                present = doc[starts]
                small = (mix(gram) >> np.uint64(32)).astype(np.uint32)
                banded = np.zeros((len(starts), self.bands), np.uint64)
                for band in range(self.bands if len(starts) else 0):
                    key = np.full(len(starts), np.uint64(band + 1)) * _SALT
                    for h in range(band * self.rows, (band + 1) * self.rows):
                        least = np.minimum.reduceat(small * scale[h] + shift[h], starts)
                        key = mix(key ^ least.astype(np.uint64))
                    banded[:, band] = key
                n = last - first
                counts = np.zeros(n, np.int32)
                counts[present] = np.diff(np.append(starts, len(doc)))
                keys, missing = np.zeros(n, np.int64), np.ones(n, bool)
                if len(starts):
                    keys[present] = _set_hashes(doc, gram, starts).view(np.int64)
                missing[present] = False
                ends = np.zeros(n + 1, np.int32)
                ends[1:] = np.cumsum(~missing) * self.bands
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, n),
                        pa.array(counts),
                        pa.array(keys, mask=missing),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(banded.ravel().view(np.int64))),
                    ],
                    names=["doc_id", "n_ngrams", "text_key", "bands"],
                )

    def sets(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``text_key, grams`` of the texts whose key is the one looked for; null looks for any."""
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            asked = batch.column("text_key")
            wanted, any_key = pc.fill_null(asked, 0).to_numpy(), np.asarray(asked.is_null())
            for first, last in _small_slices(offsets):
                doc, gram = ngrams(data, offsets, first, last, self.width)
                if not len(doc):
                    continue
                starts = np.flatnonzero(np.diff(doc, prepend=-1))
                keys = _set_hashes(doc, gram, starts).view(np.int64)
                at = first + doc[starts]
                right = np.flatnonzero((keys == wanted[at]) | any_key[at])
                each = np.split(gram, starts[1:])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[right]), pa.array([each[i].tobytes() for i in right], pa.binary())],
                    names=["text_key", "grams"],
                )


def _shared(sets: list[np.ndarray], split: int) -> np.ndarray:
    """Sizes of the intersections of each of the first ``split`` sets with each of the others.

    N-grams that occur once are left out; the rest become columns of two 0/1 matrices, taken a few
    thousand at a time, whose product counts the shared ones.
    """
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    owner, values = owner[order], values[order]
    opens = np.diff(values, prepend=~values[:1]) != 0
    column = np.cumsum(opens) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], column[common]
    column = np.cumsum(np.diff(column, prepend=-1) != 0) - 1
    out = np.zeros((split, len(sets) - split), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    step = 2048
    for at in range(0, total, step):
        lo, hi = np.searchsorted(column, (at, at + step))
        block = np.zeros((len(sets), min(step, total - at)), np.float32)
        block[owner[lo:hi], column[lo:hi] - at] = 1
        out += block[:split] @ block[split:].T
    return out


def _linked(group: pa.Table, similarity: float) -> pa.Table:
    """Links within a pair of cells: for each text that has some, their number, the documents at
    their other ends, and the least text that it is linked with through texts of these cells."""
    first_cell = group.column("first")[0].as_py()
    same = first_cell == group.column("second")[0].as_py()
    keys = group.column("text_key").to_numpy()
    copies = group.column("copies").to_numpy()
    sets = [np.frombuffer(x, np.uint64) for x in group.column("grams").to_pylist()]
    in_first = group.column("cell").to_numpy() == first_cell
    order = np.argsort(~in_first, kind="stable")
    keys, copies, sets = keys[order], copies[order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    split = int(in_first.sum())
    if same:
        left, right = np.arange(split), np.arange(split)
        shared = _shared(sets + sets, split)
    else:
        left, right = np.arange(split), np.arange(split, len(sets))
        shared = _shared(sets, split) if len(right) else np.zeros((split, 0))
    union = sizes[left][:, None] + sizes[right][None, :] - shared
    link = shared >= similarity * union - 1e-6
    if same:
        np.fill_diagonal(link, False)
    n_links = np.zeros(len(sets), np.int64)
    n_docs = np.zeros(len(sets), np.int64)
    np.add.at(n_links, left, link.sum(axis=1))
    np.add.at(n_docs, left, link @ copies[right])
    if not same:
        np.add.at(n_links, right, link.sum(axis=0))
        np.add.at(n_docs, right, copies[left] @ link)
    a, b = np.nonzero(link)
    root = keys.copy()
    a, b = left[a], right[b]
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        if (root == before).all():
            break
    has = np.flatnonzero(n_links)
    return pa.table({"text_key": keys[has], "n_links": n_links[has], "n_docs": n_docs[has], "hook": root[has]})


def near_duplicates(
    docs: DataFrame, width: int = WORDS, similarity: float = SIMILARITY, recall: float = RECALL,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id, class_id, text_id, n_copies, n_links``.

    Words are runs of characters but ASCII white space, unchanged; a text of fewer than ``width``
    words has them all as its one n-gram, and a text without words (null, empty) has no links.
    Documents of equal n-gram sets are copies: ``text_id`` is their least id, ``n_copies`` their
    number. Documents whose sets have a Jaccard of ``similarity`` or more are linked, copies
    included; ``n_links`` counts the others linked to a document, and ``class_id`` is the least id
    of all documents reached by links. A null id is no one's ``class_id``; a class of null ids only
    has a null one. Repeated rows are copies of each other; other columns are not read.

    Copies are taken as one text first. Band and row counts are chosen for ``recall`` at
    ``similarity``; texts of one band hash share a bucket. A text's home is the fullest bucket of any
    text that it shares a bucket with, which gathers a group of near copies in one home; homes are
    cut into cells of bounded size, and every two cells that some bucket joins are compared as a
    whole on full n-gram sets, once. So no pair of texts is ever a row, whatever the size of a group:
    a task returns counts, and a forest of the links for the components.
    """
    banding = Banding(width, *bands_for(similarity, recall))
    given = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    signed = stage(
        given.mapInArrow(banding.sign, "doc_id bigint, n_ngrams int, text_key bigint, bands array<bigint>"),
        "ngram-signed",
    )
    texts = stage(
        signed.filter("text_key IS NOT NULL").groupBy("text_key").agg(
            F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("copies"),
            F.max("n_ngrams").alias("n_ngrams"), F.first("bands").alias("bands"),
        ),
        "ngram-texts",
    )
    entries = texts.select("text_key", "n_ngrams", F.explode("bands").alias("bucket"))
    buckets = stage(
        entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum("n_ngrams").alias("grams")).filter("n > 1"),
        "ngram-buckets",
    )
    members = stage(entries.join(buckets, "bucket").select("text_key", "bucket", "n", "grams"), "ngram-members")
    fullest = F.max(F.struct("n", "grams", "bucket")).alias("h")
    tops = members.groupBy("text_key").agg(fullest)
    near = stage(members.join(tops, "text_key").groupBy("bucket").agg(F.max("h").alias("h")), "ngram-near")
    homes = stage(
        members.select("text_key", "bucket").join(near, "bucket").groupBy("text_key").agg(F.max("h").alias("h"))
        .select("text_key", F.col("h.bucket").alias("home")).join(texts.select("text_key", "n_ngrams"), "text_key"),
        "ngram-homes",
    )
    cells_of = F.greatest(F.ceil(F.count(F.lit(1)) / CELL_TEXTS), F.ceil(F.sum("n_ngrams") / CELL_NGRAMS))
    cells = stage(homes.groupBy("home").agg(cells_of.alias("cells")), "ngram-home-cells")
    cell = F.xxhash64("home", F.pmod(F.xxhash64("text_key", F.lit(1)), F.col("cells")))
    placed = stage(homes.join(cells, "home").select("text_key", cell.alias("cell")), "ngram-cells")
    in_bucket = stage(members.join(placed, "text_key").select("bucket", "cell").distinct(), "ngram-bucket-cells")
    other = in_bucket.select("bucket", F.col("cell").alias("second"))
    pairs = stage(
        in_bucket.withColumnRenamed("cell", "first").join(other, "bucket").filter("first <= second")
        .select("first", "second").distinct(),
        "ngram-cell-pairs",
    )
    wanted = texts.join(placed, "text_key").select("text_key", "cell", "copies", F.col("text_id").alias("doc_id"))
    # What texts are joined to grows with them, so it is never broadcast, at any size.
    by_id = given.join(wanted.select("text_key", "doc_id").hint("merge"), "doc_id").select("text_key", "text")
    without = given.filter("doc_id IS NULL").select(F.lit(None).cast("bigint").alias("text_key"), "text")
    found = (
        by_id.union(without)
        .mapInArrow(banding.sets, "text_key bigint, grams binary")
        .groupBy("text_key").agg(F.first("grams").alias("grams"))
    )
    sets = stage(found.join(wanted.drop("doc_id"), "text_key"), "ngram-sets")
    sides = pairs.withColumn("cell", F.explode(F.array_distinct(F.array("first", "second"))))
    linked = stage(
        sides.join(sets, "cell").groupBy("first", "second").applyInArrow(
            lambda group: _linked(group, similarity), "text_key bigint, n_links bigint, n_docs bigint, hook bigint"
        ),
        "ngram-links",
    )
    roots = components(linked.select(F.col("text_key").alias("a"), F.col("hook").alias("b")))
    reached = texts.select("text_key", "text_id", "copies").join(
        roots.withColumnRenamed("node", "text_key"), "text_key", "left"
    ).withColumn("root", F.coalesce("root", "text_key"))
    reached = stage(reached, "ngram-reached")
    least = stage(reached.groupBy("root").agg(F.min("text_id").alias("class_id")), "ngram-classes")
    counts = linked.groupBy("text_key").agg(F.sum("n_docs").alias("n_docs"))
    known = stage(
        reached.join(least, "root").join(counts, "text_key", "left")
        .select("text_key", "class_id", "text_id", "copies", F.coalesce("n_docs", F.lit(0)).alias("n_docs")),
        "ngram-known",
    )
    lone = F.col("text_key").isNull()
    return signed.select("doc_id", "text_key").join(known, "text_key", "left").select(
        "doc_id",
        F.when(lone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(lone, F.col("doc_id")).otherwise(F.col("text_id")).alias("text_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        F.when(lone, F.lit(0)).otherwise(F.col("copies") - 1 + F.col("n_docs")).cast("bigint").alias("n_links"),
    )


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents whose class has one of a lesser id.

    Rows without an id can't be named by a class and stay. Of rows of equal id and text one stays.
    """
    judged = near_duplicates(docs, doc_id=doc_id, text=text, **options)
    # A document of equal rows counts them all; rows of one id and different texts have classes apart.
    own, n = free_name(docs, "_kept"), free_name(docs, "_rows")
    kept = judged.filter("doc_id = class_id").groupBy(F.col("doc_id").alias(own)).agg(F.count(F.lit(1)).alias(n))
    kept = stage(kept, "ngram-kept")
    joined = docs.join(kept.hint("merge"), F.col(doc_id) == F.col(own), "left").filter(
        F.col(doc_id).isNull() | F.col(own).isNotNull()
    )
    once = joined.filter(F.coalesce(n, F.lit(1)) == 1).select(*docs.columns)
    if kept.filter(F.col(n) > 1).isEmpty():
        return once
    return once.unionByName(joined.filter(F.col(n) > 1).select(*docs.columns).dropDuplicates([doc_id, text]))
