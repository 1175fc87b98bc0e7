"""Toxicity by a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslens.llm.arrays import FOLD, LETTERS_ONLY, Words, buffer, slices
from corpuslens.storage import stage

#: Buckets that terms are hashed into, and those that the model keeps.
BUCKETS, KEPT_BUCKETS = 1 << 20, 8192
#: Standard errors between a bucket's shares among toxic and other texts, and documents, to keep it.
LEAST_GAP, LEAST_DOCUMENTS = 4.0, 3
#: Labelled rows that the model is fitted on, at most: those of the least hashes.
SAMPLE_ROWS = 16_384
#: Lengths in bytes of the word beginnings that are terms beside the words themselves.
BEGINNINGS = (4, 5)
FACTORS, EPOCHS, RATE, DECAY = 8, 30, 0.05, 1e-4
#: A document is predicted toxic from this score on.
THRESHOLD = 0.3


def term_buckets(data: np.ndarray, offsets: np.ndarray, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of each term: runs of letters in lower case, and their beginnings."""
    found = Words(data, offsets, first, last, LETTERS_ONLY, FOLD)
    docs, terms = [found.doc], [found.hashes]
    for length in BEGINNINGS:
        longer = found.sizes > length
        docs.append(found.doc[longer])
        terms.append(found.prefix_hashes(length)[longer] ^ np.uint64(length))
    bucket = (np.concatenate(terms) & np.uint64(BUCKETS - 1)).astype(np.int64)
    return np.concatenate(docs), bucket


@dataclass(frozen=True)
class Machine:
    """Bias, and weight and factors of each kept bucket; ``place`` finds a bucket's row, or -1."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def place(self) -> np.ndarray:
        table = np.full(BUCKETS, -1, np.int32)
        table[self.buckets] = np.arange(len(self.buckets))
        return table

    def scores(self, docs: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """Scores of ``n`` texts from distinct (text, row) pairs in text order."""
        return _sigmoid(_margins(self.bias, self.weights, self.factors, docs, rows, n)[0])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _margins(bias, weights, factors, docs, rows, n):
    """Linear terms plus half of (the factors' sum squared less their squares' sum), and the sums."""
    sums, squares = np.zeros((n, factors.shape[1])), np.zeros(n)
    linear = np.bincount(docs, weights[rows], n)
    v = factors[rows]
    for f in range(factors.shape[1]):
        sums[:, f] = np.bincount(docs, v[:, f], n)
    squares = np.bincount(docs, (v * v).sum(axis=1), n)
    return bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums


def fit(docs: np.ndarray, rows: np.ndarray, labels: np.ndarray, width: int, seed: int = 0) -> tuple:
    """Bias, weights and factors by logistic loss, adaptive steps over small batches; repeatable."""
    rng = np.random.default_rng(seed)
    n = len(labels)
    share = min(max(labels.mean() if n else 0.5, 1e-3), 1 - 1e-3)
    bias = float(np.log(share / (1 - share)))
    weights, factors = np.zeros(width), rng.normal(0, 0.01, (width, FACTORS))
    gw, gv, gb = np.full(width, 1e-8), np.full((width, FACTORS), 1e-8), 1e-8
    ends = np.searchsorted(docs, np.arange(n + 1))
    for _ in range(EPOCHS if n else 0):
        order = rng.permutation(n)
        for batch in np.array_split(order, max(1, n // 256)):
            spans = [np.arange(ends[i], ends[i + 1]) for i in batch]
            sizes = np.array([len(s) for s in spans])
            at = np.concatenate(spans).astype(np.int64)
            r, d = rows[at], np.repeat(np.arange(len(batch)), sizes)
            margin, sums = _margins(bias, weights, factors, d, r, len(batch))
            error = (_sigmoid(margin) - labels[batch]) / len(batch)
            step_w = np.bincount(r, error[d], width) + DECAY * weights
            used = np.unique(r)
            step_v = np.zeros((width, FACTORS))
            np.add.at(step_v, r, error[d][:, None] * (sums[d] - factors[r]))
            step_v[used] += DECAY * factors[used]
            gb, gw, gv = gb + error.sum() ** 2, gw + step_w**2, gv + step_v**2
            bias -= RATE * error.sum() / np.sqrt(gb)
            weights -= RATE * step_w / np.sqrt(gw)
            factors -= RATE * step_v / np.sqrt(gv)
    return bias, weights, factors


def is_held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Machine:
    """Fit a machine on ``labels(doc_id, toxic)`` of at most ``rows`` documents outside the held-out set.

    The sample is that of the least hashes of the ids, so it is repeatable, and bounded whatever the
    corpus; its ids are broadcast and the documents are read in place. Buckets are chosen by how far
    their shares among toxic and other texts lie apart in standard errors. Null labels and labels
    without a document are left out; of several labels of an id the greatest counts. Without any
    label all scores are even.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    chosen = (
        usable.groupBy("doc_id").agg(F.max("toxic").alias("_label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffer(batch.column("text"))
            for first, last in slices(offsets):
                doc, bucket = term_buckets(data, offsets, first, last)
                pairs = np.unique(doc * BUCKETS + bucket)
                ends = np.searchsorted(pairs, np.arange(last - first + 1) * BUCKETS).astype(np.int32)
                found = pa.array((pairs % BUCKETS).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), batch.column("_label").slice(first, last - first).cast(pa.int32()), pa.ListArray.from_arrays(pa.array(ends), found)],
                    names=["doc_id", "label", "buckets"],
                )

    sampled = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    terms = stage(sampled.mapInArrow(extract, "doc_id bigint, label int, buckets array<int>"), "toxicity-terms")
    sizes = {r["label"]: r["n"] for r in terms.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return Machine(0.0 if not bad + good else (4.0 if bad else -4.0), np.empty(0, np.int64), np.empty(0), np.empty((0, FACTORS)))
    among_bad, among_good = F.col("_bad") / bad, F.col("_good") / good
    share = (F.col("_bad") + F.col("_good") + 1) / (bad + good + 2)
    gap = F.abs(among_bad - among_good) / F.sqrt(share * (1 - share) * (1 / bad + 1 / good))
    kept = (
        terms.select("label", F.explode("buckets").alias("bucket"))
        .groupBy("bucket")
        .agg(F.sum("label").alias("_bad"), F.sum(1 - F.col("label")).alias("_good"))
        .filter(F.col("_bad") + F.col("_good") >= LEAST_DOCUMENTS)
        .select("bucket", gap.alias("gap"))
        .filter(F.col("gap") >= LEAST_GAP)
        .orderBy(F.desc("gap"), "bucket")
        .limit(KEPT_BUCKETS)
    )
    buckets = np.sort(np.array([r["bucket"] for r in kept.collect()], np.int64))
    narrowed = terms.select("doc_id", "label", F.array_intersect("buckets", F.from_json(F.lit(str(buckets.tolist())), "array<int>")).alias("buckets"))
    found = sorted(narrowed.toArrow().to_pylist(), key=lambda r: (r["doc_id"], r["buckets"]))
    table = np.full(BUCKETS, -1, np.int64)
    table[buckets] = np.arange(len(buckets))
    sizes_of = [len(r["buckets"]) for r in found]
    rows_of = table[np.concatenate([np.sort(r["buckets"]) for r in found]).astype(np.int64)] if found else np.empty(0, np.int64)
    doc_of = np.repeat(np.arange(len(found)), sizes_of)
    label_of = np.array([r["label"] for r in found], float)
    bias, weights, factors = fit(doc_of, rows_of, label_of, len(buckets))
    return Machine(bias, buckets, weights, factors)


def score_toxicity(docs: DataFrame, machine: Machine, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on).

    Only the text is scored. Null and empty texts get the bias's score. One row out for each row in,
    repeated rows alike; input columns of these names are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted")]
    given = docs.select(*kept)
    # The machine is a few MB whatever the corpus: KEPT_BUCKETS rows.
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in given.schema.fields)
    at = kept.index(text)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = machine.place()
        for batch in batches:
            data, offsets = buffer(batch.column(at))
            scores = []
            for first, last in slices(offsets):
                doc, bucket = term_buckets(data, offsets, first, last)
                row = place[bucket]
                hit = row >= 0
                pairs = np.unique(doc[hit] * KEPT_BUCKETS + row[hit])
                scores.append(machine.scores(pairs // KEPT_BUCKETS, pairs % KEPT_BUCKETS, last - first))
            joined = np.concatenate(scores) if scores else np.empty(0)
            arrays = [*batch.columns, pa.array(joined), pa.array((joined >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "score", "predicted"])

    return given.mapInArrow(score, f"{schema}, score double, predicted int")
