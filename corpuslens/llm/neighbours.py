"""Nearest vectors by inner product: cross-polytope hashing, multiprobe tables, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.storage import stage

#: Tables of the index, vectors to a bucket of a table, and what a query's probes must find.
TABLES, BUCKET_VECTORS, RECALL = 2, 512, 0.95
#: Queries of the sample that settles the number of probes; buckets ranked for each of them at most.
SAMPLE, MOST_PROBES = 128, 4096
#: Numbers of the vectors that one cell holds; a larger range of buckets is dealt to several cells.
CELL_VALUES = 1 << 22
#: Products held at a time; found beyond the wanted, so that rounding in products can't lose one.
_PRODUCTS, _SPARE = 1 << 21, 4
#: Norms that differ by less than this share count as equal when vectors are hashed.
_EVEN = 1e-3


@dataclass(frozen=True)
class Hashing:
    """Cross-polytope functions of all tables: ``axes`` signed axes in each, of rotations of their own."""

    axes: tuple[int, ...]
    largest: float
    lift: bool
    seed: int = 11

    @property
    def buckets(self) -> int:
        return math.prod(self.axes)


def hashing_for(vectors: int, size: int, least: float, largest: float, bucket: int = BUCKET_VECTORS) -> Hashing:
    """So many functions that a bucket has about ``bucket`` vectors; one bucket where they are few.

    With uneven norms vectors get one more number, which makes them equally long: then the nearest
    by inner product are the nearest by angle, which is what the functions tell apart.
    """
    lift = largest - least > _EVEN * largest
    whole = 2 << (max(1, size + lift) - 1).bit_length()
    wanted, axes = vectors / bucket, []
    while wanted >= 2:
        axes.append(min(whole, 1 << int(math.log2(wanted))))
        wanted /= axes[-1]
    return Hashing(tuple(axes), largest, lift)


@lru_cache(maxsize=64)
def _signs(seed: int, table: int, function: int, width: int) -> np.ndarray:
    rng = np.random.default_rng([seed, table, function, width])
    return rng.choice([-1.0, 1.0], (3, width))


def rotated(vectors: np.ndarray, seed: int, table: int, function: int) -> np.ndarray:
    """The rows under a pseudo-rotation: three times random signs, then the fast Hadamard transform."""
    rows, width = vectors.shape
    padded = np.zeros((rows, 1 << (width - 1).bit_length()))
    padded[:, :width] = vectors
    width = padded.shape[1]
    for signs in _signs(seed, table, function, width):
        padded = padded * signs
        half = 1
        while half < width:
            pairs = padded.reshape(rows, -1, 2, half)
            padded = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(rows, width)
            half *= 2
        padded = padded / math.sqrt(width)
    return padded


def _unit(vectors: np.ndarray, hashing: Hashing, index: bool) -> np.ndarray:
    """Directions that are hashed: of indexed vectors with the number that lifts them to one length."""
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    if not hashing.lift:
        return vectors / norms[:, None]
    if index:
        rest = np.sqrt(np.maximum(0.0, 1 - (norms / hashing.largest) ** 2))
        return np.column_stack([vectors / hashing.largest, rest])
    return np.column_stack([vectors / norms[:, None], np.zeros(len(vectors))])


def buckets_of(vectors: np.ndarray, hashing: Hashing, table: int) -> np.ndarray:
    """The bucket of each indexed vector: the nearest signed axis under each function."""
    code = np.zeros(len(vectors), np.int64)
    unit = _unit(vectors, hashing, True)
    for f, axes in enumerate(hashing.axes):
        seen = rotated(unit, hashing.seed, table, f)[:, : axes // 2]
        axis = np.abs(seen).argmax(axis=1)
        code = code * axes + 2 * axis + (seen[np.arange(len(seen)), axis] < 0)
    return code


def probes_of(vectors: np.ndarray, hashing: Hashing, table: int, probes: int) -> np.ndarray:
    """For each query the ``probes`` buckets most likely to hold near vectors, likeliest first.

    A bucket costs the squared distances of its axes' coordinates from the largest, summed over the functions.
    """
    unit = _unit(vectors, hashing, False)
    code = np.zeros((len(unit), 1), np.int64)
    cost = np.zeros((len(unit), 1))
    for f, axes in enumerate(hashing.axes):
        seen = rotated(unit, hashing.seed, table, f)[:, : axes // 2]
        values = np.stack([seen, -seen], axis=2).reshape(len(seen), axes)
        gap = (values.max(axis=1, keepdims=True) - values) ** 2
        cost = (cost[:, :, None] + gap[:, None, :]).reshape(len(seen), -1)
        code = (code[:, :, None] * axes + np.arange(axes)).reshape(len(seen), -1)
        if cost.shape[1] > probes:
            near = np.argpartition(cost, probes - 1, axis=1)[:, :probes]
            cost, code = np.take_along_axis(cost, near, 1), np.take_along_axis(code, near, 1)
    order = np.argsort(cost, axis=1, kind="stable")
    return np.take_along_axis(code, order, 1)


def _in_parts(rows: int, width: int) -> Iterator[slice]:
    step = max(1, _PRODUCTS // max(1, width))
    for at in range(0, rows, step):
        yield slice(at, at + step)


def _by_size(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Size, rows and vectors of each size in a batch with a column ``vector``."""
    column = batch.column("vector")
    if not len(column):
        return
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    begins = np.cumsum(sizes) - sizes
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        yield size, rows, flat[begins[rows][:, None] + np.arange(size)]


def valid_vectors(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``id, vector`` of the vectors that take part, as doubles."""
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("id"), F.col(embedding).cast("array<double>").alias("vector"))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0))


def _sampled_recall(reps: DataFrame, sample: list, hashing: Hashing, k: int, recall: float, tables: int) -> int | None:
    """The least number of probes that find ``recall`` of the sample's true nearest, or None.

    The sample's few queries are held against all vectors.
    """
    queries: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {len(r["vector"]) for r in sample}:
        some = [r for r in sample if len(r["vector"]) == size]
        queries[size] = (np.array([r["id"] for r in some]), np.array([r["vector"] for r in some], np.float64))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[float, int, list[int]]]] = {}
        for batch in batches:
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            for size, rows, found in _by_size(batch):
                if size not in queries:
                    continue
                names, asked = queries[size]
                products = asked @ found.T
                products[names[:, None] == ids[rows][None, :]] = -np.inf
                top = np.argsort(-products, axis=1, kind="stable")[:, :k]
                chosen = np.unique(top)
                codes = np.stack([buckets_of(found[chosen], hashing, t) for t in range(tables)], axis=1)
                at = {int(c): codes[i].tolist() for i, c in enumerate(chosen)}
                for q in range(len(names)):
                    fresh = [(float(products[q, j]), int(ids[rows[j]]), at[int(j)]) for j in top[q] if products[q, j] > -np.inf]
                    best[int(names[q])] = sorted(best.get(int(names[q]), []) + fresh, key=lambda x: (-x[0], x[1]))[:k]
        flat = [(q, *x) for q, found in best.items() for x in found]
        columns = list(zip(*flat)) or [()] * 4
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["query", "score", "id", "codes"])

    found = reps.select("id", "vector").mapInArrow(nearest, "query bigint, score double, id bigint, codes array<bigint>")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    true = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k).collect()
    most = min(MOST_PROBES, hashing.buckets)
    rank: dict[tuple[int, int], dict[int, int]] = {}
    for names, asked in queries.values():
        for t in range(tables):
            for q, codes in zip(names.tolist(), probes_of(asked, hashing, t, most)):
                rank[q, t] = {int(c): i for i, c in enumerate(codes)}
    hits = np.sort([min(rank[r["query"], t].get(c, most) for t, c in enumerate(r["codes"])) for r in true])
    if not len(hits):
        return 1
    needed = int(hits[min(len(hits) - 1, math.ceil(recall * len(hits)) - 1)]) + 1
    return needed if needed <= most else None


_CELL = "tab int, size int, slab bigint, kind int, codes array<bigint>, id bigint, vector array<double>"


def _slab_buckets(size: int) -> int:
    return max(1, CELL_VALUES // (BUCKET_VECTORS * max(1, size)))


def _index_rows(reps: DataFrame, hashing: Hashing, tables: int) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id")
            for size, rows, found in _by_size(batch):
                take = pa.array(rows)
                for t in range(tables):
                    codes = buckets_of(found, hashing, t)
                    yield _cells(t, size, codes // _slab_buckets(size), 0, codes[:, None], ids.take(take), batch.column("vector").take(take))

    return reps.select("id", "vector").mapInArrow(place, _CELL)


def _cells(t: int, size: int, slabs: np.ndarray, kind: int, codes: np.ndarray, ids: pa.Array, vectors: pa.Array) -> pa.RecordBatch:
    n = len(slabs)
    offsets = np.arange(n + 1, dtype=np.int32) * codes.shape[1]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, t), pa.int32()), pa.array(np.full(n, size), pa.int32()), pa.array(slabs, pa.int64()),
            pa.array(np.full(n, kind), pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(codes.ravel(), pa.int64())),
            ids, vectors,
        ],
        names=["tab", "size", "slab", "kind", "codes", "id", "vector"],
    )


def _query_rows(queries: DataFrame, hashing: Hashing, tables: int, probes: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for size, rows, found in _by_size(batch):
                for part in _in_parts(len(rows), probes * max(hashing.axes, default=1)):
                    for t in range(tables):
                        codes = probes_of(found[part], hashing, t, probes)
                        slabs = codes // _slab_buckets(size)
                        # A query goes once to each slab, with those of its buckets that lie in it.
                        order = np.argsort(slabs, axis=1, kind="stable")
                        slabs, codes = np.take_along_axis(slabs, order, 1), np.take_along_axis(codes, order, 1)
                        opens = np.ones(slabs.shape, bool)
                        opens[:, 1:] = slabs[:, 1:] != slabs[:, :-1]
                        begins = np.flatnonzero(opens.ravel())
                        take = pa.array(rows[part][begins // slabs.shape[1]])
                        offsets = pa.array(np.append(begins, slabs.size).astype(np.int32))
                        n = len(begins)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(np.full(n, t), pa.int32()), pa.array(np.full(n, size), pa.int32()),
                                pa.array(slabs.ravel()[begins], pa.int64()), pa.array(np.full(n, 1), pa.int32()),
                                pa.ListArray.from_arrays(offsets, pa.array(codes.ravel(), pa.int64())),
                                batch.column("id").take(take), batch.column("vector").take(take),
                            ],
                            names=["tab", "size", "slab", "kind", "codes", "id", "vector"],
                        )

    return queries.select("id", "vector").mapInArrow(ask, _CELL)


class _Cell:
    """The vectors of a cell, by bucket; finds the best for queries that come in batches."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, vectors: np.ndarray):
        order = np.argsort(codes, kind="stable")
        self._ids, codes, self._vectors = ids[order], codes[order], vectors[order]
        names, begins = np.unique(codes, return_index=True)
        ends = np.append(begins[1:], len(codes)).tolist()
        self._runs = {int(c): (a, b) for c, a, b in zip(names, begins.tolist(), ends)}

    def best(self, asked: np.ndarray, codes: list[list[int]], wanted: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, ids and scores; a query without codes asks all buckets."""
        by_code: dict[int, list[int]] = {}
        for q, some in enumerate(codes):
            for c in some or self._runs:
                if c in self._runs:
                    by_code.setdefault(c, []).append(q)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for c, members in by_code.items():
            a, b = self._runs[c]
            keep = min(wanted, b - a)
            of = np.array(members)
            for part in _in_parts(len(of), b - a):
                products = asked[of[part]] @ self._vectors[a:b].T
                near = np.argpartition(-products, keep - 1, axis=1)[:, :keep]
                found.append((np.repeat(of[part], keep), a + near.ravel(), np.take_along_axis(products, near, 1).ravel()))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        query, row, score = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-score, query))
        query, row = query[order], row[order]
        first = np.searchsorted(query, query)
        kept = np.arange(len(query)) - first < wanted
        query, row = query[kept], row[kept]
        # A sum for each pair by itself, whatever it was multiplied with.
        exact = np.concatenate([np.empty(0), *(
            (asked[query[p]] * self._vectors[row[p]]).sum(axis=1) for p in _in_parts(len(query), asked.shape[1])
        )])
        return query, self._ids[row], exact


def _search(cells: DataFrame, wanted: int) -> DataFrame:
    """``query, id, score``: the best of each cell for each query that came to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, cell = None, [], None
        for batch in batches:
            place = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("tab", "size", "slab", "salt", "kind")], axis=1)
            edges = np.flatnonzero(np.any(place[1:] != place[:-1], axis=1)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(place)]):
                *key, kind = place[a].tolist()
                if key != at:
                    at, held, cell = key, [], None
                part = batch.slice(a, b - a)
                ids = part.column("id").to_numpy(zero_copy_only=False)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
                if kind == 0:
                    held.append((ids, part.column("codes").flatten().to_numpy(zero_copy_only=False), vectors))
                elif held:
                    cell = cell or _Cell(*(np.concatenate(x) for x in zip(*held)))
                    query, found, score = cell.best(vectors, part.column("codes").to_pylist(), wanted)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[query]), pa.array(found), pa.array(score)], names=["query", "id", "score"]
                    )

    return cells.mapInArrow(run, "query bigint, id bigint, score double")


def nearest_vectors(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    recall: float = RECALL,
    tables: int = TABLES,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest found of each query row, its own id left out.

    ``is_query`` chooses query rows by the id's column, named ``id``. Nearest is the largest inner
    product of doubles, ties go to the smaller id. Rows without an id, and vectors that are null, zero,
    empty, or hold null, NaN or infinite numbers, take no part; vectors of different sizes don't meet.
    Equal rows count once. Equal vectors are searched as one, with their k + 1 least ids, which is all
    that any result can show of them. Other columns are not read. An empty table gives no rows.

    A vector lies in one bucket of each table. A query asks the likeliest buckets of each, as many as
    find ``recall`` of the true nearest of a sample of SAMPLE queries, which are held against all
    vectors; if MOST_PROBES don't, buckets are made larger. A query that finds fewer than k asks all
    buckets. Buckets are gathered in cells of up to CELL_VALUES numbers; a range of buckets with more,
    as a crowd of near vectors makes it, is dealt to several cells, and its queries go to each.
    """
    spark = vectors.sparkSession
    valid = stage(valid_vectors(vectors, vec_id, embedding).distinct(), "vectors")
    first = Window.partitionBy("vector").orderBy("id")
    least_ids = valid.withColumn("r", F.row_number().over(first)).filter(F.col("r") <= k + 1)
    reps = stage(least_ids.groupBy("vector").agg(F.min("id").alias("id"), F.collect_list("id").alias("ids")), "distinct-vectors")
    asked = valid.filter(is_query).select(F.col("id").alias("query_id"), "vector")
    asked = stage(asked.join(reps.select("id", "vector"), "vector"), "queries")
    queries = stage(asked.groupBy("id").agg(F.first("vector").alias("vector")), "distinct-queries")
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x))
    n, size, least, largest = reps.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.min(norm), F.max(norm)).first()
    sample = queries.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    bucket = BUCKET_VECTORS
    while True:
        hashing = hashing_for(n, size or 1, least or 1.0, largest or 1.0, bucket)
        probes = _sampled_recall(reps, sample, hashing, k, recall, tables) if hashing.axes else 1
        if probes is not None:
            break
        bucket *= 8
    # One bucket holds all: one table of it is enough.
    tables = tables if hashing.axes else 1
    placed = _index_rows(reps, hashing, tables)
    keys = ["tab", "size", "slab"]
    slabs = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    slabs = stage(slabs.select(*keys, F.ceil(F.col("n") * F.col("size") / CELL_VALUES).cast("int").alias("salts")), "slabs")
    dealt = placed.join(slabs, keys).withColumn("salt", F.pmod(F.xxhash64("id"), "salts").cast("int")).drop("salts")

    def search(rows: DataFrame) -> DataFrame:
        to_all = rows.join(slabs, keys).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
        cells = dealt.unionByName(to_all)
        count = slabs.agg(F.sum("salts")).first()[0] or 1
        slots = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(count, 100_000))
        place = [*keys, "salt"]
        found = _search(cells.repartition(slots, *place).sortWithinPartitions(*place, "kind"), k + 1 + _SPARE)
        return stage(found.groupBy("query", "id").agg(F.max("score").alias("score")), "found")

    found = search(_query_rows(queries, hashing, tables, probes))
    few = found.groupBy("query").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > k)
    short = stage(queries.join(few, queries["id"] == few["query"], "left_anti"), "short-queries")
    if hashing.axes and not short.isEmpty():
        everywhere = short.select(
            F.lit(0).alias("tab"), F.size("vector").alias("size"), F.lit(1).alias("kind"), F.array().cast("array<bigint>").alias("codes"), "id", "vector"
        )
        found = found.join(short, found["query"] == short["id"], "left_anti").unionByName(
            search(everywhere.join(slabs.filter("tab = 0").select("size", "slab"), "size"))
        )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    top = found.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1).drop("r")
    each = top.join(reps.select("id", "ids"), "id").select("query", "score", F.explode("ids").alias("vec_id"))
    lists = each.groupBy("query").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("less"), "vec_id"))), 1, k + 1).alias("best")
    )
    own = asked.select("query_id", F.col("id").alias("query")).join(lists, "query")
    others = F.slice(F.filter("best", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return own.select("query_id", F.posexplode(others).alias("at", "b")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.less")).alias("score")
    )
