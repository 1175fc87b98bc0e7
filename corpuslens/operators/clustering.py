"""Agglomerative clustering of article selections, many selections (blocks) at once.

Every block is a selection of articles clustered on its own, and the work grows with the number of
blocks. One shuffle brings the pairs of a block together, and a small dense kernel makes its tree
under every linkage method. A block of more than TASK_ROWS articles is first made smaller by joins:
round by round all reciprocal nearest neighbours merge at once, and the kernel takes over where few
enough clusters are left, so no task holds more than a matrix of that size. Ties go to the smaller
cluster ids. Cluster ids are their smallest member.

A tree is a table of its merges, n - 1 for n articles. What asks for ancestors (flat clusters, the
order of leaves) follows parent links by doubling; nothing is quadratic but the pairs asked for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.termcounts import coded_terms
from corpuslens.functions.text import truncate_label, word_tokens
from corpuslens.operators.preprocess import preprocess
from corpuslens.operators.selection import CLUSTER_MAX_ROWS
from corpuslens.operators.tfidf import CLUSTERING, TfidfOptions, tfidf
from corpuslens.storage import stage

# Executors receive the kernel by value, so the package need not be installed on them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

METHODS = ("ward", "complete", "average")
#: Clusters of a block whose distances one task holds.
TASK_ROWS = 512
CUT_SHARE = 0.70
_LABEL = 45
# Distances are compared at this precision, so that the order of a sum cannot break a tie.
_DIGITS = 12
# Heights are equal for numbering, and variances zero, at this precision.
_HEIGHT_DIGITS = 9
_KEY = ["block", "method"]


def labels(articles: DataFrame, title: str = "title") -> DataFrame:
    """Add the display label of each article."""
    return articles.withColumn("label", truncate_label(F.col(title), _LABEL))


def check_block_sizes(docs: DataFrame, limit: int | None = CLUSTER_MAX_ROWS) -> DataFrame:
    """Fail with a clear error when a block has more rows than the caller wants pairs of; None wants all."""
    if limit is None:
        return docs
    largest = docs.groupBy("block").count().orderBy(F.desc("count"), "block").first()
    if largest is not None and largest["count"] > limit:
        raise ValueError(
            f"block {largest['block']!r} has {largest['count']} rows; select at most {limit}"
        )
    return docs


def cosine_distance_edges(
    docs: DataFrame,
    lemmas: DataFrame | None = None,
    options: TfidfOptions = CLUSTERING,
    limit: int | None = CLUSTER_MAX_ROWS,
) -> DataFrame:
    """Cosine distances of all articles of a block: ``(block, i, j, d)`` with ``i < j``.

    ``docs`` is ``(block, doc_id, text)``; an article may stand in several blocks. A block of up to
    TASK_ROWS articles is one group: its words come together once, and terms, weights and distances
    are made there. In larger blocks only articles sharing a term meet, in a join by term; the others
    are completed with distance 1. Blocks are size-checked first.
    """
    docs = stage(docs.select("block", "doc_id", "text"), "selection")
    check_block_sizes(docs, limit)
    # Rows without a block have no pairs; left out here, they don't part two readings of the same tokens later.
    cleaned = preprocess(docs.filter(F.col("block").isNotNull()), ["block", "doc_id"], lemmas=lemmas)
    ids = docs.select("block", "doc_id")
    sizes = ids.groupBy("block").agg(F.count(F.lit(1)).alias("n"))
    large = stage(sizes.filter(F.col("n") > TASK_ROWS).select("block"), "large-blocks")
    words = cleaned.select("block", "doc_id", F.array_join(word_tokens(F.col("text"), options.stopwords), " ").alias("words"))
    schema = ", ".join(f"{n} {docs.schema[c].dataType.simpleString()}" for n, c in (("block", "block"), ("i", "doc_id"), ("j", "doc_id")))
    if large.isEmpty():
        return _edges_by_block(ids, words, options, f"{schema}, d double")
    near = _edges_by_block(
        ids.join(large, "block", "left_anti"), words.join(large, "block", "left_anti"), options, f"{schema}, d double"
    )
    cleaned = stage(cleaned.join(large, "block", "left_semi"), "cleaned")
    return near.unionByName(_edges_by_term(ids.join(large, "block", "left_semi"), cleaned, options))


def _edges_by_block(ids: DataFrame, words: DataFrame, options: TfidfOptions, schema: str) -> DataFrame:
    def edges(group: pa.Table) -> pa.Table:
        given = group.column("given")
        return _block_edges(group.filter(given), group.filter(pc.invert(given)), options)

    rows = ids.select("block", "doc_id", F.lit(None).cast("string").alias("words"), F.lit(True).alias("given"))
    rows = rows.unionByName(words.withColumn("given", F.lit(False))).filter(F.col("block").isNotNull())
    return rows.groupBy("block").applyInArrow(edges, schema)


def _features(terms: pa.Array, df: np.ndarray, cf: np.ndarray, n_docs: int, options: TfidfOptions) -> np.ndarray:
    """Places of the terms that the options keep, -1 for others; of equally frequent terms the first by name are kept."""
    kept = np.flatnonzero((df >= options.min_df) & (df <= n_docs * options.max_df))
    if options.max_features is not None and len(kept) > options.max_features:
        least = np.partition(cf[kept], -options.max_features)[-options.max_features]
        more, equal = kept[cf[kept] > least], kept[cf[kept] == least]
        order = pc.sort_indices(terms.take(pa.array(equal))).to_numpy()
        kept = np.concatenate([more, equal[order[: options.max_features - len(more)]]])
    place = np.full(len(terms), -1, np.int64)
    place[kept] = np.arange(len(kept))
    return place


def _block_edges(given: pa.Table, texts: pa.Table, options: TfidfOptions) -> pa.Table:
    """Distances of a block's articles from their words, weighed as :func:`tfidf` does by block.

    Rows of one id make one article, and a pair comes once for each two rows of ``given``.
    """
    words = texts.column("words").combine_chunks()
    n_docs = len(words) - words.null_count
    lists = pc.split_pattern(pc.if_else(pc.equal(words, ""), pa.scalar(None, words.type), words), " ")
    row, code, n, names = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)], [pa.array([], pa.large_string())]
    for at, gram, times, own in coded_terms(lists, *options.ngrams):
        row.append(at)
        code.append(gram + sum(map(len, names)))
        n.append(times)
        names.append(own)
    coded = pa.concat_arrays(names).dictionary_encode()
    row, n = np.concatenate(row), np.concatenate(n)
    code = coded.indices.to_numpy(zero_copy_only=False)[np.concatenate(code)]
    df, cf = (np.bincount(code, x, len(coded.dictionary)) for x in (None, n))
    place = _features(coded.dictionary, df, cf, n_docs, options)
    idf = np.log((n_docs + 1) / (df + 1)) + 1
    block, kind = given.column("block")[0:1], given.schema.field("doc_id").type
    ids, times = np.unique([x for x in given.column("doc_id").to_pylist() if x is not None], return_counts=True)
    known = {x: k for k, x in enumerate(ids.tolist())}
    article = np.array([-1 if x is None else known[x] for x in texts.column("doc_id").to_pylist()], np.int64)
    kept = (place[code] >= 0) & (article[row] >= 0)
    at, code, n = article[row[kept]], code[kept], n[kept]
    w = ((np.log(n) + 1) if options.sublinear_tf else n) * idf[code]
    width = int(place.max(initial=-1)) + 1
    weights = np.bincount(at * width + place[code], w, len(ids) * width).astype(float).reshape(len(ids), width)
    square = np.bincount(at, w * w, len(ids))
    weights /= np.sqrt(np.where(square > 0, square, 1.0))[:, None]
    a, b = np.triu_indices(len(ids), 1)
    d = np.round(np.maximum(0.0, 1 - (weights @ weights.T)[a, b]), _DIGITS)
    each = times[a] * times[b]
    a, b, d = (np.repeat(x, each) for x in (a, b, d))
    named = pa.array(ids.tolist(), kind)
    same = block.take(pa.array(np.zeros(len(a), np.int64))) if len(a) else block[:0]
    return pa.table({"block": same, "i": named.take(pa.array(a)), "j": named.take(pa.array(b)), "d": pa.array(d)})


def _edges_by_term(ids: DataFrame, cleaned: DataFrame, options: TfidfOptions) -> DataFrame:
    weights = tfidf(cleaned, options, by="block")
    a, b = weights.alias("a"), weights.alias("b")
    together = (F.col("a.block") == F.col("b.block")) & (F.col("a.doc_id") < F.col("b.doc_id"))
    shared = (
        a.join(b, together & (F.col("a.term") == F.col("b.term")))
        .groupBy(
            F.col("a.block").alias("block"),
            F.col("a.doc_id").alias("i"),
            F.col("b.doc_id").alias("j"),
        )
        .agg(F.sum(F.col("a.w") * F.col("b.w")).alias("cos"))
    )
    pairs = ids.alias("a").join(ids.alias("b"), together).select(
        "a.block", F.col("a.doc_id").alias("i"), F.col("b.doc_id").alias("j")
    )
    distance = F.greatest(F.lit(0.0), 1 - F.coalesce("cos", F.lit(0.0)))
    return pairs.join(shared, ["block", "i", "j"], "left").select(
        "block", "i", "j", F.round(distance, _DIGITS).alias("d")
    )


_TREE = (
    "block {block}, method string, round bigint, i bigint, j bigint, height double, n_i bigint, "
    "n_j bigint, node_i bigint, node_j bigint, s1 double, s2 double"
)
_PAIR_STATE = ("size_{0}", "inside_{0}", "height_{0}", "node_{0}")


def _distance(method: str, top, s1, s2, size_a, size_b, inside_a, inside_b, sqrt, at_least_0):
    """Distance of two clusters by sums over the pairs between them, for arrays and columns alike.

    ``top``, ``s1`` and ``s2`` are the maximum, sum and sum of squares of the distances between their
    members, and ``inside`` is the sum of squares within one: the Lance-Williams recurrences of the
    three methods reduce to these additive values.
    """
    pairs = size_a * size_b
    if method == "complete":
        return top
    if method == "average":
        return s1 / pairs
    mean = s2 / pairs - inside_a / (size_a * size_a) - inside_b / (size_b * size_b)
    return sqrt(at_least_0(2 * pairs / (size_a + size_b) * mean))


def _merge(method: str, state: dict[str, np.ndarray], first: int) -> Iterator[tuple]:
    """Merges one pair at a time: ``(round, a, b, height, n_a, n_b, node_a, node_b, s1, s2)``.

    ``state`` holds the matrices ``top``, ``s1`` and ``s2`` and, of each cluster, ``size``, ``inside``,
    ``height`` and the ``node`` that it is.
    """
    top, s1, s2 = state["top"], state["s1"], state["s2"]
    size, inside, height, node = (state[k] for k in ("size", "inside", "height", "node"))
    n = len(size)
    alive = np.ones(n, bool)

    def distances(a: np.ndarray, v: np.ndarray) -> np.ndarray:
        known = (top[a, v], s1[a, v], s2[a, v], size[a], size[v], inside[a], inside[v])
        d = _distance(method, *known, np.sqrt, lambda x: np.maximum(0.0, x))
        return np.where(size[a] * size[v] == 1, top[a, v], np.round(d, _DIGITS))

    near = np.full((n, n), np.inf)
    upper = np.triu_indices(n, 1)
    near[upper] = distances(*upper)
    for number in range(first, first + n - 1):
        a, b = divmod(int(near.argmin()), n)
        h = max(near[a, b], height[a], height[b])
        yield number, a, b, h, size[a], size[b], node[a], node[b], s1[a, b], s2[a, b]
        inside[a] += inside[b] + s2[a, b]
        for sums, joined in ((s1, s1[a] + s1[b]), (s2, s2[a] + s2[b]), (top, np.maximum(top[a], top[b]))):
            sums[a], sums[:, a] = joined, joined
        size[a] += size[b]
        height[a], node[a] = h, number
        alive[b] = False
        near[b, :] = near[:, b] = np.inf
        alive[a] = False
        v = np.flatnonzero(alive)
        alive[a] = True
        near[np.minimum(a, v), np.maximum(a, v)] = distances(np.full(len(v), a), v)


_MERGE = "method round i j height n_i n_j node_i node_j s1 s2".split()


def _finished(part: pd.DataFrame, methods: Sequence[str], first: int) -> pd.DataFrame:
    """All merges that are left of one block, under each method, from the state of its pairs."""
    ids = np.unique(part[["i", "j"]].to_numpy())
    n = len(ids)
    i, j = np.searchsorted(ids, part["i"]), np.searchsorted(ids, part["j"])
    matrices = {}
    for k in ("top", "s1", "s2"):
        matrices[k] = np.zeros((n, n))
        matrices[k][i, j] = matrices[k][j, i] = part[k]
    clusters = {}
    for k in ("size", "inside", "height", "node"):
        clusters[k] = np.zeros(n)
        clusters[k][i], clusters[k][j] = part[f"{k}_i"], part[f"{k}_j"]
    rows = []
    for method in methods:
        state = {k: v.copy() for k, v in (matrices | clusters).items()}
        for number, a, b, *rest in _merge(method, state, first):
            rows.append((method, number, ids[a], ids[b], *rest))
    whole = dict.fromkeys(("round", "n_i", "n_j", "node_i", "node_j"), "int64")
    made = pd.DataFrame(rows, columns=_MERGE).astype(whole)
    made.insert(0, "block", part["block"].iloc[0])
    return made


def _pair_state(distances: DataFrame) -> DataFrame:
    """Every article a cluster of its own: the pairs with what is known of both their clusters."""
    d = F.col("d")
    single = [
        v.alias(c.format(x))
        for x in ("i", "j")
        for c, v in zip(_PAIR_STATE, (F.lit(1.0), F.lit(0.0), F.lit(0.0), F.lit(0).cast("bigint")))
    ]
    return distances.select("block", "i", "j", d.alias("top"), d.alias("s1"), (d * d).alias("s2"), *single)


def _round(state: DataFrame, number: int) -> tuple[DataFrame, DataFrame]:
    """Merges of all reciprocal nearest neighbours of a state with ``method``, and the state after them.

    Pairs are ordered by distance, then by their clusters' ids. A pair that comes first among those
    of both its clusters is merged by the sequential scan too, before either cluster meets another,
    because a merge elsewhere brings no third cluster nearer than its parts were (all three methods
    are reducible) and keeps the smaller id.
    """
    known = [F.col(c) for c in ("top", "s1", "s2", "size_i", "size_j", "inside_i", "inside_j")]
    d = F.lit(None).cast("double")
    for m in METHODS:
        found = _distance(m, *known, F.sqrt, lambda x: F.greatest(x, F.lit(0.0)))
        d = F.when(F.col("method") == m, found).otherwise(d)
    single = F.col("size_i") * F.col("size_j") == 1
    measured = state.withColumn("d", F.when(single, F.col("top")).otherwise(F.round(d, _DIGITS)))
    ends = F.explode(F.array("i", "j")).alias("x")
    nearest = measured.select(*_KEY, ends, F.struct("d", "i", "j").alias("p")).groupBy(*_KEY, "x").agg(F.min("p").alias("p"))
    mutual = nearest.groupBy(*_KEY, "p").agg(F.count(F.lit(1)).alias("n")).filter("n = 2").select(*_KEY, "p.i", "p.j", "p.d")
    merges = measured.drop("d").join(mutual, [*_KEY, "i", "j"])
    merges = stage(
        merges.select(
            *_KEY, F.lit(number).cast("bigint").alias("round"), "i", "j",
            F.greatest("d", "height_i", "height_j").alias("height"), F.col("size_i").cast("bigint").alias("n_i"),
            F.col("size_j").cast("bigint").alias("n_j"), "node_i", "node_j", "s1", "s2",
            (F.col("inside_i") + F.col("inside_j") + F.col("s2")).alias("inside"),
        ),
        "merges",
    )
    joined = merges.select(
        *_KEY, F.explode(F.array("i", "j")).alias("old"), F.col("i").alias("new"),
        (F.col("n_i") + F.col("n_j")).cast("double").alias("size"), "inside", "height", F.col("round").alias("node"),
    )
    moved = state
    for x in ("i", "j"):
        names = {"old": x, "new": f"new_{x}"} | {c: f"now_{c}_{x}" for c in ("size", "inside", "height", "node")}
        moved = moved.join(joined.withColumnsRenamed(names), [*_KEY, x], "left")
    a, b = (F.coalesce(f"new_{x}", x) for x in ("i", "j"))
    now = [
        F.coalesce(f"now_{c}_{x}", f"{c}_{x}").alias(f"{c}_{x}") for x in ("i", "j") for c in ("size", "inside", "height", "node")
    ]
    turned = moved.filter(a != b).select(*_KEY, a.alias("a"), b.alias("b"), "top", "s1", "s2", *now)
    swap = F.col("a") > F.col("b")
    sides = [
        F.first(F.when(swap, F.col(f"{c}_{y}")).otherwise(F.col(f"{c}_{x}"))).alias(f"{c}_{x}")
        for x, y in (("i", "j"), ("j", "i")) for c in ("size", "inside", "height", "node")
    ]
    after = turned.groupBy(*_KEY, F.least("a", "b").alias("i"), F.greatest("a", "b").alias("j")).agg(
        F.max("top").alias("top"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"), *sides
    )
    return merges.drop("inside"), stage(after, "clusters")


def merge_tree(distances: DataFrame, methods: Sequence[str] = METHODS, task_rows: int = TASK_ROWS) -> DataFrame:
    """All merges of all blocks and methods, one row each.

    ``distances`` holds every pair of a block, as :func:`cosine_distance_edges` gives it. The tree
    carries what all later steps need: round, joined clusters ``i`` and ``j``, height, sizes, sums of
    distances, and the nodes joined: 0 is an article, else the round that made the cluster.

    Blocks of up to ``task_rows`` articles are done by the kernel at once. The pairs of others are
    merged by rounds of joins until so many clusters are left; keys are pairs, so a large block is
    spread over all tasks. A round merges every pair of reciprocal nearest neighbours, as a rule a
    fifth of the clusters; a block that grows by one article at a time takes as many rounds.
    """
    unknown = set(methods) - set(METHODS)
    if unknown:
        raise ValueError(f"unknown linkage methods {sorted(unknown)}")
    schema = _TREE.replace("{block}", distances.schema["block"].dataType.simpleString())
    distances = stage(distances.select("block", "i", "j", "d"), "pairs")
    most_pairs = task_rows * (task_rows - 1) // 2

    def large(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most_pairs).select(*keys)

    def whole_tree(part: pd.DataFrame) -> pd.DataFrame:
        single = {c.format(x): float(c == "size_{0}") for x in ("i", "j") for c in _PAIR_STATE}
        return _finished(part.assign(top=part["d"], s1=part["d"], s2=part["d"] ** 2, **single), methods, 1)

    blocks = stage(large(distances, ["block"]), "large-blocks")
    if blocks.isEmpty():
        return stage(distances.groupBy("block").applyInPandas(whole_tree, schema), "tree")
    small = distances.join(blocks, "block", "left_anti")
    tree = [small.groupBy("block").applyInPandas(whole_tree, schema)]
    state = _pair_state(distances)
    method = F.explode(F.array(*[F.lit(m) for m in methods])).alias("method")
    open_ones = stage(state.join(blocks, "block", "left_semi").select("*", method), "clusters")
    number = 0
    while True:
        keys = stage(large(open_ones, _KEY), "large-blocks")
        rest = open_ones.join(keys, _KEY, "left_anti")
        tree.append(_by_kernel(rest, number + 1, schema))
        if keys.isEmpty():
            break
        number += 1
        merges, open_ones = _round(open_ones.join(keys, _KEY, "left_semi"), number)
        tree.append(merges)
    whole = tree[0]
    for part in tree[1:]:
        whole = whole.unionByName(part)
    return stage(whole, "tree")


def _by_kernel(state: DataFrame, first: int, schema: str) -> DataFrame:
    def finish(part: pd.DataFrame) -> pd.DataFrame:
        return _finished(part, [part["method"].iloc[0]], first)

    return state.groupBy(*_KEY).applyInPandas(finish, schema)


def _steps(tree: DataFrame) -> DataFrame:
    """The merges numbered from 0 as ``step``: by height, then size, then first member."""
    by_height = Window.partitionBy(*_KEY).orderBy(
        F.round("height", _HEIGHT_DIGITS), F.col("n_i") + F.col("n_j"), "i"
    )
    return tree.withColumn("step", (F.row_number().over(by_height) - 1).cast("bigint"))


def _sides(tree: DataFrame, *more: str) -> DataFrame:
    """Both sides of every merge: ``id`` and ``node`` of the cluster, and of the one it goes into."""
    sides = F.explode(
        F.array(*[F.struct(F.lit(x).alias("side"), F.col(x).alias("id"), F.col(f"node_{x}").alias("node")) for x in ("i", "j")])
    )
    return tree.select(*_KEY, sides.alias("s"), F.col("i").alias("up_id"), F.col("round").alias("up_node"), *more).select(
        *_KEY, "s.*", "up_id", "up_node", *more
    )


def _to_the_top(links: DataFrame) -> DataFrame:
    """``links`` with ``up_id`` and ``up_node`` of the last ancestor that links lead to, and ``add`` summed.

    By doubling: every link is replaced by the one its end has, until none has one; as many rounds as
    the depth has digits in binary.
    """
    columns = [*_KEY, "id", "node", "up_id", "up_node", "add"]
    links = stage(links.select(*columns), "links")
    while True:
        ahead = links.select(
            *_KEY, F.col("id").alias("up_id"), F.col("node").alias("up_node"), F.col("up_id").alias("next_id"),
            F.col("up_node").alias("next_node"), F.col("add").alias("more"),
        )
        joined = links.join(ahead, [*_KEY, "up_id", "up_node"], "left").select(
            *_KEY, "id", "node", F.coalesce("next_id", "up_id").alias("up_id"), F.coalesce("next_node", "up_node").alias("up_node"),
            (F.col("add") + F.coalesce("more", F.lit(0))).alias("add"), F.col("next_id").isNotNull().alias("moved"),
        )
        moved = stage(joined, "links")
        links = moved.select(*columns)
        if moved.filter("moved").isEmpty():
            return links


def _numbered_merges(tree: DataFrame) -> DataFrame:
    """Merges with the node numbers of their two sides: leaves 0..n-1, then n + step."""
    merges = _steps(tree)
    whole = Window.partitionBy(*_KEY)
    by_id = Window.partitionBy(*_KEY).orderBy("id")
    leaf_nodes = (
        _sides(tree).filter("node = 0")
        .select(*_KEY, "id", "node", (F.row_number().over(by_id) - 1).cast("bigint").alias("number"))
    )
    inner_nodes = merges.select(
        *_KEY, F.col("i").alias("id"), F.col("round").alias("node"),
        (F.max("step").over(whole) + 2 + F.col("step")).alias("number"),
    )
    nodes = leaf_nodes.unionByName(inner_nodes)
    for side in ("i", "j"):
        merges = merges.join(
            nodes.withColumnsRenamed(
                {"id": side, "node": f"node_{side}", "number": f"number_{side}"}
            ),
            [*_KEY, side, f"node_{side}"],
        )
    return merges


def linkage(tree: DataFrame) -> DataFrame:
    """Linkage table ``(block, method, step, left, right, height, size)``.

    Leaves are numbered 0..n-1 in id order, the cluster made at ``step`` is ``n + step``; the
    smaller number is on the left.
    """
    return _numbered_merges(tree).select(
        *_KEY, "step", F.least("number_i", "number_j").alias("left"),
        F.greatest("number_i", "number_j").alias("right"), "height",
        (F.col("n_i") + F.col("n_j")).alias("size"),
    )


def _places(tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merges with ``left`` (the side drawn there), and the places at which all their sides begin."""
    drawn = F.when(F.col("number_i") < F.col("number_j"), "i").otherwise("j")
    merges = stage(_numbered_merges(tree).withColumn("left", drawn), "numbered")
    before = F.when(F.col("side") == F.col("left"), 0).when(F.col("left") == "i", F.col("n_i")).otherwise(F.col("n_j"))
    return merges, _to_the_top(_sides(merges, "left", "n_i", "n_j").withColumn("add", before.cast("bigint")))


def cophenetic_distances(tree: DataFrame) -> DataFrame:
    """Height at which each pair of leaves first joins: ``(block, method, i, j, height)``.

    In drawn order the leaves of a cluster stand together, so a merge's pairs are those of two runs of
    the block's leaves.
    """
    merges, places = _places(tree)
    leaves = places.filter("node = 0").groupBy(*_KEY).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("add", "id"))), lambda x: x["id"]).alias("order")
    )
    begins = places.select(*_KEY, F.col("id").alias("i"), F.col("node").alias("round"), "add")
    n_left = F.when(F.col("left") == "i", F.col("n_i")).otherwise(F.col("n_j")).cast("int")
    n_right = (F.col("n_i") + F.col("n_j")).cast("int") - n_left
    # The last merge has no place among the sides: it begins at 0.
    at = F.coalesce("add", F.lit(0)).cast("int") + 1
    runs = merges.join(begins, [*_KEY, "i", "round"], "left").join(leaves, _KEY).select(
        *_KEY, "height", F.slice("order", at, n_left).alias("a"), F.slice("order", at + n_left, n_right).alias("b")
    )
    pairs = runs.select(*_KEY, "height", F.explode("a").alias("x"), "b").select(*_KEY, "height", "x", F.explode("b").alias("y"))
    return pairs.select(*_KEY, F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "height")


def cophenetic_scores(tree: DataFrame) -> DataFrame:
    """Cophenetic correlation of every method: ``(block, method, ccc)``.

    The pairs a merge joins all share its height, and their distances are summed on the merge
    already, so Pearson's correlation over all pairs needs the merges only.
    """
    pairs = F.col("n_i") * F.col("n_j")
    h = F.col("height")
    sums = tree.groupBy(*_KEY).agg(
        F.sum(pairs).alias("n"), F.sum("s1").alias("d"), F.sum("s2").alias("dd"),
        F.sum(h * pairs).alias("c"), F.sum(h * h * pairs).alias("cc"),
        F.sum(h * F.col("s1")).alias("dc"),
    )
    n, d, c = F.col("n"), F.col("d"), F.col("c")
    varied_d, varied_c = n * F.col("dd") - d * d, n * F.col("cc") - c * c
    tiny = n * n * 10.0**-_HEIGHT_DIGITS
    ccc = (n * F.col("dc") - d * c) / F.sqrt(varied_d * varied_c)
    return sums.select(*_KEY, F.when((varied_d > tiny) & (varied_c > tiny), ccc).alias("ccc"))


def _method_order() -> Column:
    return F.array_position(F.array(*[F.lit(m) for m in METHODS]), F.col("method"))


def compare_methods(tree: DataFrame) -> DataFrame:
    """Scores with their quality band and the best method of each block marked."""
    ccc = F.col("ccc")
    # A block without any spread has no correlation and counts as the lowest band.
    band = (
        F.when(ccc >= 0.85, "Excelente").when(ccc >= 0.75, "Bueno").when(ccc >= 0.65, "Moderado")
        .otherwise("Bajo")
    )
    ranked = Window.partitionBy("block").orderBy(
        F.desc_nulls_last(F.round("ccc", _HEIGHT_DIGITS)), _method_order()
    )
    return cophenetic_scores(tree).select(
        *_KEY, "ccc", band.alias("band"), (F.row_number().over(ranked) == 1).alias("is_best")
    )


def best_method(tree: DataFrame) -> DataFrame:
    """The method with the highest correlation; ties in the order ward, complete, average."""
    return compare_methods(tree).filter("is_best").select("block", "method", "ccc")


def cut_clusters(tree: DataFrame, share: float = CUT_SHARE) -> DataFrame:
    """Flat clusters below ``share`` of the greatest merge height: ``(block, method, leaf, cluster)``.

    A cluster is named by its smallest member. Heights never fall on the way up, so the merges below
    the cut are whole subtrees, and a leaf's cluster is the last of them that its links lead to.
    """
    whole = Window.partitionBy(*_KEY)
    low = tree.withColumn("_top", F.max("height").over(whole)).filter(F.col("height") < F.lit(share) * F.col("_top"))
    tops = _to_the_top(_sides(low).withColumn("add", F.lit(0).cast("bigint"))).filter("node = 0")
    leaves = _sides(tree).filter("node = 0").select(*_KEY, F.col("id").alias("leaf"))
    named = tops.select(*_KEY, F.col("id").alias("leaf"), F.col("up_id").alias("cluster"))
    return leaves.join(named, [*_KEY, "leaf"], "left").select(*_KEY, "leaf", F.coalesce("cluster", "leaf").alias("cluster"))


def leaf_order(tree: DataFrame) -> DataFrame:
    """Left-to-right position of every leaf in the drawn tree: the leaves to the left of its ancestors."""
    _, places = _places(tree)
    return places.filter("node = 0").select(*_KEY, F.col("id").alias("leaf"), F.col("add").alias("position"))
