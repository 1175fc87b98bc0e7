import math
import random

import numpy as np
import pyarrow as pa
import pytest
from corpuslens.operators import clustering, preprocess

SCHEMA = "block string, i bigint, j bigint, d double"


def sequential(dist, ids, method):
    """One merge at a time with the Lance-Williams update."""
    d = {frozenset(p): v for p, v in dist.items()}
    members = {i: [i] for i in ids}
    merges = []
    while len(members) > 1:
        pair = min(
            ((d[frozenset((a, b))], a, b) for a in members for b in members if a < b)
        )
        h, s, t = pair
        ns, nt = len(members[s]), len(members[t])
        for v in members:
            if v in (s, t):
                continue
            x, y, nv = d[frozenset((s, v))], d[frozenset((t, v))], len(members[v])
            if method == "complete":
                new = max(x, y)
            elif method == "average":
                new = (ns * x + nt * y) / (ns + nt)
            else:
                new = math.sqrt(((nv + ns) * x * x + (nv + nt) * y * y - nv * h * h) / (ns + nt + nv))
            d[frozenset((s, v))] = new
        merges.append((h, list(members[s]), list(members[t])))
        members[s] = members[s] + members.pop(t)
    return merges


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return cov / math.sqrt(sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y))


@pytest.fixture(scope="module")
def forest(spark):
    """Two blocks of random distances and their trees."""
    rng = random.Random(7)
    dist = {
        block: {(i, j): rng.random() for i in ids for j in ids if i < j}
        for block, ids in {"x": list(range(10, 31)), "y": list(range(100, 109))}.items()
    }
    rows = [(b, i, j, v) for b, pairs in dist.items() for (i, j), v in pairs.items()]
    tree = clustering.merge_tree(spark.createDataFrame(rows, SCHEMA)).cache()
    return dist, tree


@pytest.mark.parametrize("method", clustering.METHODS)
def test_tree_equals_sequential_merging(forest, method):
    dist, tree = forest
    coph = clustering.cophenetic_distances(tree).filter(f"method = '{method}'").collect()
    scores = {
        r.block: r.ccc
        for r in clustering.cophenetic_scores(tree).filter(f"method = '{method}'").collect()
    }
    cuts = clustering.cut_clusters(tree).filter(f"method = '{method}'").collect()
    for block, pairs in dist.items():
        ids = sorted({x for p in pairs for x in p})
        merges = sequential(pairs, ids, method)
        expected = {
            tuple(sorted((a, b))): h for h, left, right in merges for a in left for b in right
        }
        found = {(r.i, r.j): r.height for r in coph if r.block == block}
        assert found.keys() == expected.keys()
        assert all(abs(found[k] - expected[k]) < 1e-9 for k in found)
        keys = sorted(pairs)
        want = pearson([pairs[k] for k in keys], [expected[k] for k in keys])
        assert abs(scores[block] - want) < 1e-9
        top = max(h for h, _, _ in merges)
        flat = {i: [i] for i in ids}
        for h, left, right in merges:
            if h < 0.7 * top:
                joined = sorted(left + right)
                flat.update({x: joined for x in joined})
        assert {r.leaf: r.cluster for r in cuts if r.block == block} == {
            i: flat[i][0] for i in ids
        }


def test_linkage_table_and_leaf_order(forest):
    dist, tree = forest
    rows = clustering.linkage(tree).collect()
    order = clustering.leaf_order(tree).collect()
    for block, pairs in dist.items():
        ids = sorted({x for p in pairs for x in p})
        for method in clustering.METHODS:
            z = sorted((r for r in rows if (r.block, r.method) == (block, method)), key=lambda r: r.step)
            assert [r.step for r in z] == list(range(len(ids) - 1))
            assert [r.height for r in z] == sorted(r.height for r in z)
            node = {k: [i] for k, i in enumerate(ids)}
            sizes = {}
            for r in z:
                assert r.left < r.right
                node[len(ids) + r.step] = node[r.left] + node[r.right]
                sizes[r.step] = len(node[len(ids) + r.step])
                assert r.size == sizes[r.step]
            drawn = sorted(
                (r for r in order if (r.block, r.method) == (block, method)),
                key=lambda r: r.position,
            )
            assert [r.leaf for r in drawn] == node[len(ids) + z[-1].step]


def test_best_method_and_bands(forest):
    _, tree = forest
    compared = clustering.compare_methods(tree).collect()
    best = {r.block: r.method for r in clustering.best_method(tree).collect()}
    for block in ("x", "y"):
        mine = [r for r in compared if r.block == block]
        assert best[block] == max(mine, key=lambda r: r.ccc).method
        for r in mine:
            band = ["Bajo", "Moderado", "Bueno", "Excelente"][
                (r.ccc >= 0.65) + (r.ccc >= 0.75) + (r.ccc >= 0.85)
            ]
            assert r.band == band and r.is_best == (r.method == best[block])


def test_equal_distances_terminate(spark):
    rows = [("t", i, j, 1.0) for i in range(6) for j in range(i + 1, 6)]
    tree = clustering.merge_tree(spark.createDataFrame(rows, SCHEMA), ("average",))
    assert sorted(r.size for r in clustering.linkage(tree).collect())[-1] == 6


def test_block_guard(spark):
    docs = spark.range(130).selectExpr("'b' AS block", "id AS doc_id", "'x' AS text")
    with pytest.raises(ValueError):
        clustering.check_block_sizes(docs)
    with pytest.raises(ValueError):
        clustering.merge_tree(spark.createDataFrame([], SCHEMA), ("single",))


def test_article_in_two_blocks(spark):
    """A block's distances don't depend on what other blocks hold."""
    texts = ["red fish blue fish", "red bird blue bird", "one fish two fish", "green bird one cat"]
    docs = [("x", i, t) for i, t in enumerate(texts)]
    more = docs + [("y", i, t) for i, t in enumerate(texts[:3])] + [("y", 9, "red red red cat")]
    found = []
    for rows in (docs, more):
        df = spark.createDataFrame(rows, "block string, doc_id bigint, text string")
        edges = clustering.cosine_distance_edges(df).filter("block = 'x'").collect()
        found.append(sorted((r.i, r.j, r.d) for r in edges))
    assert len(found[0]) == 6 and found[0] == found[1]


@pytest.mark.parametrize("digits", [1, 9])
def test_large_blocks_by_rounds_equal_the_kernel(spark, digits):
    """Reciprocal neighbours merged by joins give the kernel's tree, with many ties and without."""
    rng = random.Random(digits)
    point = {i: (rng.random(), rng.random()) for i in range(80)}
    rows = [
        ("big", i, j, round(math.dist(point[i], point[j]), digits)) for i in point for j in point if i < j
    ] + [("small", i, j, 0.5 + (i + j) / 100) for i in range(8) for j in range(i + 1, 8)]
    table = spark.createDataFrame(rows, SCHEMA)
    found = {}
    for task_rows in (512, 16):
        tree = clustering.merge_tree(table, task_rows=task_rows)
        key = lambda r: (r.block, r.method, r.step)
        links = sorted(clustering.linkage(tree).collect(), key=key)
        cuts = sorted(map(tuple, clustering.cut_clusters(tree).collect()))
        order = sorted(map(tuple, clustering.leaf_order(tree).collect()))
        scores = {(r.block, r.method): round(r.ccc, 9) for r in clustering.cophenetic_scores(tree).collect()}
        coph = sorted((*r[:4], round(r.height, 9)) for r in clustering.cophenetic_distances(tree).collect())
        found[task_rows] = [(key(r), r.left, r.right, r.size, round(r.height, 9)) for r in links], cuts, order, scores, coph
    assert found[16] == found[512]


def test_a_chain_of_merges(spark):
    """A tree as deep as it has articles: links are followed by doubling, clusters cut within it."""
    n = 100
    rows = [("c", i, j, 1.0 + 0.01 * j) for i in range(n) for j in range(i + 1, n)]
    tree = clustering.merge_tree(spark.createDataFrame(rows, SCHEMA), ("complete", "average"))
    order = clustering.leaf_order(tree).collect()
    assert len(order) == 2 * n and {r.position for r in order} == set(range(n))
    cuts = clustering.cut_clusters(tree, 0.8).filter("method = 'complete'").collect()
    low = {j for j in range(1, n) if 1 + 0.01 * j < 0.8 * (1 + 0.01 * (n - 1))} | {0}
    assert {r.leaf: r.cluster for r in cuts} == {i: 0 if i in low else i for i in range(n)}


@pytest.mark.parametrize("cap", [3000, 5])
def test_blocks_in_a_task_equal_blocks_by_joins(spark, monkeypatch, cap):
    """Distances made in one group are those of the term join, with repeated, null and empty rows."""
    rng = random.Random(3)
    words = ["ant", "bee", "cat's", "dog", "été", "fox", "gnu"]
    docs = [(b, i, " ".join(rng.choices(words, k=rng.randint(0, 6)))) for b in ("x", "y", None) for i in range(7)]
    docs += [docs[2], ("x", None, "bee fox"), ("y", 30, None), ("z", 1, "ant")]
    df = spark.createDataFrame(docs, "block string, doc_id bigint, text string")
    lemmas = spark.createDataFrame([("fox", "ant")], "token string, lemma string")
    options = clustering.TfidfOptions((1, 2), 1, 0.95, cap, True)
    found = {}
    for rows in (512, 3):
        monkeypatch.setattr(clustering, "TASK_ROWS", rows)
        for table in (None, lemmas):
            edges = clustering.cosine_distance_edges(df, table, options).collect()
            found[rows, table is None] = sorted((r.block, r.i, r.j, round(r.d, 9)) for r in edges)
    assert found[512, True] == found[3, True] and found[512, False] == found[3, False] and len(found[3, True]) > 40


def test_block_edges_by_hand():
    """A block's distances, whatever its slices: ties of the cap go to the first terms, rows of one id add up."""
    from collections import Counter

    rng = np.random.default_rng(9)
    texts = [" ".join(f"t{int(x)}" for x in rng.zipf(1.4, 12) if x < 40) for _ in range(30)] + ["", None, "é1 é2", "é2 t1"]
    ids = [*range(33), 5]
    options = clustering.TfidfOptions((1, 2), 1, 0.9, 50, True)
    given = pa.table({"block": pa.array([7] * len(ids)), "doc_id": pa.array(ids), "words": pa.nulls(len(ids), pa.string())})
    rows = pa.table({"block": pa.array([7] * len(ids)), "doc_id": pa.array(ids), "words": pa.array(texts)})
    grams = [Counter(w := (t or "").split()) + Counter(map(" ".join, zip(w, w[1:]))) for t in texts]
    df, cf = Counter(x for g in grams for x in g), sum(grams, Counter())
    n = len(texts) - 1
    terms = sorted((x for x in df if df[x] <= 0.9 * n), key=lambda x: (-cf[x], x))[:50]
    raw, norm = Counter(), Counter()
    for d, g in zip(ids, grams):
        for x in set(g) & set(terms):
            w = (np.log(g[x]) + 1) * (np.log((n + 1) / (df[x] + 1)) + 1)
            raw[d, x] += w
            norm[d] += w * w
    got = clustering._block_edges(given, rows, options)
    pairs = {(i, j): d for i, j, d in zip(*(got.column(c).to_pylist() for c in "ijd"))}
    assert len(pairs) == 33 * 32 / 2 and got.num_rows == len(pairs) + 32
    for (i, j), d in pairs.items():
        cos = sum(raw[i, x] * raw[j, x] for x in terms) / ((norm[i] * norm[j]) ** 0.5 or 1.0)
        assert d == pytest.approx(max(0.0, 1 - cos), abs=1e-9)


def test_lemmas_find_their_rows_where_they_are(spark):
    """Tokens of a document are shuffled once."""
    docs = spark.createDataFrame([(1, 2, ["aas", "b"]), (1, None, ["aas"])], "block int, doc_id int, tokens array<string>")
    lemmas = spark.createDataFrame([("aas", "aa")], "token string, lemma string")
    found = preprocess.lemmatize(docs, lemmas, ["block", "doc_id"], "tokens")
    assert {(r.block, r.doc_id): r.tokens for r in found.collect()} == {(1, 2): ["aa", "b"], (1, None): ["aa"]}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = preprocess.lemmatize(docs, lemmas, ["block", "doc_id"], "tokens")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning(_key") <= 3 and "isnull" not in plan.split("SortMergeJoin [_key")[0][-200:]
