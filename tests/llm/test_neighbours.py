import numpy as np
import pytest
from brute import DATA, read
from pyspark.sql import functions as F

from corpuslens.llm import neighbours
from corpuslens.llm.queries import LLM_QUERIES

VECTORS = "vec_id bigint, embedding array<float>"


def nearest(rows, is_query, k=20):
    """{(query, rank): (id, score)} by all products."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in np.flatnonzero(is_query(ids)):
        scores = x @ x[q]
        order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != ids[q]][:k]
        for r, j in enumerate(order):
            out[int(ids[q]), r + 1] = (int(ids[j]), float(scores[j]))
    return out


def found(df):
    rows = df.collect()
    assert len({(r.query_id, r.rank) for r in rows}) == len(rows)
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in rows}


def recall(got, true):
    assert got.keys() == true.keys()
    pairs = {(q, i) for (q, _), (i, _) in true.items()}
    return len(pairs & {(q, i) for (q, _), (i, _) in got.items()}) / len(pairs)


def products(rows, got):
    at = {i: np.array(v, np.float32).astype(np.float64) for i, v in rows}
    for (q, r), (i, s) in got.items():
        assert s == pytest.approx(at[q] @ at[i], abs=1e-12) and q != i
        if (q, r - 1) in got:
            assert (got[q, r - 1][1], -got[q, r - 1][0]) > (s, -i)


def test_embeddings(spark):
    rows = [(r.vec_id, r.embedding) for r in read(spark, "sf0.1", "embeddings").collect()]
    got = found(LLM_QUERIES["op11_neighbours"](spark, f"{DATA}/sf0.1"))
    products(rows, got)
    assert recall(got, nearest(rows, lambda i: i % 20 == 0)) >= 0.9
    few = [(r.vec_id, r.embedding) for r in read(spark, "sf0.01", "embeddings").collect()]
    assert recall(found(LLM_QUERIES["op11_neighbours"](spark, f"{DATA}/sf0.01")), nearest(few, lambda i: i % 20 == 0)) == 1


@pytest.mark.parametrize("cell", [1 << 22, 1 << 12])
def test_crowds_and_uneven_norms(spark, monkeypatch, cell):
    """Many buckets of two functions, a crowd of near vectors, uneven norms, cells dealt by salt."""
    monkeypatch.setattr(neighbours, "CELL_VALUES", cell)
    monkeypatch.setattr(neighbours, "BUCKET_VECTORS", 8)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 20))
    x[1000:2000] = x[7] + 0.05 * rng.normal(size=(1000, 20))
    x[2000:] *= rng.uniform(0.2, 3, 1000)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = found(neighbours.nearest_vectors(spark.createDataFrame(rows, VECTORS), F.col("id") % 50 == 0))
    products(rows, got)
    assert recall(got, nearest(rows, lambda i: i % 50 == 0)) >= 0.9


def test_equal_vectors_and_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    same = [(i, [1.0, 2.0, 0.0]) for i in range(100, 1400)]
    rows = [*same, (1, [2.0, 4.0, 0.0]), (20, [0.0, 0.0, 1.0]), (40, [-1.0, 0.5, -0.0]), (41, [-1.0, 0.5, 0.0])]
    odd = [(60, None), (80, []), (100_000, [0.0, 0.0, 0.0]), (120_000, [1.0, None, 1.0]), (140_000, [nan, 1.0, 1.0]), (160_000, [1.0, inf, 1.0]), (None, [1.0, 1.0, 1.0]), (200_000, [1.0, 1.0]), (220_000, [3.0, 1.0])]
    table = spark.createDataFrame([(*r, 1, "x") for r in [*rows, *odd, rows[0]]], VECTORS + ", vector int, id string")
    got = found(neighbours.nearest_vectors(table, F.col("id") % 20 == 0))
    two = {(200_000, 1): (220_000, 4.0), (220_000, 1): (200_000, 4.0)}
    assert got == nearest(rows, lambda i: i % 20 == 0) | two
    assert neighbours.nearest_vectors(table.limit(0), F.col("id") % 20 == 0).count() == 0
    alone = spark.createDataFrame([(20, [1.0])], VECTORS)
    assert neighbours.nearest_vectors(alone, F.col("id") % 20 == 0).count() == 0


def test_rotation_keeps_lengths_and_probes_begin_at_home():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 48))
    turned = neighbours.rotated(x, 11, 0, 0)
    assert np.allclose((turned**2).sum(axis=1), (x**2).sum(axis=1)) and turned.shape == (200, 64)
    hashing = neighbours.Hashing((128, 16), 1.0, False)
    probes = neighbours.probes_of(x, hashing, 1, 300)
    assert (probes[:, 0] == neighbours.buckets_of(x, hashing, 1)).all()
    assert all(len(set(p)) == 300 for p in probes.tolist())
    assert sorted(neighbours.probes_of(x, hashing, 1, 4096)[0].tolist()) == list(range(2048))
