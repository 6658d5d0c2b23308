"""Block pairs on a grid, and eps cells: the same pairs as a dense run, each once."""
import numpy as np
import pytest

from vela.operators import cluster, neighbors
from vela.operators.neighbors import EpsCells
from vela.operators.patterns import grid_side


@pytest.fixture(scope="module")
def plane(spark):
    X = np.random.default_rng(4).uniform(0, 20, size=(400, 2))
    X[:130] = X[0]  # a third of the rows are one point
    return spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "key long, vec array<double>").repartition(3), X


def dense_pairs(X, eps):
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    return {(i, j) for i, j in zip(*np.nonzero(D <= eps * eps)) if i < j}


@pytest.mark.parametrize("eps", [0.5, 30.0])
def test_pairs_within_eps(spark, plane, eps):
    df, X = plane
    got = [(r.i, r.j) for r in neighbors.within_eps(df, "key", "vec", eps, block_rows=40).collect()]
    assert len(got) == len(set(got)) and set(got) == dense_pairs(X, eps)


def test_cells_in_small_blocks(spark, plane):
    df, X = plane
    cells = EpsCells(df, "key", "vec", 0.5, block_rows=25)
    assert len(dense_pairs(X, 0.5)) <= cells.pairs < 400 * 399 / 4

    def emit(it):
        import pandas as pd
        for pdf in it:
            for r in pdf.itertuples():
                D = neighbors.sq_dists(np.reshape(r.va, (-1, 2)), np.reshape(r.vb, (-1, 2)))
                I, J = np.nonzero(D <= 0.25)
                a, b = np.asarray(r.ka)[I], np.asarray(r.kb)[J]
                keep = a < b if r.a == r.b else a != b
                yield pd.DataFrame({"i": np.minimum(a, b)[keep], "j": np.maximum(a, b)[keep]})

    got = [(r.i, r.j) for r in cells.map_pairs(emit, "i long, j long").collect()]
    assert len(got) == len(set(got)) and set(got) == dense_pairs(X, 0.5)


def test_grid_meets_every_pair_once(spark, plane):
    df, X = plane
    got = [(r.key_i, r.key_j) for r in neighbors.pairwise_distance(df, "key", "vec", block_rows=23).select("key_i", "key_j").collect()]
    assert len(got) == len(set(got)) == 400 * 399 // 2


def test_neighbours_of_another_table(spark, plane):
    df, X = plane
    got = neighbors.knn(df.where("key < 50"), "key", "vec", 3, reference=df.where("key >= 130"), block_rows=17).toPandas()
    D = np.sqrt(((X[:50, None] - X[None, 130:]) ** 2).sum(-1))
    for q, g in got.groupby("key"):
        assert np.allclose(np.sort(g["dist"]), np.sort(D[q])[:3])


def test_grid_side():
    assert grid_side(1, 0, 8) == 1 and grid_side(1000, 0, 8) == 4
    assert grid_side(10_000, 64 << 30, 8) == 1024


def test_dbscan_in_cells(spark, plane):
    df, X = plane
    out = cluster.dbscan(df, "key", "vec", 0.5, 5).toPandas().set_index("key").sort_index()
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)) <= 0.5
    assert (out["core"].to_numpy() == (D.sum(axis=1) >= 5)).all()


def test_matrix_product_distances_decide_as_the_direct_ones():
    """Rows far from the origin, copies and near copies: candidates by product, decisions and ties by direct sums."""
    from vela.operators.hierarchy import _first_per_row
    from vela.operators.patterns import near_sq_dists, pair_sq_dists, rough_sq_dists, sq_dists
    rng = np.random.default_rng(6)
    a = rng.normal(size=(60, 24)) + 1000
    b = np.concatenate([a[:20], a[:20] + 1e-6, a[20:30], rng.normal(size=(30, 24)) + 1000])
    direct = sq_dists(a, b)
    rough, slack = rough_sq_dists(a, b)
    assert 0 < slack and np.abs(rough - direct).max() <= slack
    assert np.allclose(near_sq_dists(a, b), direct, rtol=1e-9, atol=0)
    own, other = np.arange(60), 100 + np.arange(80)[::-1]
    exact = _first_per_row(direct, own, other)
    quick = _first_per_row(rough, own, other, slack, lambda R, C: pair_sq_dists(a[R], b[C]))
    assert all((x == y).all() for x, y in zip(exact, quick))
