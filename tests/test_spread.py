"""What a task reads does not grow with the table."""
import numpy as np

from vela.operators import classify, cluster, hierarchy, neighbors, patterns


def test_spread_bounds_the_rows_of_a_partition(spark, monkeypatch):
    monkeypatch.setattr(cluster, "SPREAD_ROWS", 50, raising=False)
    df = spark.range(0, 4000, 1, 2)
    for spread in (cluster.spread, classify._spread):
        parts = spread(df).rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
        assert sum(parts) == 4000 and max(parts) <= 100


def test_neighbours_of_a_cell_are_folded(spark, monkeypatch):
    """A cell hands on k candidates a row, however many blocks its strips have."""
    X = np.round(np.random.default_rng(1).normal(size=(160, 20)), 1)
    X[40:60] = X[:20]  # ties
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(X)], "key long, vec array<double>")
    seen = []
    inner = neighbors.map_block_pairs
    monkeypatch.setattr(neighbors, "map_block_pairs", lambda *a, **k: seen.append(inner(*a, **k)) or seen[-1])
    got = neighbors.knn(df, "key", "vec", 5, block_rows=4).toPandas().sort_values(["key", "rank"])
    D = ((X[:, None] - X[None]) ** 2).sum(-1)
    np.fill_diagonal(D, np.inf)
    want = np.lexsort((np.broadcast_to(np.arange(160), D.shape), D), axis=1)[:, :5]
    have = got["neighbor"].to_numpy().reshape(160, 5)
    assert np.allclose(np.take_along_axis(D, have, 1), np.take_along_axis(D, want, 1))
    strips = neighbors_strips(spark)
    assert seen[0].count() <= 160 * 5 * (strips + 1)


def neighbors_strips(spark):
    from vela.operators.patterns import grid_side
    return grid_side(40, 0, spark.sparkContext.defaultParallelism)


def test_elbow_makes_its_vectors_once(spark, monkeypatch):
    made = []
    inner = cluster.spread
    monkeypatch.setattr(cluster, "spread", lambda df: made.append(1) or inner(df))
    X = np.random.default_rng(2).normal(size=(60, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in X], "a double, b double")
    out = {r["k"]: r["wss"] for r in cluster.elbow(df, ["a", "b"], range(1, 4), nstart=2).collect()}
    assert len(made) == 1 and set(out) == {1, 2, 3}
    for k in (2, 3):
        assert out[k] == cluster.kmeans(df, ["a", "b"], k, nstart=2).cost


def test_starts_let_ml_hold_its_rows(spark, monkeypatch):
    """ml prepares the rows of a start once, not once a pass; few large starts run at once."""
    seen, inner = [], cluster.KMeans.fit
    monkeypatch.setattr(cluster.KMeans, "fit", lambda self, x: seen.append(x) or inner(self, x))
    X = np.random.default_rng(5).normal(size=(90, 2))
    df = spark.createDataFrame([(float(a), float(b)) for a, b in X], "a double, b double")
    many = cluster.kmeans(df, ["a", "b"], 3, nstart=3)
    assert len(seen) == 3 and not any(x.storageLevel.useMemory for x in seen)
    monkeypatch.setattr(cluster, "HELD_ROWS", 100)
    one = cluster.kmeans(df, ["a", "b"], 3, nstart=3)
    assert one.seed == many.seed and np.allclose(one.centers(), many.centers())


def test_clean_mds_report_looks_for_flat_columns_once(spark, monkeypatch):
    from vela.operators import clean
    from vela.plans import jobs
    seen, inner = [], clean.zero_variance_columns
    monkeypatch.setattr(clean, "zero_variance_columns", lambda *a: seen.append(1) or inner(*a))
    X = np.random.default_rng(6).normal(size=(60, 2))
    df = spark.createDataFrame([(i, float(a), float(b), float(a * b), 1.0, "xy"[i % 2]) for i, (a, b) in enumerate(X)], "key long, a double, b double, c double, d double, g string")
    out = jobs.clean_mds_report(df, "key", ["a", "b", "c", "d"], "g", nstart=2)
    assert len(seen) == 1 and sum(r["x"] + r["y"] for r in out["by_group"].collect()) == 60


# ---------------------------------------------------------------- what a cell of the grid hands on


def _handed_on(monkeypatch, module):
    """Frames that ``map_block_pairs`` of a module returns."""
    made, real = [], module.map_block_pairs
    monkeypatch.setattr(module, "map_block_pairs", lambda *a, **k: made.append(real(*a, **k)) or made[-1])
    return made


def test_one_medoid_takes_one_pass_and_a_row_a_cell(spark, monkeypatch):
    X = np.random.default_rng(4).normal(size=(400, 5))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "key long, vec array<double>")
    made = _handed_on(monkeypatch, hierarchy)
    assign, medoids, cost = hierarchy.kmedoids(df, "key", "vec", 1)
    total = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)).sum(axis=1)
    assert medoids == [int(total.argmin())] and abs(cost - total.min()) < 1e-9 and assign.count() == 400
    strips = patterns.grid_side(8, 8 * 400 * 5, spark.sparkContext.defaultParallelism)
    assert len(made) == 1 and made[0].count() <= 400 * (strips + 1)


def test_dbscan_hands_on_no_pairs(spark, monkeypatch):
    rng = np.random.default_rng(8)
    X = np.vstack([rng.normal(size=(180, 6)) * 0.1, rng.normal(size=(180, 6)) * 0.1 + 3, rng.normal(size=(20, 6)) * 4 + 9])
    X[360] = X[:180].mean(axis=0) + [1.05, 0, 0, 0, 0, 0]
    D, eps, least = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1)), 0.9, 60
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "key long, vec array<double>")
    made = _handed_on(monkeypatch, neighbors)
    monkeypatch.setattr(neighbors, "cells_help", lambda *a: False)
    out = cluster.dbscan(df, "key", "vec", eps, least, block_rows=50).toPandas().set_index("key").sort_index()
    near = D <= eps
    core = near.sum(axis=1) >= least
    assert core[:360].all() and not core[360:].any() and near[360, :180].any()
    want = np.where(np.arange(380) < 180, 1, np.where(np.arange(380) < 360, 2, 0))
    want[360] = 1  # a border row
    assert out["core"].tolist() == core.tolist() and out["cluster"].tolist() == want.tolist()
    assert near.sum() > 60_000 and sum(m.count() for m in made) < 380 * 8 + 2 * 380


def test_average_and_complete_hold_no_row_a_pair(spark, monkeypatch):
    """Until few clusters are left, nearest ones come from the rows; the tree is that of the table of pairs."""
    import pytest
    rng = np.random.default_rng(11)
    X = np.vstack([rng.normal(size=(50, 20)), rng.normal(size=(50, 20)) * 0.05 + 2])
    X[40:45] = X[:5]  # copies
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(X)], "key long, vec array<double>")
    trees = {}
    for linkage in ("average", "complete"):
        trees[linkage] = hierarchy.hierarchical(df, "key", "vec", 4, linkage)[1].toPandas().sort_values(["height", "a", "b"])
    monkeypatch.setattr(hierarchy, "PAIR_CLUSTERS", 50, raising=False)
    monkeypatch.setattr(hierarchy, "PIECE_ROWS", 3, raising=False)
    monkeypatch.setattr(hierarchy, "pairwise_distance", lambda *a, **k: pytest.fail("a row a pair"))
    for linkage, want in trees.items():
        got = hierarchy.hierarchical(df, "key", "vec", 4, linkage)[1].toPandas().sort_values(["height", "a", "b"])
        assert np.allclose(np.sort(got["height"]), np.sort(want["height"]))
        assert set(zip(got["a"], got["b"], got["size"])) == set(zip(want["a"], want["b"], want["size"]))


def test_nearest_clusters_of_some(spark, monkeypatch):
    """Later rounds of average and complete linkage look only from the clusters that lost their nearest one."""
    from vela.session import Steps
    rng = np.random.default_rng(14)
    X, c = rng.normal(size=(40, 18)), np.repeat([0, 8, 16, 20, 22, 23, 24, 30], [8, 8, 4, 2, 1, 1, 6, 10])
    size = {k: int((c == k).sum()) for k in set(c.tolist())}
    state = spark.createDataFrame([(i, x.tolist(), int(k), size[int(k)]) for i, (x, k) in enumerate(zip(X, c))], "id long, vec array<double>, c long, n long")
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    for linkage, over, piece in (("average", np.mean, 3), ("complete", np.max, 512)):
        monkeypatch.setattr(hierarchy, "PIECE_ROWS", piece)
        some = state.where("c IN (8, 22, 30)")
        got = {r["c"]: r["best"] for r in hierarchy._nearest_clusters(state, 40, linkage, Steps(spark), some, 19).collect()}
        assert set(got) == {8, 22, 30}
        for k, best in got.items():
            v, other = min((over(D[np.ix_(c == k, c == j)]), j) for j in size if j != k)
            assert np.isclose(best["v"], v) and (best["lo"], best["hi"]) == (min(k, other), max(k, other))


# ---------------------------------------------------------------- registered queries do their whole job


def test_registered_elbow_tries_every_k_of_the_reference(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from vela.plans.checks import QUERIES
    spark.createDataFrame([(float(i % 7), i % 5 / 10) for i in range(60)], "l_quantity double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(cluster, "DRAWN_ROWS", 10, raising=False)
    tried, inner = [], cluster._lloyd_costs
    monkeypatch.setattr(cluster, "_lloyd_costs", lambda x, starts, *a: tried.append(([len(c) for c in starts], *a)) or inner(x, starts, 3, 1e-4))
    out = {r["k"]: r["wss"] for r in QUERIES["elbow"](spark, str(tmp_path)).collect()}
    assert tried == [([k for k in range(2, 11) for _ in range(20)], 100, 1e-4)]
    assert sorted(out) == list(range(1, 11)) and all(out[k] > out[k + 1] for k in range(1, 10))


def test_drawn_starts_are_rows_far_apart(spark):
    """k-means++: centres are distinct rows, of well parted groups mostly one each; fewer if there are fewer."""
    X = np.random.default_rng(13).normal(size=(90, 2)) * 0.01 + np.repeat([[0, 0], [9, 0], [0, 9]], 30, axis=0)
    x = spark.createDataFrame([(v.tolist(),) for v in X], "a array<double>").repartition(3)
    starts = cluster._drawn_starts(x, [(3, s) for s in range(30)] + [(2, 0)], 5)
    held = {tuple(v) for v in X}
    assert [len(c) for c in starts] == [3] * 30 + [2] and all(tuple(v) in held for c in starts for v in c)
    assert sum(len({tuple(np.round(v / 9)) for v in c}) == 3 for c in starts[:30]) >= 28 and len({tuple(c[0]) for c in starts}) > 15
    two = spark.createDataFrame([([float(i % 2)],) for i in range(20)], "a array<double>")
    assert [len(c) for c in cluster._drawn_starts(two, [(5, 0), (1, 0)], 5)] == [2, 1]


def test_elbow_takes_the_steps_of_all_starts_together(spark, monkeypatch):
    """One pass over the rows a step, whatever the starts; costs are those of ml's own steps."""
    passes, inner = [], cluster._lloyd_sums
    monkeypatch.setattr(cluster, "_lloyd_sums", lambda x, centers: passes.append(len(centers)) or inner(x, centers))
    X = np.random.default_rng(12).normal(size=(80, 3)) + 50
    df = spark.createDataFrame([tuple(x.tolist()) for x in X], "a double, b double, c double")
    out = {r["k"]: r["wss"] for r in cluster.elbow(df, ["a", "b", "c"], [4, 2], nstart=3, max_iter=30).collect()}
    assert passes[0] == 6 and len(passes) <= 30
    for k in (2, 4):
        assert np.isclose(out[k], cluster.kmeans(df, ["a", "b", "c"], k, nstart=3, max_iter=30).cost, rtol=1e-10)
