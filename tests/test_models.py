import numpy as np
from pyspark.sql import functions as F

from vela.operators import classify, cluster, hierarchy, neighbors

FEATS = ["x1", "x2", "x3"]


def test_lda_qda_rda_agree_on_the_limits(spark, blobs):
    lda = classify.fit_discriminant(blobs, FEATS, "cluster", "lda")
    rda = classify.fit_discriminant(blobs, FEATS, "cluster", "rda", gamma=0.0, lam=1.0)
    qda = classify.fit_discriminant(blobs, FEATS, "cluster", "qda")
    rda0 = classify.fit_discriminant(blobs, FEATS, "cluster", "rda", gamma=0.0, lam=0.0)
    a = lda.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    b = rda.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    assert np.allclose(a.filter(like="prob_").values, b.filter(like="prob_").values, atol=1e-9)
    c = qda.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    d = rda0.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    assert np.allclose(c.filter(like="prob_").values, d.filter(like="prob_").values, atol=1e-9)
    acc = lda.predict(blobs, keep=["cluster"]).filter(F.col("cluster") == F.col("predicted")).count() / 300
    assert acc > 0.95
    fda = classify.fit_fda(blobs, FEATS, "cluster", 1).predict(blobs, keep=["key"]).orderBy("key").toPandas()
    assert (fda.predicted.values == a.predicted.values).all()


def test_kmeans_and_silhouette(spark, blobs):
    km = cluster.kmeans(blobs, FEATS, 3, nstart=2, seed=1)
    asg = km.assign(blobs, FEATS, keep=["key", "x1", "x2", "x3"])
    sil = cluster.silhouette(asg, "key", FEATS, "cluster").toPandas()
    assert sil.sil_width.between(-1, 1).all() and sil.sil_width.mean() > 0.6
    # each row sits in its nearest centre
    C = km.centers()
    pdf = asg.toPandas()
    d = ((pdf[FEATS].values[:, None, :] - C[None]) ** 2).sum(-1)
    assert (d.argmin(1) + 1 == pdf.cluster.values).all()


def test_knn_exact_against_numpy(spark, blobs):
    nn = neighbors.knn(blobs, "key", FEATS, 4).toPandas()
    X = blobs.orderBy("key").toPandas()[FEATS].values
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(-1))
    np.fill_diagonal(D, np.inf)
    for k, g in nn.groupby("key"):
        assert sorted(g.neighbor) == sorted(np.argsort(D[k], kind="stable")[:4])


def test_dbscan_separates_rings(spark, rings):
    out = cluster.dbscan(rings, "key", ["x1", "x2"], eps=0.5, min_pts=4).toPandas()
    lab = out.merge(rings.toPandas(), on="key")
    assert lab.groupby("ring").cluster.nunique().max() == 1
    assert lab.cluster.nunique() == 2


def test_single_linkage_and_hierarchical(spark, rings):
    sl = cluster.single_linkage_cut(rings, "key", ["x1", "x2"], 0.6).toPandas().merge(rings.toPandas(), on="key")
    assert sl.cluster.nunique() == 2 and sl.groupby("ring").cluster.nunique().max() == 1
    asg, table = hierarchy.hierarchical(rings, "key", ["x1", "x2"], 2, "single")
    h = asg.toPandas().merge(rings.toPandas(), on="key")
    assert h.groupby("ring").cluster.nunique().max() == 1


def test_logistic_meets_score_equations(spark, blobs):
    two = blobs.filter(F.col("cluster") != "c3").withColumn("x1", F.col("x1") + F.col("x3") * 3)
    m = classify.fit_logistic(two, FEATS, "cluster")
    p = m.predict(two, keep=["cluster", *FEATS]).toPandas()
    y = (p.cluster == m.levels[1]).astype(float).values
    r = y - p[f"prob_{m.levels[1]}"].values
    X = np.column_stack([np.ones(len(p)), p[FEATS].values])
    assert np.abs(X.T @ r).max() < 1e-2


def test_forest_importances(spark, blobs):
    rf = classify.fit_forest(blobs, FEATS, "cluster", n_trees=20)
    assert abs(sum(rf.importances()) - 1) < 1e-9


def test_knn_tuning_finds_neighbours_once_a_fold(spark, blobs, monkeypatch):
    from vela.operators import neighbors, split, tune
    folds = split.stratified_folds(blobs, "cluster", "key", 2, 1, seed=4)
    levels, calls, real = ["c1", "c2", "c3"], [], neighbors.knn
    monkeypatch.setattr(neighbors, "knn", lambda *a, **k: calls.append(1) or real(*a, **k))
    got = tune.tune(blobs, "knn", ["x1"], "cluster", "key", [{"k": k} for k in (1, 4, 9)], folds, levels).results.toPandas()
    assert len(calls) == 2 and len(got) == 6
    pdf = blobs.join(folds, "key").toPandas()
    for r in got.itertuples():
        k = int(r.params.split(":")[1].strip(" }"))
        tr, te = pdf[pdf.fold != r.fold], pdf[pdf.fold == r.fold]
        right = 0
        for x, y in zip(te.x1, te.cluster):
            near = tr.assign(d=(tr.x1 - x).abs()).sort_values(["d", "key"]).cluster.head(k).tolist()
            right += max(levels, key=lambda c: near.count(c)) == y
        assert abs(r.Accuracy - right / len(te)) < 1e-9


def test_registered_forest_grows_all_its_trees(spark, monkeypatch, tmp_path):
    from types import SimpleNamespace

    from vela.plans.checks import QUERIES
    rows = [(i, float(i * 37 % 101), i % 13, "FO"[i % 2]) for i in range(60)]
    spark.createDataFrame(rows, "o_orderkey long, o_totalprice double, o_custkey long, o_orderstatus string").write.parquet(f"{tmp_path}/orders.parquet")
    grown = []
    monkeypatch.setattr(classify, "fit_ml", lambda df, f, y, est, *a, **b: grown.append((est.getNumTrees(), est.getMaxDepth(), df.count())) or SimpleNamespace(importances=lambda: [0.5, 0.5]))
    QUERIES["random_forest"](spark, str(tmp_path)).collect()
    assert grown == [(500, 12, 60)]
