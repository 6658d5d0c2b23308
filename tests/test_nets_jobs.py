import numpy as np
from pyspark.sql import functions as F

from vela.operators import nets
from vela.plans import jobs

FEATS = ["x1", "x2", "x3"]


def test_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(20, 3))
    Y = np.eye(3)[rng.integers(0, 3, 20)]
    Ws, bs = nets._init([3, 5, 3], 1)
    _, _, gW, gb = nets._grad(X, Y, Ws, bs, 0.0, None)
    eps = 1e-6
    for li in range(2):
        for idx in [(0, 0), (1, 2)]:
            Wp = [w.copy() for w in Ws]
            Wp[li][idx] += eps
            Wm = [w.copy() for w in Ws]
            Wm[li][idx] -= eps
            lp = nets._grad(X, Y, Wp, bs, 0.0, None)[0]
            lm = nets._grad(X, Y, Wm, bs, 0.0, None)[0]
            assert abs((lp - lm) / (2 * eps) - gW[li][idx]) < 1e-5


def test_mlp_loss_falls_and_early_stop(spark, blobs):
    m = nets.fit_mlp(blobs, FEATS, "cluster", "key", hidden=(8,), epochs=8, lr=0.05, n_batches=2)
    h = m.history_table(spark).orderBy("epoch").toPandas()
    assert h.loss.iloc[-1] < h.loss.iloc[0]
    acc = m.predict(blobs, keep=["cluster"]).filter(F.col("cluster") == F.col("predicted")).count() / 300
    assert acc > 0.9
    e = nets.fit_mlp(blobs, FEATS, "cluster", "key", hidden=(8,), epochs=30, lr=0.5, optimizer="sgd",
                     n_batches=1, patience=2, lr_patience=1)
    hist = e.history
    best = int(np.argmin([r[3] for r in hist]))
    assert len(hist) - 1 - best <= 2


def test_supervised_and_unsupervised_reports(spark, blobs):
    two = blobs.withColumn("y", F.when(F.col("cluster") == "c1", "yes").otherwise("no"))
    out = jobs.supervised_report(two.drop("cluster"), "key", "y", models=("glm", "lda"), positive="yes",
                                 k_folds=3, parallelism=2)
    comp = out["comparison"].toPandas()
    assert set(comp.model) == {"glm", "lda"} and (comp.auc > 0.95).all()
    u = jobs.unsupervised_report(blobs, "key", "cluster", k=3, nstart=2)
    assert u["mean_silhouette"][2] > 0.5
    assert u["reduced"].count() == 300


def test_closed_form_tuning_matches_fold_by_fold(spark, blobs):
    from vela.operators import split, tune
    two = blobs.withColumn("y", F.when(F.col("cluster") == "c1", "yes").otherwise("no")) \
        .withColumn("x1", F.col("x1") + F.col("x2") * 0.3)
    folds = split.stratified_folds(two, "y", "key", 3, 1, seed=2)
    grid = [{"gamma": 0.0, "lam": 1.0}, {"gamma": 0.2, "lam": 0.5}]
    fast = tune.tune(two, "rda", FEATS, "y", "key", grid, folds, ["yes", "no"], "yes")
    assert fast.results.count() == 6
    # the same cells the generic way: one fit per fold
    from vela.operators.classify import fit_discriminant
    data = two.join(folds, "key")
    for g in grid:
        for f in (1, 2, 3):
            tr = data.filter(F.col("fold") != f)
            te = data.filter(F.col("fold") == f)
            m = fit_discriminant(tr, FEATS, "y", "rda", levels=["yes", "no"], **g)
            acc = m.predict(te, keep=["y"]).select(F.avg((F.col("y") == F.col("predicted")).cast("double"))) \
                .collect()[0][0]
            got = fast.results.filter((F.col("fold") == f) & (F.col("params") == __import__("json").dumps(g, sort_keys=True))) \
                .collect()[0]["Accuracy"]
            assert abs(acc - got) < 1e-12
