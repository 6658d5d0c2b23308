import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vela.operators import evaluate as ev


def _scores(spark):
    pdf = pd.DataFrame({"k": range(12), "real": list("yynynnyynnny"),
                        "p": [0.9, 0.8, 0.8, 0.7, 0.5, 0.5, 0.5, 0.4, 0.3, 0.2, 0.2, 0.1]})
    return spark.createDataFrame(pdf)


def test_auc_with_ties_counts_half(spark):
    df = _scores(spark)
    a = ev.auc(df, "real", "p", "y").collect()[0]["auc"]
    pdf = df.toPandas()
    pos = pdf[pdf.real == "y"].p.tolist()
    neg = pdf[pdf.real == "n"].p.tolist()
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(a - want) < 1e-12
    flipped = ev.auc(df.withColumn("p", 1 - F.col("p")), "real", "p", "y").collect()[0]["auc"]
    assert abs(flipped - (1 - want)) < 1e-12


def test_roc_has_infinite_ends_and_pr_auc_perfect(spark):
    df = _scores(spark)
    roc = ev.roc_curve(df, "real", "p", "y").toPandas()
    assert roc.threshold.min() == float("-inf") and roc.threshold.max() == float("inf")
    perfect = spark.createDataFrame(pd.DataFrame({"real": ["y"] * 5 + ["n"] * 5, "p": [.9, .8, .7, .6, .55, .4, .3, .2, .1, .05]}))
    assert abs(ev.pr_auc(perfect, "real", "p", "y").collect()[0]["pr_auc"] - 1.0) < 1e-12


def test_overall_stats_reproduce_published_lda_figures(spark):
    # 139 test rows: 48 malignant (43 found), 91 benign (all found)
    cm = spark.createDataFrame([("malignant", "malignant", 43), ("benign", "malignant", 5),
                                ("malignant", "benign", 0), ("benign", "benign", 91)],
                               "prediction string, reference string, freq long")
    s = ev.overall_stats(cm).collect()[0]
    assert round(s["accuracy"], 4) == 0.9640
    assert (round(s["acc_lower"], 4), round(s["acc_upper"], 4)) == (0.9181, 0.9882)
    assert round(s["nir"], 4) == 0.6547
    assert round(s["kappa"], 4) == 0.9184
    assert round(s["mcnemar_p"], 5) == 0.07364
    assert s["p_acc_gt_nir"] < 2e-16


def test_binary_metrics_null_when_undefined(spark):
    df = spark.createDataFrame([("n", "n"), ("n", "n")], "real string, pred string")
    r = ev.binary_metrics(df, "real", "pred", "y").collect()[0]
    assert r["recall"] is None and r["precision"] is None and r["specificity"] == 1.0
    assert r["balanced_accuracy"] == 1.0


def test_running_sums_survive_crowded_scores(spark):
    import numpy as np
    rng = np.random.default_rng(5)
    p = np.concatenate([rng.uniform(0, 1e-6, 3000), rng.uniform(0, 1, 300)])
    y = rng.integers(0, 2, len(p))
    pdf = pd.DataFrame({"real": np.where(y == 1, "y", "n"), "p": p})
    df = spark.createDataFrame(pdf)
    cnt = ev.score_counts(df, "p", F.col("real") == "y")
    got = ev.cumulative_by_score(cnt, heavy_rows=100).orderBy("score").toPandas()
    s = pdf.sort_values("p")
    assert np.array_equal(got.cum_pos.values, (s.real == "y").cumsum().values)
    a = ev.auc(df, "real", "p", "y").collect()[0]["auc"]
    pos, neg = p[y == 1], p[y == 0]
    want = ((pos[:, None] > neg[None]).sum() + 0.5 * (pos[:, None] == neg[None]).sum()) / (len(pos) * len(neg))
    assert abs(a - want) < 1e-12


def test_class_pairs_are_made_from_counts(spark, monkeypatch):
    """Rows are counted per (feature, score, class) before the pairs of classes multiply them."""
    from pyspark.sql import functions as F
    from vela.operators import evaluate
    df = spark.range(3000).select((F.col("id") % 7).cast("double").alias("a"), F.when(F.col("id") % 11 > 0, (F.col("id") * 5 % 13).cast("double")).alias("b"),
                                  F.element_at(F.array(F.lit("x"), F.lit("y"), F.lit("z")), (F.col("id") * 31 % 17 % 3 + 1).cast("int")).alias("c"))
    given = []
    explode = F.explode
    monkeypatch.setattr(evaluate.F, "explode", lambda c: given.append(c) or explode(c))
    plans = []
    inner = evaluate.cumulative_by_score
    monkeypatch.setattr(evaluate, "cumulative_by_score", lambda counts, *a, **k: plans.append(counts._jdf.queryExecution().optimizedPlan().toString()) or inner(counts, *a, **k))
    got = {r["variable"]: r for r in evaluate.filter_importance(df, ["a", "b"], "c").collect()}
    assert given and plans[0].index("Generate") < plans[0].rindex("Aggregate")  # an aggregate below the explode
    p = df.toPandas()
    auc = {}
    for v in "ab":
        for c in "xyz":
            best = 0
            for o in "xyz".replace(c, ""):
                pos, neg = (p.loc[(p["c"] == k) & p[v].notna(), v].to_numpy() for k in (c, o))
                best = max(best, float((np.sign(pos[:, None] - neg[None, :]) + 1).mean() / 2))
            auc[v, c] = best
    for c in "xyz":
        lo, hi = sorted((auc["a", c], auc["b", c]))
        for v in "ab":
            assert abs(got[v][c] - (auc[v, c] - lo) / (hi - lo) * 100) < 1e-6


def test_compare_models_multiclass_reads_predictions_once_for_the_areas(spark):
    """A model that lacks a class keeps the areas of its other pairs."""
    from vela.operators import evaluate
    rows = [("m", c, p, *q) for c, p, q in (("a", "a", (.8, .1, .1)), ("b", "b", (.2, .7, .1)), ("b", "a", (.6, .3, .1)), ("a", "b", (.4, .5, .1)))]
    out = evaluate.compare_models_multiclass(spark.createDataFrame(rows, "model string, real string, pred string, a double, b double, c double"), "model", "real", "pred", {c: c for c in "abc"}).collect()
    assert len(out) == 1 and abs(out[0]["auc"] - 0.75) < 1e-12
