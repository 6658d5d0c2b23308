"""Evaluation: confusion tables, threshold metrics, ROC/PR, AUC, importance.

Everything runs from two kinds of small aggregate: counts per (real,
predicted) pair, and positive/negative counts per distinct score.  Running
sums over distinct scores use bucketed offsets (P1), so no window ever holds
a whole group; a score value repeated by a third of the rows is one row after
the map-side partial count.
"""
from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.functions.stats import binom_sf, chi2_sf, clopper_pearson
from vela.operators.patterns import bounded_collect, join_small


def _div(a: Column, b: Column) -> Column:
    """a / b, NULL when b is 0 (R's safe division)."""
    return F.when(b != 0, a / b)


# ------------------------------------------------------------------ V1, V2

#: Classes a confusion table may have (it is a small table of classes squared).
CLASS_LIMIT = 1000


def confusion_matrix(df: DataFrame, pred: str, real: str, levels: list | None = None) -> DataFrame:
    """V1: long (prediction, reference, freq), every level pair, zeros kept.

    Levels are those of ``real`` (sorted) unless given.  A null, or a value
    outside the levels, on either side is an error."""
    counts = df.groupBy(F.col(pred).cast("string").alias("prediction"), F.col(real).cast("string").alias("reference")) \
        .agg(F.count(F.lit(1)).alias("freq"))
    seen = bounded_collect(counts, CLASS_LIMIT ** 2)
    if levels is None:
        found = None if seen is None else {r["reference"] for r in seen if r["reference"] is not None}
        if found is None or len(found) > CLASS_LIMIT:
            raise ValueError(f"{real} has more than {CLASS_LIMIT} levels")
        levels = found
    levels = sorted(str(x) for x in levels)
    if seen is None:
        raise ValueError(f"{real} and {pred} have more than {CLASS_LIMIT ** 2} value pairs")
    for side, name in (("prediction", pred), ("reference", real)):
        values = {r[side] for r in seen}
        if None in values:
            raise ValueError(f"{name} holds nulls")
        stray = sorted(values - set(levels))
        if stray:
            raise ValueError(f"{side} {stray[0]!r} is not a level of {real}")
    freq = {(r["prediction"], r["reference"]): r["freq"] for r in seen}
    return df.sparkSession.createDataFrame([(p, r, freq.get((p, r), 0)) for p in levels for r in levels],
                                           "prediction string, reference string, freq long")


def _cm_dict(cm: DataFrame):
    rows = cm.collect()
    levels = sorted({r["reference"] for r in rows} | {r["prediction"] for r in rows})
    m = {(r["prediction"], r["reference"]): r["freq"] for r in rows}
    return levels, m


def overall_stats(cm: DataFrame) -> DataFrame:
    """V2: accuracy with exact 95 % interval, no-information rate, one-sided
    binomial p (accuracy > NIR), kappa, McNemar statistic and p.  The table
    has at most L^2 rows; the closed forms run on the driver."""
    levels, m = _cm_dict(cm)
    n = sum(m.values())
    correct = sum(m.get((lv, lv), 0) for lv in levels)
    ref_tot = {lv: sum(m.get((p, lv), 0) for p in levels) for lv in levels}
    pred_tot = {lv: sum(m.get((lv, r), 0) for r in levels) for lv in levels}
    acc = correct / n
    lo, hi = clopper_pearson(correct, n)
    nir = max(ref_tot.values()) / n
    p_acc = binom_sf(correct, n, nir)
    pe = sum(ref_tot[lv] * pred_tot[lv] for lv in levels) / (n * n)
    kappa = (acc - pe) / (1 - pe) if pe != 1 else None
    if len(levels) == 2:
        b, c = m.get((levels[0], levels[1]), 0), m.get((levels[1], levels[0]), 0)
        stat = (abs(b - c) - 1) ** 2 / (b + c) if b + c > 0 else None
        df_ = 1
    else:
        stat, df_ = 0.0, 0
        for i, a in enumerate(levels):
            for bb in levels[i + 1:]:
                x, y = m.get((a, bb), 0), m.get((bb, a), 0)
                if x + y > 0:
                    stat += (x - y) ** 2 / (x + y)
                df_ += 1
    p_mc = chi2_sf(stat, df_) if stat is not None else None
    spark = cm.sparkSession
    return spark.createDataFrame(
        [(float(acc), float(lo), float(hi), float(nir), float(p_acc),
          None if kappa is None else float(kappa), None if stat is None else float(stat),
          None if p_mc is None else float(p_mc))],
        "accuracy double, acc_lower double, acc_upper double, nir double, p_acc_gt_nir double, "
        "kappa double, mcnemar_stat double, mcnemar_p double")


# ------------------------------------------------------------------ V3 - V7

def _binary_counts(df: DataFrame, real: str, pred: str, positive, group_cols=()) -> DataFrame:
    r = F.col(real) == F.lit(positive)
    p = F.col(pred) == F.lit(positive)
    return df.groupBy(*group_cols).agg(
        F.sum((r & p).cast("long")).alias("TP"), F.sum((~r & ~p).cast("long")).alias("TN"),
        F.sum((~r & p).cast("long")).alias("FP"), F.sum((r & ~p).cast("long")).alias("FN"))


def _binary_from_counts(x: DataFrame, keep=()) -> DataFrame:
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("TP", "TN", "FP", "FN"))
    sens = _div(tp, tp + fn)
    spec = _div(tn, tn + fp)
    bal = F.when(sens.isNotNull() & spec.isNotNull(), (sens + spec) / 2) \
        .otherwise(F.coalesce(sens, spec))
    return x.select(*keep, F.col("TP").cast("long").alias("TP"), F.col("TN").cast("long").alias("TN"),
                    F.col("FP").cast("long").alias("FP"), F.col("FN").cast("long").alias("FN"),
                    _div(tp + tn, tp + tn + fp + fn).alias("accuracy"), sens.alias("recall"),
                    spec.alias("specificity"), _div(tp, tp + fp).alias("precision"),
                    _div(tn, tn + fn).alias("npv"), _div(2 * tp, 2 * tp + fp + fn).alias("f1"),
                    bal.alias("balanced_accuracy"))


def binary_metrics(df: DataFrame, real: str, pred: str, positive) -> DataFrame:
    """V3: TP, TN, FP, FN, accuracy, recall, specificity, precision, NPV, F1,
    balanced accuracy (mean of the defined rates); 0 denominators give NULL."""
    return _binary_from_counts(_binary_counts(df, real, pred, positive))


def binary_detail(df: DataFrame, real: str, pred: str, positive) -> DataFrame:
    """V4: prevalence, detection rate, detection prevalence."""
    c = _binary_counts(df, real, pred, positive)
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("TP", "TN", "FP", "FN"))
    n = tp + tn + fp + fn
    return c.select(_div(tp + fn, n).alias("prevalence"), _div(tp, n).alias("detection_rate"),
                    _div(tp + fp, n).alias("detection_prevalence"))


def class_metrics(df: DataFrame, real: str, pred: str, levels: list | None = None) -> DataFrame:
    """V5: one-vs-rest figures per class from the confusion table."""
    cm = confusion_matrix(df, pred, real, levels)
    lv = [r[0] for r in cm.select("reference").distinct().collect()]
    per = cm.select(F.explode(F.array(*[F.struct(
        F.lit(c).alias("class"),
        ((F.col("prediction") == c) & (F.col("reference") == c)).cast("long").alias("tp"),
        ((F.col("prediction") == c) & (F.col("reference") != c)).cast("long").alias("fp"),
        ((F.col("prediction") != c) & (F.col("reference") == c)).cast("long").alias("fn"),
        ((F.col("prediction") != c) & (F.col("reference") != c)).cast("long").alias("tn"))
        for c in lv])).alias("s"), "freq")
    agg = per.groupBy(F.col("s.class").alias("class")).agg(
        F.sum(F.col("s.tp") * F.col("freq")).alias("TP"), F.sum(F.col("s.tn") * F.col("freq")).alias("TN"),
        F.sum(F.col("s.fp") * F.col("freq")).alias("FP"), F.sum(F.col("s.fn") * F.col("freq")).alias("FN"))
    out = _binary_from_counts(agg, keep=["class"])
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("TP", "TN", "FP", "FN"))
    n = tp + tn + fp + fn
    return out.withColumn("prevalence", _div(tp + fn, n)).withColumn("detection_rate", _div(tp, n)) \
        .withColumn("detection_prevalence", _div(tp + fp, n))


def classify_at(df: DataFrame, prob: str, threshold: float, positive, negative,
                out_col: str = "predicted") -> DataFrame:
    """V6: positive when p >= threshold."""
    return df.withColumn(out_col, F.when(F.col(prob) >= F.lit(threshold), F.lit(positive))
                         .otherwise(F.lit(negative)))


# The reference's threshold grid, 0.10 to 0.90 by 0.05.
SWEEP_THRESHOLDS = [round(0.10 + 0.05 * i, 2) for i in range(17)]


def threshold_sweep(df: DataFrame, real: str, prob: str, positive, thresholds=SWEEP_THRESHOLDS) -> DataFrame:
    """V7: V3 at each threshold.  One pass: 4 conditional sums per threshold
    in a single aggregate (no row explosion)."""
    r = F.col(real) == F.lit(positive)
    aggs = []
    for i, t in enumerate(thresholds):
        p = F.col(prob) >= F.lit(t)
        aggs += [F.sum((r & p).cast("long")).alias(f"tp{i}"), F.sum((~r & ~p).cast("long")).alias(f"tn{i}"),
                 F.sum((~r & p).cast("long")).alias(f"fp{i}"), F.sum((r & ~p).cast("long")).alias(f"fn{i}")]
    wide = df.agg(*aggs)
    long = wide.select(F.explode(F.array(*[F.struct(
        F.lit(float(t)).alias("threshold"), F.col(f"tp{i}").alias("TP"), F.col(f"tn{i}").alias("TN"),
        F.col(f"fp{i}").alias("FP"), F.col(f"fn{i}").alias("FN")) for i, t in enumerate(thresholds)]))
        .alias("s")).select("s.*")
    return _binary_from_counts(long, keep=["threshold"])


# ------------------------------------------------------------------ scores

def score_counts(df: DataFrame, score: str, label: Column, group_cols=()) -> DataFrame:
    """(group, score, pos, neg) per distinct score (map-side combined)."""
    return df.groupBy(*group_cols, F.col(score).cast("double").alias("score")).agg(
        F.sum(label.cast("long")).alias("pos"), F.sum((~label).cast("long")).alias("neg"))


def cumulative_by_score(counts: DataFrame, group_cols=(), n_buckets: int = 1024,
                        heavy_rows: int = 200_000) -> DataFrame:
    """Adds cum_pos, cum_neg (scores <= this one), next_score, P, N.

    P1 in two levels: distinct scores are bucketed by range inside each
    group; a bucket holding more than ``heavy_rows`` distinct scores (scores
    crowded in a narrow range) is split again by its own min/max.  Totals of
    the (small) bucket table become offsets through a window over that
    table; the row window runs per (group, bucket, sub-bucket), so no task
    holds a whole group whatever the score distribution."""
    from vela.session import cut_lineage
    g = list(group_cols)
    counts = cut_lineage(counts)   # read by several passes below; compute once
    rng = counts.groupBy(*g).agg(F.min("score").alias("__lo"), F.max("score").alias("__hi"),
                                 F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    if g:
        x = join_small(counts, rng, g)
    else:
        r = rng.collect()[0]
        x = counts.select("*", F.lit(r["__lo"]).alias("__lo"), F.lit(r["__hi"]).alias("__hi"),
                          F.lit(r["P"]).cast("long").alias("P"), F.lit(r["N"]).cast("long").alias("N"))

    def bucket(lo, hi, v):
        width = (hi - lo) / F.lit(float(n_buckets))
        return F.when(hi > lo, F.least(F.floor((v - lo) / width).cast("int"), F.lit(n_buckets - 1))) \
            .otherwise(F.lit(0))

    x = x.withColumn("__b", bucket(F.col("__lo"), F.col("__hi"), F.col("score")))
    b1 = x.groupBy(*g, "__b").agg(F.count(F.lit(1)).alias("__c1"), F.min("score").alias("__l2"),
                                  F.max("score").alias("__h2"))
    heavy = b1.filter(F.col("__c1") > heavy_rows).select(*g, "__b", "__l2", "__h2")
    x = join_small(x, heavy, [*g, "__b"], how="left")
    x = x.withColumn("__s", F.when(F.col("__l2").isNotNull(), bucket(F.col("__l2"), F.col("__h2"), F.col("score")))
                     .otherwise(F.lit(0)))
    bt = x.groupBy(*g, "__b", "__s").agg(F.sum("pos").alias("__bp"), F.sum("neg").alias("__bn"),
                                         F.min("score").alias("__bmin"))
    wb = Window.partitionBy(*g).orderBy("__b", "__s") if g else Window.orderBy("__b", "__s")
    prev = wb.rowsBetween(Window.unboundedPreceding, -1)
    off = bt.select(*g, "__b", "__s",
                    F.coalesce(F.sum("__bp").over(prev), F.lit(0)).alias("__op"),
                    F.coalesce(F.sum("__bn").over(prev), F.lit(0)).alias("__on"),
                    F.lead("__bmin").over(wb).alias("__nb"))
    x = join_small(x, off, [*g, "__b", "__s"])
    wr = Window.partitionBy(*g, "__b", "__s").orderBy("score")
    run = wr.rowsBetween(Window.unboundedPreceding, 0)
    return x.select(*g, "score", "pos", "neg", "P", "N",
                    (F.col("__op") + F.sum("pos").over(run)).alias("cum_pos"),
                    (F.col("__on") + F.sum("neg").over(run)).alias("cum_neg"),
                    F.coalesce(F.lead("score").over(wr), F.col("__nb")).alias("next_score"))


def _label(df: DataFrame, real: str, positive) -> Column:
    return F.col(real) == F.lit(positive)


def roc_curve(df: DataFrame, real: str, prob: str, positive, group_cols=()) -> DataFrame:
    """V8: (threshold, sensitivity, specificity) at -Inf, the midpoints of
    neighbouring distinct scores, and +Inf (pROC, direction "<").
    Exactly two classes and finite scores are required."""
    _require_binary(df, real, prob, group_cols)
    cum = cumulative_by_score(score_counts(df, prob, _label(df, real, positive), group_cols), group_cols)
    thr = F.when(F.col("next_score").isNull(), F.lit(float("inf"))) \
        .otherwise((F.col("score") + F.col("next_score")) / 2)
    pts = cum.select(*group_cols, thr.alias("threshold"),
                     ((F.col("P") - F.col("cum_pos")) / F.col("P")).alias("sensitivity"),
                     (F.col("cum_neg") / F.col("N")).alias("specificity"))
    g = list(group_cols)
    first = (cum.groupBy(*g).agg(F.count(F.lit(1)).alias("__c")) if g else
             df.sparkSession.range(1).select(F.lit(1).alias("__c")))
    first = first.select(*g, F.lit(float("-inf")).alias("threshold"), F.lit(1.0).alias("sensitivity"),
                         F.lit(0.0).alias("specificity"))
    return first.unionByName(pts)


def _require_binary(df, real, prob, group_cols=()):
    bad = df.filter(F.col(prob).isNull() | F.isnan(F.col(prob)) |
                    (F.abs(F.col(prob)) == F.lit(float("inf")))).limit(1).collect()
    if bad:
        raise ValueError("probabilities contain NULL, NaN or Inf")
    n = df.groupBy(*group_cols).agg(F.countDistinct(real).alias("k")) \
        .filter(F.col("k") != 2).limit(1).collect()
    if n:
        raise ValueError("ROC needs exactly two classes")


def auc(df: DataFrame, real: str, prob: str, positive, group_cols=()) -> DataFrame:
    """V9: area under the ROC curve, ties counting one half (rank-sum).

    As ``roc_curve``: a NULL or non-finite score, or other than two classes, is an error."""
    _require_binary(df, real, prob, group_cols)
    cum = cumulative_by_score(score_counts(df, prob, _label(df, real, positive), group_cols), group_cols)
    return cum.groupBy(*group_cols).agg(
        (F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)) /
         (F.first("P").cast("double") * F.first("N").cast("double"))).alias("auc"))


def best_threshold(roc: DataFrame, group_cols=()) -> DataFrame:
    """threshold(s) of largest sensitivity + specificity - 1 (Youden)."""
    g = list(group_cols)
    y = roc.withColumn("youden", F.col("sensitivity") + F.col("specificity") - 1)
    best = y.groupBy(*g).agg(F.max("youden").alias("__m"))
    if not g:
        m = best.collect()[0]["__m"]
        return y.filter(F.abs(F.col("youden") - F.lit(m)) <= 1e-12)
    return join_small(y, best, g).filter(F.abs(F.col("youden") - F.col("__m")) <= 1e-12).drop("__m")


def pr_curve(df: DataFrame, real: str, prob: str, positive, group_cols=()) -> DataFrame:
    """(threshold, recall, precision) classifying positive when
    score >= threshold, at each distinct score (same guard as ``roc_curve``)."""
    _require_binary(df, real, prob, group_cols)
    cum = cumulative_by_score(score_counts(df, prob, _label(df, real, positive), group_cols), group_cols)
    tp = F.col("P") - F.col("cum_pos") + F.col("pos")
    fp = F.col("N") - F.col("cum_neg") + F.col("neg")
    return cum.select(*group_cols, F.col("score").alias("threshold"), (tp / F.col("P")).alias("recall"),
                      (tp / (tp + fp)).alias("precision"))


def pr_auc(df: DataFrame, real: str, prob: str, positive, group_cols=()) -> DataFrame:
    """Area under the PR curve with the continuous (Davis-Goadrich)
    interpolation between neighbouring points, in closed form:
    integral of (A + x) / (B + (1 + s) x) over each segment."""
    _require_binary(df, real, prob, group_cols)
    cum = cumulative_by_score(score_counts(df, prob, _label(df, real, positive), group_cols), group_cols)
    # going down the scores: point after including this score
    tp_b = F.col("P") - F.col("cum_pos") + F.col("pos")
    fp_b = F.col("N") - F.col("cum_neg") + F.col("neg")
    tp_a = tp_b - F.col("pos")
    fp_a = fp_b - F.col("neg")
    d_tp = F.col("pos").cast("double")
    s = F.col("neg") / F.when(d_tp > 0, d_tp)
    A = tp_a.cast("double")
    B = (tp_a + fp_a).cast("double")
    k = 1 + s
    seg = d_tp / k + (A - B / k) * (F.log(B + k * d_tp) - F.when(B > 0, F.log(B)).otherwise(F.lit(0.0))) / k
    seg = F.when(d_tp > 0, F.when(B > 0, seg).otherwise(d_tp / k)).otherwise(F.lit(0.0))
    return cum.groupBy(*group_cols).agg((F.sum(seg) / F.first("P")).alias("pr_auc"))


# ------------------------------------------------------------------ V12 - V14

def regression_metrics(df: DataFrame, real: str, pred: str) -> DataFrame:
    """MAE, MSE, RMSE, R^2 = 1 - SSE / SST (two aggregates)."""
    mean = df.agg(F.avg(real)).collect()[0][0]
    e = F.col(real) - F.col(pred)
    a = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
               F.sum(e * e).alias("__sse"),
               F.sum((F.col(real) - F.lit(mean)) * (F.col(real) - F.lit(mean))).alias("__sst"))
    return a.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.col("__sse") / F.col("__sst")).alias("r2"))


def residual_table(df: DataFrame, real: str, pred: str, keep=()) -> DataFrame:
    """V13."""
    return df.select(*keep, F.col(real).alias("real"), F.col(pred).alias("predicted"),
                     (F.col(real) - F.col(pred)).alias("residual"))


# Fixed value: the probability clip used by the reference's losses.
LOSS_EPS = 1e-7


def loss_table(df: DataFrame, y_true: str | None = None, y_pred: str | None = None,
               bin_true: str | None = None, bin_prob: str | None = None,
               onehot_true: str | None = None, prob_array: str | None = None) -> DataFrame:
    """MSE, MAE, binary and categorical cross-entropy in one aggregate,
    probabilities clipped to [1e-7, 1 - 1e-7]."""
    def clip(c):
        return F.least(F.greatest(c, F.lit(LOSS_EPS)), F.lit(1 - LOSS_EPS))
    aggs = []
    if y_true and y_pred:
        e = F.col(y_true) - F.col(y_pred)
        aggs += [F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae")]
    if bin_true and bin_prob:
        p = clip(F.col(bin_prob))
        y = F.col(bin_true).cast("double")
        aggs.append((-F.avg(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("binary_cross_entropy"))
    if onehot_true and prob_array:
        terms = F.aggregate(F.zip_with(F.col(onehot_true), F.col(prob_array),
                                       lambda a, b: a.cast("double") * F.log(clip(b))),
                            F.lit(0.0), lambda acc, v: acc + v)
        aggs.append((-F.avg(terms)).alias("categorical_cross_entropy"))
    return df.agg(*aggs)


# ------------------------------------------------------------------ V15 - V18

def filter_importance(df: DataFrame, features: list[str], real: str, levels: list | None = None) -> DataFrame:
    """Each feature alone as a score.  Two classes: max(AUC, 1 - AUC).
    More classes: per class, the largest AUC against each other class.
    Scaled to 0-100 by min-max over features (per class column).  One
    unpivot, one grouped count per (feature, score, class), P1 running sums;
    the pairs of classes come from the counts, not from rows."""
    if levels is None:
        levels = sorted(r[0] for r in bounded_collect(df.select(real).distinct(), 1000))
    long = df.select(F.col(real).alias("__y"), *[F.col(c).cast("double").alias(c) for c in features]) \
        .unpivot(["__y"], features, "variable", "value").filter(F.col("value").isNotNull())
    if len(levels) == 2:
        cnt = score_counts(long.withColumnRenamed("value", "v"), "v", F.col("__y") == F.lit(levels[0]),
                           ["variable"])
        cum = cumulative_by_score(cnt, ["variable"])
        a = cum.groupBy("variable").agg(
            (F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)) /
             (F.first("P").cast("double") * F.first("N").cast("double"))).alias("auc"))
        a = a.select("variable", F.greatest("auc", 1 - F.col("auc")).alias("imp"))
        a = a.select("variable", F.col("imp").alias(str(levels[0])), F.col("imp").alias(str(levels[1])))
        cols = [str(levels[0]), str(levels[1])]
    else:
        pairs = [(c, o) for c in levels for o in levels if c != o]
        counts = long.groupBy("variable", F.col("value").alias("score"), "__y").agg(F.count(F.lit(1)).alias("n"))
        sel = counts.select("variable", "score", "n", F.explode(F.array(*[
            F.when((F.col("__y") == F.lit(c)) | (F.col("__y") == F.lit(o)),
                   F.struct(F.lit(c).alias("cls"), F.lit(o).alias("oth"), (F.col("__y") == F.lit(c)).cast("int").alias("y")))
            for c, o in pairs])).alias("s")).filter(F.col("s").isNotNull())
        cnt = sel.groupBy("variable", "s.cls", "s.oth", "score").agg(
            F.sum(F.col("n") * F.col("s.y")).alias("pos"), F.sum(F.col("n") * (1 - F.col("s.y"))).alias("neg"))
        cum = cumulative_by_score(cnt, ["variable", "cls", "oth"])
        a = cum.groupBy("variable", "cls", "oth").agg(
            (F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)) /
             (F.first("P").cast("double") * F.first("N").cast("double"))).alias("auc"))
        a = a.groupBy("variable").pivot("cls", [str(x) for x in levels]).agg(F.max("auc"))
        cols = [str(x) for x in levels]
    mm = a.agg(*[F.min(c).alias("mn_" + c) for c in cols], *[F.max(c).alias("mx_" + c) for c in cols]) \
        .collect()[0]
    out = [((F.col(c) - F.lit(mm["mn_" + c])) / F.lit((mm["mx_" + c] - mm["mn_" + c]) or 1.0) * 100).alias(c)
           for c in cols]
    return a.select("variable", *out)


def model_importance(spark, names: list[str], importances) -> DataFrame:
    """Importances scaled so the largest is 100."""
    vals = [float(v) for v in importances]
    mx = max(vals) if vals and max(vals) > 0 else 1.0
    return spark.createDataFrame([(n, v, v / mx * 100) for n, v in zip(names, vals)],
                                 "variable string, importance double, scaled double")


def compare_models(preds: DataFrame, model_col: str, real: str, pred: str, prob: str, positive,
                   order=("auc", "f1")) -> DataFrame:
    """One row per model: V3 metrics, kappa and AUC, ordered by
    ``order`` descending (NULLs last)."""
    c = _binary_counts(preds, real, pred, positive, [model_col])
    m = _binary_from_counts(c, keep=[model_col])
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("TP", "TN", "FP", "FN"))
    n = tp + tn + fp + fn
    po = (tp + tn) / n
    pe = ((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / (n * n)
    m = m.withColumn("kappa", _div(po - pe, 1 - pe))
    a = auc(preds, real, prob, positive, [model_col])
    out = m.join(a, model_col, "left")
    return out.orderBy(*[F.desc_nulls_last(o) for o in order])


def compare_models_multiclass(preds: DataFrame, model_col: str, real: str, pred: str, prob_cols: dict,
                              order=("auc", "accuracy")) -> DataFrame:
    """V17 above two classes, one row per model: accuracy, kappa, log loss, AUC
    averaged over all class pairs (each pair's rows only, both directions) and
    the classes' mean recall, specificity, precision and F1 (undefined ones left
    out), ordered by ``order`` descending.

    ``prob_cols`` maps each level to its probability column.  The pairs come from
    counts of distinct (model, level, score, class), not from rows.
    """
    levels = [str(c) for c in prob_cols]
    probs = F.create_map(*[x for c in levels for x in (F.lit(c), F.col(f"`{prob_cols[c]}`").cast("double"))])
    x = preds.select(F.col(model_col).alias("__m"), F.col(real).cast("string").alias("__r"), F.col(pred).cast("string").alias("__p"), probs.alias("__q"))
    bad = x.where(F.col("__r").isNull() | F.col("__p").isNull() | ~F.col("__r").isin(levels) | ~F.col("__p").isin(levels)
                  | F.exists(F.map_values("__q"), lambda v: v.isNull() | F.isnan(v))).limit(1).collect()
    if bad:
        raise ValueError("a real or predicted class is null or unknown, or a probability is null")
    own = F.least(F.greatest(F.col("__q")[F.col("__r")], F.lit(1e-15)), F.lit(1 - 1e-15))
    counts = x.groupBy("__m", "__r", "__p").agg(F.count(F.lit(1)).alias("n"), F.sum(-F.log(own)).alias("loss"))
    n_pred = counts.groupBy("__m", F.col("__p").alias("c")).agg(F.sum("n").alias("called"))
    n_real = counts.groupBy("__m", F.col("__r").alias("c")).agg(F.sum("n").alias("real"))
    hit = counts.where("__r = __p").select("__m", F.col("__r").alias("c"), F.col("n").alias("hit"))
    total = counts.groupBy("__m").agg(F.sum("n").alias("n"), F.sum("loss").alias("loss"))
    per = n_real.join(n_pred, ["__m", "c"], "full").join(hit, ["__m", "c"], "left").na.fill(0, ["real", "called", "hit"]).join(total, "__m")
    d = {c: F.col(c).cast("double") for c in ("real", "called", "hit", "n")}
    recall, precision = _div(d["hit"], d["real"]), _div(d["hit"], d["called"])
    specificity = _div(d["n"] - d["real"] - d["called"] + d["hit"], d["n"] - d["real"])
    f1 = _div(2 * d["hit"], d["real"] + d["called"])
    agree = F.sum(d["hit"]) / F.max(d["n"])
    chance = F.sum(d["real"] * d["called"]) / (F.max(d["n"]) * F.max(d["n"]))
    stats = per.groupBy("__m").agg(agree.alias("accuracy"), _div(agree - chance, 1 - chance).alias("kappa"), (F.max("loss") / F.max(d["n"])).alias("log_loss"),
                                   F.avg(recall).alias("mean_recall"), F.avg(specificity).alias("mean_specificity"), F.avg(precision).alias("mean_precision"), F.avg(f1).alias("mean_f1"))
    scored = x.select("__m", "__r", F.explode("__q").alias("level", "score")).groupBy("__m", "level", "score", "__r").agg(F.count(F.lit(1)).alias("n"))
    # every class but the level's own meets it once; the level's own rows go with each of them
    own_rows = scored.where("__r = level").select("__m", "level", "score", "n", F.explode(F.array_except(F.array(*[F.lit(c) for c in levels]), F.array("level"))).alias("other"), F.lit(1).alias("pos"))
    others = scored.where("__r <> level").select("__m", "level", "score", "n", F.col("__r").alias("other"), F.lit(0).alias("pos"))
    pairs = own_rows.unionByName(others).groupBy("__m", "level", "other", "score").agg(F.sum(F.col("n") * F.col("pos")).alias("pos"), F.sum(F.col("n") * (1 - F.col("pos"))).alias("neg"))
    cum = cumulative_by_score(pairs, ["__m", "level", "other"]).where("P > 0 AND N > 0")
    areas = cum.groupBy("__m", "level", "other").agg((F.sum(F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)) / (F.first("P").cast("double") * F.first("N").cast("double"))).alias("a"))
    out = stats.join(areas.groupBy("__m").agg(F.avg("a").alias("auc")), "__m", "left").withColumnRenamed("__m", model_col)
    return out.orderBy(*[F.desc_nulls_last(o) for o in order])


def roc_curves(preds: DataFrame, model_col: str, real: str, prob: str, positive) -> DataFrame:
    """V8 for several models at once (model as a group column)."""
    return roc_curve(preds, real, prob, positive, [model_col])


def prediction_table(df: DataFrame, key: str, real: str, prob_cols: dict) -> DataFrame:
    """Key, real, predicted (argmax, ties to the first level), one
    probability column per class, hit."""
    levels = list(prob_cols)
    best = F.greatest(*[F.struct(F.col(prob_cols[lv]).alias("p"), F.lit(-i).alias("o"), F.lit(lv).alias("c"))
                        for i, lv in enumerate(levels)]) if len(levels) > 1 else None
    pred = best["c"] if best is not None else F.lit(levels[0])
    return df.select(key, F.col(real).alias("real"), pred.alias("predicted"),
                     *[F.col(prob_cols[lv]).alias(f"prob_{lv}") for lv in levels]) \
        .withColumn("hit", F.col("real") == F.col("predicted"))
