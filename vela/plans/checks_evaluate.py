"""Checks for evaluation (V1-V18, H19) on fixed score columns."""
from __future__ import annotations

from pyspark.sql import functions as F

from vela.operators import evaluate as ev
from vela.plans.checks import R, check, finish
from vela.plans.fixtures import SCORED_EVENTS_SQL, scored_events, t

TYPES = ["click", "error", "purchase", "signup", "view"]


def binary_preds(spark, sf):
    s = scored_events(spark, sf)
    s = s.withColumn("real", F.when(F.col("label") == 1, F.lit("yes")).otherwise(F.lit("no")))
    return ev.classify_at(s, "score", 0.5, "yes", "no")


BIN_SQL = f"""(SELECT *, CASE WHEN label = 1 THEN 'yes' ELSE 'no' END AS real,
  CASE WHEN score >= 0.5 THEN 'yes' ELSE 'no' END AS predicted FROM {SCORED_EVENTS_SQL})"""


def multi_preds(spark, sf):
    e = t(spark, sf, "events")
    arr = F.array(*[F.lit(x) for x in TYPES])
    return e.select("event_id", F.col("event_type").alias("real"),
                    F.element_at(arr, (F.pmod("user_id", F.lit(5)) + 1).cast("int")).alias("predicted"))


MULTI_SQL = """(SELECT event_id, event_type AS real,
  ['click', 'error', 'purchase', 'signup', 'view'][user_id % 5 + 1] AS predicted FROM events)"""


@check("confusion_matrix", f"""
SELECT p.l AS prediction, r.l AS reference, coalesce(c.n, 0)::BIGINT AS freq
FROM (SELECT DISTINCT real AS l FROM {MULTI_SQL}) p CROSS JOIN (SELECT DISTINCT real AS l FROM {MULTI_SQL}) r
LEFT JOIN (SELECT predicted, real, count(*) n FROM {MULTI_SQL} GROUP BY ALL) c
  ON c.predicted = p.l AND c.real = r.l
""")
def q_confusion(spark, sf):
    m = multi_preds(spark, sf)
    return finish(ev.confusion_matrix(m, "predicted", "real"))


@check("overall_stats", f"""
WITH c AS (SELECT predicted, real, count(*)::DOUBLE n FROM {BIN_SQL} GROUP BY ALL),
tot AS (SELECT sum(n) n, sum(n) FILTER (WHERE predicted = real) ok FROM c),
rt AS (SELECT real l, sum(n) n FROM c GROUP BY 1), pt AS (SELECT predicted l, sum(n) n FROM c GROUP BY 1),
pe AS (SELECT sum(rt.n * pt.n) / (SELECT n * n FROM tot) pe FROM rt JOIN pt USING (l)),
bc AS (SELECT coalesce(sum(n) FILTER (WHERE predicted = 'no' AND real = 'yes'), 0) b,
              coalesce(sum(n) FILTER (WHERE predicted = 'yes' AND real = 'no'), 0) c FROM c)
SELECT {R('ok / n')} AS accuracy, {R('(SELECT max(n) FROM rt) / n')} AS nir,
       {R('(ok / n - pe) / (1 - pe)')} AS kappa, {R('(abs(b - c) - 1) ^ 2 / (b + c)')} AS mcnemar_stat
FROM tot, pe, bc
""")
def q_overall(spark, sf):
    b = binary_preds(spark, sf)
    s = ev.overall_stats(ev.confusion_matrix(b, "predicted", "real"))
    return finish(s.select("accuracy", "nir", "kappa", "mcnemar_stat"))


def _bin_metrics_sql(src: str, keep: str = "", group: str = "") -> str:
    k = f"{keep}, " if keep else ""
    g = f"GROUP BY {keep}" if keep else ""
    return f"""SELECT {k}TP::BIGINT TP, TN::BIGINT TN, FP::BIGINT FP, FN::BIGINT FN,
  {R('CASE WHEN TP+TN+FP+FN > 0 THEN (TP+TN)/(TP+TN+FP+FN) END')} AS accuracy,
  {R('CASE WHEN TP+FN > 0 THEN TP/(TP+FN) END')} AS recall,
  {R('CASE WHEN TN+FP > 0 THEN TN/(TN+FP) END')} AS specificity,
  {R('CASE WHEN TP+FP > 0 THEN TP/(TP+FP) END')} AS precision,
  {R('CASE WHEN TN+FN > 0 THEN TN/(TN+FN) END')} AS npv,
  {R('CASE WHEN 2*TP+FP+FN > 0 THEN 2*TP/(2*TP+FP+FN) END')} AS f1,
  {R('''CASE WHEN TP+FN > 0 AND TN+FP > 0 THEN (TP/(TP+FN) + TN/(TN+FP))/2
             WHEN TP+FN > 0 THEN TP/(TP+FN) WHEN TN+FP > 0 THEN TN/(TN+FP) END''')} AS balanced_accuracy
FROM (SELECT {k}sum((real = 'yes' AND predicted = 'yes')::INT)::DOUBLE TP,
             sum((real <> 'yes' AND predicted <> 'yes')::INT)::DOUBLE TN,
             sum((real <> 'yes' AND predicted = 'yes')::INT)::DOUBLE FP,
             sum((real = 'yes' AND predicted <> 'yes')::INT)::DOUBLE FN FROM {src} {g})"""


@check("binary_metrics", _bin_metrics_sql(BIN_SQL))
def q_binary_metrics(spark, sf):
    return finish(ev.binary_metrics(binary_preds(spark, sf), "real", "predicted", "yes"))


@check("binary_detail", f"""
SELECT {R("avg((real = 'yes')::INT)")} AS prevalence,
       {R("avg((real = 'yes' AND predicted = 'yes')::INT)")} AS detection_rate,
       {R("avg((predicted = 'yes')::INT)")} AS detection_prevalence
FROM {BIN_SQL}
""")
def q_binary_detail(spark, sf):
    return finish(ev.binary_detail(binary_preds(spark, sf), "real", "predicted", "yes"))


@check("class_metrics", f"""
WITH m AS {MULTI_SQL}, lv AS (SELECT DISTINCT real AS class FROM m),
c AS (SELECT class, sum((real = class AND predicted = class)::INT)::DOUBLE TP,
             sum((real <> class AND predicted <> class)::INT)::DOUBLE TN,
             sum((real <> class AND predicted = class)::INT)::DOUBLE FP,
             sum((real = class AND predicted <> class)::INT)::DOUBLE FN FROM m, lv GROUP BY class)
SELECT class, TP::BIGINT TP, TN::BIGINT TN, FP::BIGINT FP, FN::BIGINT FN,
  {R('(TP+TN)/(TP+TN+FP+FN)')} AS accuracy, {R('TP/(TP+FN)')} AS recall, {R('TN/(TN+FP)')} AS specificity,
  {R('CASE WHEN TP+FP > 0 THEN TP/(TP+FP) END')} AS precision, {R('TN/(TN+FN)')} AS npv,
  {R('2*TP/(2*TP+FP+FN)')} AS f1, {R('(TP/(TP+FN) + TN/(TN+FP))/2')} AS balanced_accuracy,
  {R('(TP+FN)/(TP+TN+FP+FN)')} AS prevalence, {R('TP/(TP+TN+FP+FN)')} AS detection_rate,
  {R('(TP+FP)/(TP+TN+FP+FN)')} AS detection_prevalence
FROM c
""")
def q_class_metrics(spark, sf):
    return finish(ev.class_metrics(multi_preds(spark, sf), "real", "predicted"))


@check("classify_at", f"""
SELECT event_id, CASE WHEN score >= 0.35 THEN 'yes' ELSE 'no' END AS predicted FROM {SCORED_EVENTS_SQL}
""")
def q_classify_at(spark, sf):
    s = scored_events(spark, sf)
    return finish(ev.classify_at(s, "score", 0.35, "yes", "no").select("event_id", "predicted"))


@check("threshold_sweep", f"""
WITH th AS (SELECT round(0.10 + 0.05 * i, 2)::DOUBLE AS threshold FROM range(17) t(i)),
p AS (SELECT threshold, real, CASE WHEN score >= threshold THEN 'yes' ELSE 'no' END AS predicted
      FROM {BIN_SQL}, th)
{_bin_metrics_sql('p', 'threshold')}
""")
def q_threshold_sweep(spark, sf):
    s = binary_preds(spark, sf)
    return finish(ev.threshold_sweep(s, "real", "score", "yes"))


CUM_SQL = f"""(SELECT score, pos, neg, sum(pos) OVER (ORDER BY score) cum_pos, sum(neg) OVER (ORDER BY score) cum_neg,
  lead(score) OVER (ORDER BY score) nxt, sum(pos) OVER () P, sum(neg) OVER () N
  FROM (SELECT score, sum(label)::DOUBLE pos, sum(1 - label)::DOUBLE neg FROM {SCORED_EVENTS_SQL} GROUP BY score))"""

ROC_SQL = f"""SELECT CASE WHEN nxt IS NULL THEN 'inf'::DOUBLE ELSE {R('(score + nxt) / 2')} END AS threshold,
  {R('(P - cum_pos) / P')} AS sensitivity, {R('cum_neg / N')} AS specificity FROM {CUM_SQL}
UNION ALL SELECT '-inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE"""


@check("roc_curve", ROC_SQL)
def q_roc(spark, sf):
    return finish(ev.roc_curve(binary_preds(spark, sf), "real", "score", "yes"))


@check("auc", f"""
SELECT {R('sum(pos * (cum_neg - 0.5 * neg)) / (max(P) * max(N))')} AS auc FROM {CUM_SQL}
""")
def q_auc(spark, sf):
    return finish(ev.auc(binary_preds(spark, sf), "real", "score", "yes"))


@check("best_threshold", f"""
WITH r AS (SELECT CASE WHEN nxt IS NULL THEN 'inf'::DOUBLE ELSE (score + nxt) / 2 END AS threshold,
                  (P - cum_pos) / P AS sensitivity, cum_neg / N AS specificity FROM {CUM_SQL}
           UNION ALL SELECT '-inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE),
y AS (SELECT *, sensitivity + specificity - 1 AS youden FROM r)
SELECT {R('threshold')} AS threshold, {R('sensitivity')} AS sensitivity, {R('specificity')} AS specificity,
       {R('youden')} AS youden
FROM y WHERE youden >= (SELECT max(youden) FROM y) - 1e-12
""")
def q_best_threshold(spark, sf):
    roc = ev.roc_curve(binary_preds(spark, sf), "real", "score", "yes")
    return finish(ev.best_threshold(roc))


@check("pr_curve", f"""
SELECT {R('score')} AS threshold, {R('(P - cum_pos + pos) / P')} AS recall,
       {R('(P - cum_pos + pos) / ((P - cum_pos + pos) + (N - cum_neg + neg))')} AS precision
FROM {CUM_SQL}
""")
def q_pr_curve(spark, sf):
    return finish(ev.pr_curve(binary_preds(spark, sf), "real", "score", "yes"))


@check("pr_auc_value", f"""
WITH c AS (SELECT *, P - cum_pos AS tp_a, N - cum_neg AS fp_a FROM {CUM_SQL}),
s AS (SELECT pos, tp_a::DOUBLE AS A, (tp_a + fp_a)::DOUBLE AS B, 1 + neg / pos AS k, P FROM c WHERE pos > 0)
SELECT {R("sum(CASE WHEN B > 0 THEN pos / k + (A - B / k) * (ln(B + k * pos) - ln(B)) / k ELSE pos / k END) / max(P)")}
       AS pr_auc
FROM s
""")
def q_pr_auc_value(spark, sf):
    return finish(ev.pr_auc(binary_preds(spark, sf), "real", "score", "yes"))


REG_SQL = "(SELECT p_partkey, p_retailprice AS real, 900.0 + p_size * 10.0 AS pred FROM part)"


def reg_table(spark, sf):
    p = t(spark, sf, "part")
    return p.select("p_partkey", F.col("p_retailprice").alias("real"),
                    (F.lit(900.0) + F.col("p_size") * 10.0).alias("pred"))


@check("regression_metrics", f"""
SELECT {R('avg(abs(real - pred))')} AS mae, {R('avg((real - pred) ^ 2)')} AS mse,
       {R('sqrt(avg((real - pred) ^ 2))')} AS rmse,
       {R('1 - sum((real - pred) ^ 2) / sum((real - (SELECT avg(real) FROM ' + REG_SQL + ')) ^ 2)')} AS r2
FROM {REG_SQL}
""")
def q_regression(spark, sf):
    return finish(ev.regression_metrics(reg_table(spark, sf), "real", "pred"))


@check("residual_table", f"""
SELECT p_partkey, {R('real')} AS real, {R('pred')} AS predicted, {R('real - pred')} AS residual FROM {REG_SQL}
""")
def q_residuals(spark, sf):
    return finish(ev.residual_table(reg_table(spark, sf), "real", "pred", keep=["p_partkey"]))


def loss_input(spark, sf):
    s = scored_events(spark, sf)
    onehot = F.array(*[(F.col("event_type") == F.lit(x)).cast("int") for x in TYPES])
    probs = F.array(*[F.lit(v) for v in (0.1, 0.2, 0.3, 0.25, 0.15)])
    return s.select("value", (F.col("value") * 0.9 + 1.0).alias("pred"), "label", "score",
                    onehot.alias("onehot"), probs.alias("probs"))


@check("loss_table", f"""
SELECT {R('avg((value - (value * 0.9 + 1.0)) ^ 2)')} AS mse, {R('avg(abs(value - (value * 0.9 + 1.0)))')} AS mae,
  {R('-avg(label * ln(least(greatest(score, 1e-7), 1 - 1e-7)) + (1 - label) * ln(1 - least(greatest(score, 1e-7), 1 - 1e-7)))')}
    AS binary_cross_entropy,
  {R('''-avg(CASE event_type WHEN 'click' THEN ln(0.1) WHEN 'error' THEN ln(0.2) WHEN 'purchase' THEN ln(0.3)
                            WHEN 'signup' THEN ln(0.25) ELSE ln(0.15) END)''')} AS categorical_cross_entropy
FROM {SCORED_EVENTS_SQL}
""")
def q_loss(spark, sf):
    return finish(ev.loss_table(loss_input(spark, sf), "value", "pred", "label", "score", "onehot", "probs"))


LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _auc_sql(src: str, groups: str) -> str:
    """AUC per group from (groups..., v, y boolean)."""
    return f"""(SELECT {groups}, sum(pos * (cum_neg - 0.5 * neg)) / (max(P) * max(N)) AS auc FROM (
  SELECT {groups}, pos, neg, sum(neg) OVER (PARTITION BY {groups} ORDER BY v) cum_neg,
         sum(pos) OVER (PARTITION BY {groups}) P, sum(neg) OVER (PARTITION BY {groups}) N
  FROM (SELECT {groups}, v, sum(y::INT)::DOUBLE pos, sum((NOT y)::INT)::DOUBLE neg FROM {src} GROUP BY ALL))
  GROUP BY {groups})"""


LI_LONG_SQL = """(SELECT l_linestatus, l_returnflag, unnest(['l_quantity','l_extendedprice','l_discount','l_tax']) AS variable,
   unnest([l_quantity, l_extendedprice, l_discount, l_tax]) AS v FROM lineitem)"""


@check("filter_importance", f"""
WITH a AS (SELECT variable, greatest(auc, 1 - auc) imp FROM
  {_auc_sql("(SELECT variable, v, l_linestatus = 'F' AS y FROM " + LI_LONG_SQL + ")", 'variable')}),
m AS (SELECT min(imp) mn, max(imp) mx FROM a)
SELECT variable, {R('(imp - mn) / (mx - mn) * 100')} AS "F", {R('(imp - mn) / (mx - mn) * 100')} AS "O"
FROM a, m
""")
def q_filter_importance(spark, sf):
    li = t(spark, sf, "lineitem")
    return finish(ev.filter_importance(li, LI_NUM, "l_linestatus"))


@check("filter_importance_multiclass", f"""
WITH lv AS (SELECT DISTINCT l_returnflag AS c FROM lineitem),
pairs AS (SELECT a.c AS cls, b.c AS oth FROM lv a, lv b WHERE a.c <> b.c),
x AS (SELECT variable, cls, oth, v, l_returnflag = cls AS y FROM {LI_LONG_SQL} JOIN pairs
      ON l_returnflag = cls OR l_returnflag = oth),
a AS (SELECT variable, cls, max(auc) auc FROM {_auc_sql('x', 'variable, cls, oth')} GROUP BY variable, cls),
s AS (SELECT variable, cls, (auc - min(auc) OVER (PARTITION BY cls)) /
        (max(auc) OVER (PARTITION BY cls) - min(auc) OVER (PARTITION BY cls)) * 100 AS sc FROM a)
SELECT variable, {R("max(sc) FILTER (WHERE cls = 'A')")} AS "A", {R("max(sc) FILTER (WHERE cls = 'N')")} AS "N",
       {R("max(sc) FILTER (WHERE cls = 'R')")} AS "R"
FROM s GROUP BY variable
""")
def q_filter_importance_multi(spark, sf):
    li = t(spark, sf, "lineitem")
    return finish(ev.filter_importance(li, LI_NUM, "l_returnflag"))


def two_models(spark, sf):
    b = binary_preds(spark, sf)
    m1 = b.select(F.lit("m1").alias("model"), "event_id", "real", "score")
    m2 = b.select(F.lit("m2").alias("model"), "event_id", "real",
                  ((F.pmod("event_id", F.lit(10)) / 10.0 + F.col("score")) / 2).alias("score"))
    both = m1.unionByName(m2)
    return ev.classify_at(both, "score", 0.5, "yes", "no")


TWO_SQL = f"""(SELECT model, event_id, real, score, CASE WHEN score >= 0.5 THEN 'yes' ELSE 'no' END AS predicted FROM (
  SELECT 'm1' AS model, event_id, real, score FROM {BIN_SQL}
  UNION ALL SELECT 'm2', event_id, real, ((event_id % 10) / 10.0 + score) / 2 FROM {BIN_SQL}))"""


THREE = ["A", "N", "R"]


def three_class(spark, sf):
    """Two made-up three-class scorers of the return flag: shares of positive weights per class."""
    li = t(spark, sf, "lineitem")
    out = []
    for m, step in (("m1", 7), ("m2", 13)):
        w = [F.pmod(F.col("l_orderkey") * step + F.col("l_linenumber") * (3 + i), F.lit(11)) + 1 + F.when(F.col("l_returnflag") == c, 2 * i + 3).otherwise(0) for i, c in enumerate(THREE)]
        x = li.select(F.lit(m).alias("model"), F.col("l_returnflag").alias("real"), *[v.cast("double").alias(f"w{c}") for c, v in zip(THREE, w)])
        total = F.col("wA") + F.col("wN") + F.col("wR")
        out.append(x.select("model", "real", *[(F.col(f"w{c}") / total).alias(f"prob_{c}") for c in THREE]))
    x = out[0].unionByName(out[1])
    best = F.greatest("prob_A", "prob_N", "prob_R")
    return x.withColumn("predicted", F.when(F.col("prob_A") == best, "A").when(F.col("prob_N") == best, "N").otherwise("R"))


def _three_sql():
    one = " UNION ALL ".join(f"""SELECT '{m}' AS model, l_returnflag AS real,
        {", ".join(f"(l_orderkey * {step} + l_linenumber * {3 + i}) % 11 + 1 + CASE WHEN l_returnflag = '{c}' THEN {2 * i + 3} ELSE 0 END::DOUBLE AS w{c}" for i, c in enumerate(THREE))} FROM lineitem""" for m, step in (("m1", 7), ("m2", 13)))
    pairs = " UNION ALL ".join(f"""SELECT model, '{a}' AS a, '{b}' AS b, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS area FROM (
        SELECT model, s, pos, neg, sum(neg) OVER (PARTITION BY model ORDER BY s) - neg AS below FROM (
          SELECT model, prob_{a} AS s, sum((real = '{a}')::INT)::DOUBLE AS pos, sum((real = '{b}')::INT)::DOUBLE AS neg FROM p WHERE real IN ('{a}', '{b}') GROUP BY ALL)) GROUP BY model"""
                               for a in THREE for b in THREE if a != b)
    return f"""
WITH w AS ({one}),
q AS (SELECT model, real, {", ".join(f"w{c} / (wA + wN + wR) AS prob_{c}" for c in THREE)} FROM w),
p AS (SELECT *, CASE WHEN prob_A = greatest(prob_A, prob_N, prob_R) THEN 'A' WHEN prob_N = greatest(prob_A, prob_N, prob_R) THEN 'N' ELSE 'R' END AS predicted FROM q),
areas AS ({pairs}),
au AS (SELECT model, avg(area) AS auc FROM areas GROUP BY model),
tot AS (SELECT model, count(*)::DOUBLE AS n, avg((real = predicted)::INT) AS accuracy, avg(-ln(CASE real WHEN 'A' THEN prob_A WHEN 'N' THEN prob_N ELSE prob_R END)) AS log_loss FROM p GROUP BY model),
cls AS (SELECT model, c, sum((real = c)::INT)::DOUBLE AS re, sum((predicted = c)::INT)::DOUBLE AS ca, sum((real = c AND predicted = c)::INT)::DOUBLE AS hit FROM p, (SELECT unnest(['A', 'N', 'R']) AS c) GROUP BY ALL),
st AS (SELECT model, sum(re * ca) / (max(n) * max(n)) AS chance, avg(hit / nullif(re, 0)) AS mr, avg((n - re - ca + hit) / nullif(n - re, 0)) AS ms, avg(hit / nullif(ca, 0)) AS mp, avg(2 * hit / nullif(re + ca, 0)) AS mf
       FROM cls JOIN tot USING (model) GROUP BY model)
SELECT model, {R('accuracy')} AS accuracy, {R('(accuracy - chance) / (1 - chance)')} AS kappa, {R('log_loss')} AS log_loss, {R('mr')} AS mean_recall, {R('ms')} AS mean_specificity,
       {R('mp')} AS mean_precision, {R('mf')} AS mean_f1, {R('auc')} AS auc FROM tot JOIN st USING (model) JOIN au USING (model)
"""


@check("compare_models_multiclass", _three_sql())
def q_compare_multiclass(spark, sf):
    return finish(ev.compare_models_multiclass(three_class(spark, sf), "model", "real", "predicted", {c: f"prob_{c}" for c in THREE}))


@check("compare_models", f"""
WITH m AS ({_bin_metrics_sql(TWO_SQL, 'model')}),
k AS (SELECT model, {R('''((TP+TN)/(TP+TN+FP+FN) - ((TP+FP)*(TP+FN) + (TN+FN)*(TN+FP)) / ((TP+TN+FP+FN)^2))
       / (1 - ((TP+FP)*(TP+FN) + (TN+FN)*(TN+FP)) / ((TP+TN+FP+FN)^2))''')} AS kappa
      FROM (SELECT model, sum((real = 'yes' AND predicted = 'yes')::INT)::DOUBLE TP,
             sum((real <> 'yes' AND predicted <> 'yes')::INT)::DOUBLE TN,
             sum((real <> 'yes' AND predicted = 'yes')::INT)::DOUBLE FP,
             sum((real = 'yes' AND predicted <> 'yes')::INT)::DOUBLE FN FROM {TWO_SQL} GROUP BY model)),
a AS (SELECT model, {R('auc')} AS auc FROM {_auc_sql("(SELECT model, score AS v, real = 'yes' AS y FROM " + TWO_SQL + ")", 'model')})
SELECT * FROM m JOIN k USING (model) JOIN a USING (model)
""")
def q_compare_models(spark, sf):
    return finish(ev.compare_models(two_models(spark, sf), "model", "real", "predicted", "score", "yes"))


@check("roc_curves", f"""
WITH c AS (SELECT model, score, sum((real = 'yes')::INT)::DOUBLE pos, sum((real <> 'yes')::INT)::DOUBLE neg
           FROM {TWO_SQL} GROUP BY ALL),
w AS (SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score) cum_pos,
             sum(neg) OVER (PARTITION BY model ORDER BY score) cum_neg,
             lead(score) OVER (PARTITION BY model ORDER BY score) nxt,
             sum(pos) OVER (PARTITION BY model) P, sum(neg) OVER (PARTITION BY model) N FROM c)
SELECT model, CASE WHEN nxt IS NULL THEN 'inf'::DOUBLE ELSE {R('(score + nxt) / 2')} END AS threshold,
       {R('(P - cum_pos) / P')} AS sensitivity, {R('cum_neg / N')} AS specificity FROM w
UNION ALL SELECT DISTINCT model, '-inf'::DOUBLE, 1.0::DOUBLE, 0.0::DOUBLE FROM c
""")
def q_roc_curves(spark, sf):
    return finish(ev.roc_curves(two_models(spark, sf), "model", "real", "score", "yes"))


@check("prediction_table", f"""
SELECT event_id, real, CASE WHEN score >= 1 - score THEN 'yes' ELSE 'no' END AS predicted,
       {R('score')} AS prob_yes, {R('1 - score')} AS prob_no,
       real = (CASE WHEN score >= 1 - score THEN 'yes' ELSE 'no' END) AS hit
FROM {BIN_SQL}
""")
def q_prediction_table(spark, sf):
    b = binary_preds(spark, sf).withColumn("p_no", 1 - F.col("score"))
    return finish(ev.prediction_table(b, "event_id", "real", {"yes": "score", "no": "p_no"}))
