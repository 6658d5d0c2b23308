"""Bench: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (total seconds), "unit", "queries"
(seconds per query), "rows_per_sec", "sf", "cores", "config"}.  Each query
is executed completely with the no-op sink (no collect), after one warm-up
query that pays the JVM / Python-worker start.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from vela.operators import classify, clean, cluster, evaluate, neighbors, profile, reduce, split  # noqa: E402
from vela.plans.checks_profile import flagship  # noqa: E402
from vela.plans.fixtures import scored_events, sparse_orders, t  # noqa: E402
from vela.session import local_session  # noqa: E402

LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def run(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="vela-bench")
    m = re.search(r"sf([0-9.]+)", sf)
    sfv = float(m.group(1)) if m else None

    li = t(spark, sf, "lineitem")
    orders = t(spark, sf, "orders")
    ev = scored_events(spark, sf).withColumn("real", F.when(F.col("label") == 1, "yes").otherwise("no"))
    emb = t(spark, sf, "embeddings")
    n_li, n_ord, n_ev, n_emb = li.count(), orders.count(), ev.count(), emb.count()

    def q_profile():
        run(profile.profile(li))

    def q_numeric_summary():
        run(profile.numeric_summary(li, LI_NUM))

    def q_quartiles():
        run(profile.quartile_summary(li, LI_NUM))

    def q_standardize():
        run(clean.standardize(li, LI_NUM))

    def q_impute():
        out, _ = clean.impute_median(sparse_orders(spark, sf), ["o_totalprice", "x_cust", "x_price7", "x_mod"])
        run(out)

    def q_nzv():
        run(clean.near_zero_variance(li, LI_NUM))

    def q_inject():
        run(clean.inject_nulls(orders.select("o_orderkey", "o_totalprice", "o_custkey"),
                               ["o_totalprice", "o_custkey"], 0.12, 42, "o_orderkey"))

    def q_split():
        flagged, _, _ = split.stratified_split(orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus",
                                               "o_orderkey")
        run(flagged)

    def q_folds():
        run(split.stratified_folds(orders.select("o_orderkey", "o_orderstatus"), "o_orderstatus",
                                   "o_orderkey", 5, 3))

    def q_pca():
        z = clean.standardize(li.select(*LI_NUM), LI_NUM)
        m_ = reduce.pca_fit(z, LI_NUM)
        run(m_.scores(z, 3))

    def q_lda():
        o = orders.select("o_orderkey", "o_orderstatus", "o_totalprice",
                          F.col("o_custkey").cast("double").alias("x_cust"))
        mdl = classify.fit_discriminant(o, ["o_totalprice", "x_cust"], "o_orderstatus", "lda")
        run(mdl.predict(o, keep=["o_orderkey"]))

    def q_roc():
        run(evaluate.roc_curve(ev, "real", "score", "yes"))

    def q_auc():
        run(evaluate.auc(ev, "real", "score", "yes"))

    def q_sweep():
        run(evaluate.threshold_sweep(ev, "real", "score", "yes"))

    def q_importance():
        run(evaluate.filter_importance(li, LI_NUM, "l_linestatus"))

    def q_silhouette():
        run(cluster.silhouette(emb, "vec_id", "embedding", "label"))

    def q_knn():
        run(neighbors.knn(emb, "vec_id", "embedding", 9))

    def q_kmeans():
        z = clean.standardize(li.select(*LI_NUM), LI_NUM)
        cluster.kmeans(z, LI_NUM, 3, nstart=2, seed=1)

    def q_flagship():
        run(flagship(spark, sf))

    plan = [("profile", q_profile, n_li), ("numeric_summary", q_numeric_summary, n_li),
            ("quartile_summary", q_quartiles, n_li), ("standardize", q_standardize, n_li),
            ("impute_median", q_impute, n_ord), ("near_zero_variance", q_nzv, n_li),
            ("inject_nulls", q_inject, n_ord), ("stratified_split", q_split, n_ord),
            ("stratified_folds", q_folds, n_ord), ("pca_scores", q_pca, n_li), ("lda_scores", q_lda, n_ord),
            ("roc_curve", q_roc, n_ev), ("auc", q_auc, n_ev), ("threshold_sweep", q_sweep, n_ev),
            ("filter_importance", q_importance, n_li), ("silhouette", q_silhouette, n_emb),
            ("knn", q_knn, n_emb), ("kmeans", q_kmeans, n_li), ("flagship", q_flagship, n_li)]
    run(li.select(F.sum("l_quantity")))  # warm-up
    times, rates = {}, {}
    for name, fn, rows in plan:
        t0 = time.time()
        fn()
        dt = time.time() - t0
        times[name] = round(dt, 3)
        rates[name] = round(rows / dt, 1) if dt > 0 else None
    print(json.dumps({"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "rows_per_sec": rates, "sf": sfv, "cores": cpus,
                      "config": {"spark.sql.shuffle.partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                                 "spark.sql.adaptive.enabled": spark.conf.get("spark.sql.adaptive.enabled")}}))
    spark.stop()


if __name__ == "__main__":
    main()
