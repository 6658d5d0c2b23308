"""Checks for reduction, clustering, neighbours and closed-form classifiers."""
from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vela.operators import classify, clean, cluster, neighbors, reduce
from vela.plans.checks import R, check, finish
from vela.plans.fixtures import t

EMB_SQL = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
PAIR2 = ["l_quantity", "l_discount"]


def emb(spark, sf):
    return t(spark, sf, "embeddings")


# ---------------------------------------------------------------- PCA / MDS

def _z2(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *PAIR2)
    return clean.standardize(li, PAIR2)


CORR = "(SELECT corr(l_quantity, l_discount) AS r, count(*) AS n FROM lineitem)"


@check("pca_variance", f"""
SELECT 'PC' || k::VARCHAR AS component, {R('ev')} AS eigenvalue, {R('ev / 2')} AS share,
       {R('ev / 2 * 100')} AS pct, {R('cum / 2 * 100')} AS cum_pct
FROM (SELECT 1 AS k, 1 + abs(r) AS ev, 1 + abs(r) AS cum FROM {CORR}
      UNION ALL SELECT 2, 1 - abs(r), 2.0 FROM {CORR})
""")
def q_pca_variance(spark, sf):
    z = _z2(spark, sf)
    return finish(reduce.pca_fit(z, PAIR2).variance(spark))


@check("pca_scores", f"""
WITH z AS (SELECT l_orderkey, l_linenumber,
             (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS z1,
             (l_discount - avg(l_discount) OVER ()) / stddev_samp(l_discount) OVER () AS z2 FROM lineitem)
SELECT l_orderkey, l_linenumber, {R('(z1 + sign(r) * z2) / sqrt(2)')} AS PC1,
       {R('(z1 - sign(r) * z2) / sqrt(2)')} AS PC2
FROM z, {CORR}
""")
def q_pca_scores(spark, sf):
    z = _z2(spark, sf)
    m = reduce.pca_fit(z, PAIR2)
    return finish(m.scores(z, 2, keep=["l_orderkey", "l_linenumber"]))


@check("pca_axis_labels", f"""
SELECT 'PC' || k::VARCHAR AS component, 'PC' || k::VARCHAR || ' (' || printf('%.2f', ev / 2 * 100) || '%)' AS axis_label
FROM (SELECT 1 AS k, 1 + abs(r) AS ev FROM {CORR} UNION ALL SELECT 2, 1 - abs(r) FROM {CORR})
""")
def q_pca_axis_labels(spark, sf):
    v = reduce.pca_fit(_z2(spark, sf), PAIR2).variance(spark)
    return clean.axis_labels(v).select("component", "axis_label")


@check("pca_n_components", f"""
SELECT (CASE WHEN (1 + abs(r)) / 2 >= 0.6 THEN 1 ELSE 2 END)::BIGINT AS n_components FROM {CORR}
""")
def q_pca_n(spark, sf):
    m = reduce.pca_fit(_z2(spark, sf), PAIR2)
    return spark.createDataFrame([(m.n_components(0.6),)], "n_components long")


@check("mds_eigenvalues", f"""
SELECT k::BIGINT AS dimension, {R('(n - 1) * ev')} AS eigenvalue, {R('ev / 2 * 100')} AS pct,
       {R('cum / 2 * 100')} AS cum_pct
FROM (SELECT 1 AS k, 1 + abs(r) AS ev, 1 + abs(r) AS cum, n FROM {CORR}
      UNION ALL SELECT 2, 1 - abs(r), 2.0, n FROM {CORR})
""")
def q_mds(spark, sf):
    z = _z2(spark, sf)
    return finish(reduce.mds_euclidean(z, PAIR2).eigen_table(spark))


# ---------------------------------------------------------------- clustering

@check("cluster_variance", f"""
WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings),
g AS (SELECT i, avg(v) gm FROM x GROUP BY i),
c AS (SELECT label, i, count(*) n, avg(v) m, sum(v * v) s FROM x GROUP BY ALL),
per AS (SELECT label AS cluster, max(n)::BIGINT AS size, sum(s - n * m * m) AS within_ss,
               sum(n * (m - gm) * (m - gm)) AS bp FROM c JOIN g USING (i) GROUP BY label)
SELECT cluster::BIGINT AS cluster, size, {R('within_ss')} AS within_ss,
       {R('(SELECT sum(within_ss) + sum(bp) FROM per)')} AS total_ss,
       {R('(SELECT sum(bp) / (sum(within_ss) + sum(bp)) FROM per)')} AS between_share
FROM per
""")
def q_cluster_variance(spark, sf):
    return finish(cluster.cluster_variance(emb(spark, sf), "embedding", "label"))


SIL_SQL = f"""(WITH e AS {EMB_SQL},
d AS (SELECT a.vec_id, a.label AS own, b.label AS c, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.vec_id <> b.vec_id),
m AS (SELECT vec_id, own, c, avg(dist) AS md FROM d GROUP BY ALL),
ab AS (SELECT vec_id, own, max(md) FILTER (WHERE c = own) AS a,
              min({{'m': md, 'c': c}}) FILTER (WHERE c <> own) AS nb FROM m GROUP BY ALL)
SELECT vec_id, own AS cluster, nb.c AS neighbor,
       CASE WHEN a IS NULL THEN 0.0 ELSE (nb.m - a) / greatest(a, nb.m) END AS sil_width FROM ab)"""


@check("silhouette_rows", f"""
SELECT vec_id, cluster::BIGINT AS cluster, neighbor::BIGINT AS neighbor, {R('sil_width')} AS sil_width
FROM {SIL_SQL}
""")
def q_silhouette_rows(spark, sf):
    return finish(cluster.silhouette(emb(spark, sf), "vec_id", "embedding", "label"))


@check("silhouette_mean", f"SELECT {R('avg(sil_width)')} AS mean_silhouette FROM {SIL_SQL}")
def q_silhouette_mean(spark, sf):
    s = cluster.silhouette(emb(spark, sf), "vec_id", "embedding", "label")
    return finish(s.agg(F.avg("sil_width").alias("mean_silhouette")))


@check("silhouette_band", f"""
SELECT cluster::BIGINT AS cluster, {R('avg(sil_width)')} AS mean_silhouette,
  CASE WHEN avg(sil_width) >= 0.70 THEN 'strong' WHEN avg(sil_width) >= 0.50 THEN 'fair'
       WHEN avg(sil_width) >= 0.25 THEN 'weak' ELSE 'none' END AS band
FROM {SIL_SQL} GROUP BY cluster
""")
def q_silhouette_band(spark, sf):
    s = cluster.silhouette(emb(spark, sf), "vec_id", "embedding", "label")
    per = s.groupBy("cluster").agg(F.avg("sil_width").alias("mean_silhouette"))
    return finish(per.withColumn("band", cluster.silhouette_band("mean_silhouette")))


CENTROIDS_SQL = """(SELECT label, list(m ORDER BY i) AS cv FROM (
   SELECT label, i, avg(v) AS m FROM (SELECT label, generate_subscripts(embedding, 1) AS i,
     unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY ALL) GROUP BY label)"""


@check("lloyd_step", f"""
SELECT e.vec_id, min({{'d': list_distance(e.v, c.cv), 'c': c.label}}).c::BIGINT AS cluster
FROM {EMB_SQL} e, {CENTROIDS_SQL} c GROUP BY e.vec_id
""")
def q_lloyd(spark, sf):
    e = emb(spark, sf)
    cent = e.select("label", "embedding").groupBy("label").agg(
        *[F.avg(F.col("embedding")[i].cast("double")).alias(f"m{i}") for i in range(64)]).orderBy("label")
    rows = cent.collect()
    centers = np.array([[r[f"m{i}"] for i in range(64)] for r in rows])
    labels = [r["label"] for r in rows]
    out = cluster.lloyd_step(e, "embedding", centers, "__c")
    m = F.create_map(*[x for j, lb in enumerate(labels) for x in (F.lit(j + 1), F.lit(lb))])
    return finish(out.select("vec_id", m[F.col("__c")].alias("cluster")))


@check("kmeans_assign")
def q_kmeans_assign(spark, sf):
    e = emb(spark, sf)
    km = cluster.kmeans(e, "embedding", k=10, nstart=2, seed=7)
    return km.assign(e, "embedding", keep=["vec_id"])


@check("elbow")
def q_elbow(spark, sf):
    z = clean.standardize(t(spark, sf, "lineitem").select(*PAIR2), PAIR2)
    return cluster.elbow(z, PAIR2, nstart=20, max_iter=100)


@check("wss_total", f"""
SELECT {R('(count(*) - 1) * 2.0')} AS wss FROM lineitem
""")
def q_wss_total(spark, sf):
    z = clean.standardize(t(spark, sf, "lineitem").select(*PAIR2), PAIR2)
    return finish(cluster.elbow(z, PAIR2, ks=[1]).select("wss"))


# ---------------------------------------------------------------- neighbours

PAIRS_SQL = f"""(SELECT a.vec_id AS i, b.vec_id AS j, list_distance(a.v, b.v) AS dist
   FROM {EMB_SQL} a JOIN {EMB_SQL} b ON a.vec_id <> b.vec_id)"""


@check("pairwise_distance", f"""
SELECT i AS vec_id_i, j AS vec_id_j, {R('dist')} AS dist FROM {PAIRS_SQL} WHERE i < j
""")
def q_pairwise(spark, sf):
    return finish(neighbors.pairwise_distance(emb(spark, sf), "vec_id", "embedding"))


KNN_SQL = f"""(SELECT i, j, dist, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS rk FROM {PAIRS_SQL})"""


@check("knn", f"""
SELECT i AS vec_id, j AS neighbor, {R('dist')} AS dist, rk::BIGINT AS rank FROM {KNN_SQL} WHERE rk <= 9
""")
def q_knn(spark, sf):
    return finish(neighbors.knn(emb(spark, sf), "vec_id", "embedding", 9))


def text_emb(spark, sf):
    e = emb(spark, sf)
    return e.withColumn("vec_id", F.concat(F.lit("ID_"), F.col("vec_id").cast("string")))


@check("knn_text_key", f"""
SELECT i AS vec_id, j AS neighbor, {R('dist')} AS dist, rk::BIGINT AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY dist, j) AS rk FROM (
    SELECT 'ID_' || i::VARCHAR AS i, 'ID_' || j::VARCHAR AS j, dist FROM {PAIRS_SQL})) WHERE rk <= 9
""")
def q_knn_text(spark, sf):
    return finish(neighbors.knn(text_emb(spark, sf), "vec_id", "embedding", 9))


@check("silhouette_text_key", f"""
SELECT 'ID_' || vec_id::VARCHAR AS vec_id, cluster::BIGINT AS cluster, neighbor::BIGINT AS neighbor, {R('sil_width')} AS sil_width
FROM {SIL_SQL}
""")
def q_silhouette_text(spark, sf):
    return finish(cluster.silhouette(text_emb(spark, sf), "vec_id", "embedding", "label"))


@check("knn_distance_quantile", f"""
SELECT {R('quantile_cont(dist, 0.9)')} AS eps FROM {KNN_SQL} WHERE rk = 9
""")
def q_knn_q(spark, sf):
    return finish(neighbors.knn_distance_quantile(emb(spark, sf), "vec_id", "embedding", 9, 0.9))


def _knn_vote_sql():
    probs = ", ".join(f"{R(f'count(*) FILTER (WHERE lb = {c}) / 9.0')} AS prob_{c}" for c in range(10))
    return f"""
WITH v AS (SELECT k.i AS vec_id, e.label AS lb FROM {KNN_SQL} k JOIN embeddings e ON e.vec_id = k.j WHERE k.rk <= 9),
p AS (SELECT vec_id, lb, count(*) AS c FROM v GROUP BY ALL),
best AS (SELECT vec_id, arg_max(lb, c * 100 - lb)::VARCHAR AS predicted FROM p GROUP BY vec_id)
SELECT v.vec_id, {probs}, max(best.predicted) AS predicted FROM v JOIN best USING (vec_id) GROUP BY v.vec_id"""


@check("knn_classify", _knn_vote_sql())
def q_knn_classify(spark, sf):
    return finish(classify.knn_classify(emb(spark, sf), "vec_id", "embedding", "label", 9))


# ---------------------------------------------------------------- discriminants

ORD2 = """(SELECT o_orderkey, o_orderstatus AS y, o_totalprice AS x1, o_custkey::DOUBLE AS x2 FROM orders)"""
ORD_PAIR = ["o_totalprice", "x_cust"]
CLASSES = ["F", "O", "P"]


def _da_sql(kind: str) -> str:
    if kind == "lda":
        cov = """, w AS (SELECT sum((x1-m1)*(x1-m1)) / (max(ntot) - max(k)) a, sum((x1-m1)*(x2-m2)) / (max(ntot) - max(k)) b,
                        sum((x2-m2)*(x2-m2)) / (max(ntot) - max(k)) c FROM d JOIN g USING (y), tot),
        cv AS (SELECT g.y, w.a, w.b, w.c FROM g, w)"""
    else:
        cov = """, cv AS (SELECT y, sum((x1-m1)*(x1-m1)) / (max(n) - 1) a, sum((x1-m1)*(x2-m2)) / (max(n) - 1) b,
                        sum((x2-m2)*(x2-m2)) / (max(n) - 1) c FROM d JOIN g USING (y) GROUP BY y)"""
    if kind == "nb":
        delta = """ln(g.n / tot.ntot) - ln(sqrt(cv.a)) - ln(sqrt(cv.c)) - ln(2 * pi())
                 - 0.5 * ((d.x1 - g.m1) ^ 2 / cv.a + (d.x2 - g.m2) ^ 2 / cv.c)"""
    else:
        logdet = "0.0" if kind == "lda" else "ln(cv.a * cv.c - cv.b * cv.b)"
        delta = f"""ln(g.n / tot.ntot) - 0.5 * {logdet} - 0.5 * (
                 (cv.c * (d.x1 - g.m1) ^ 2 - 2 * cv.b * (d.x1 - g.m1) * (d.x2 - g.m2) + cv.a * (d.x2 - g.m2) ^ 2)
                 / (cv.a * cv.c - cv.b * cv.b))"""
    probs = ", ".join(f"{R(f'max(prob) FILTER (WHERE cls = {chr(39)}{c}{chr(39)})')} AS prob_{c}" for c in CLASSES)
    return f"""
WITH d AS {ORD2}, g AS (SELECT y, count(*)::DOUBLE n, avg(x1) m1, avg(x2) m2 FROM d GROUP BY y),
tot AS (SELECT sum(n) ntot, count(*) k FROM g) {cov},
s AS (SELECT d.o_orderkey, d.y AS real, g.y AS cls, {delta} AS delta
      FROM d, g JOIN cv USING (y), tot),
s2 AS (SELECT *, exp(delta - max(delta) OVER (PARTITION BY o_orderkey)) AS ex FROM s),
p AS (SELECT *, ex / sum(ex) OVER (PARTITION BY o_orderkey) AS prob FROM s2)
SELECT o_orderkey, max(real) AS o_orderstatus, {probs},
       arg_max(cls, prob * 4 - (CASE cls WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END) * 1e-12) AS predicted
FROM p GROUP BY o_orderkey"""


def _ord_pair(spark, sf):
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_custkey").cast("double").alias("x_cust"))


@check("lda_scores", _da_sql("lda"))
def q_lda(spark, sf):
    o = _ord_pair(spark, sf)
    m = classify.fit_discriminant(o, ORD_PAIR, "o_orderstatus", "lda")
    return finish(m.predict(o, keep=["o_orderkey", "o_orderstatus"]))


@check("qda_scores", _da_sql("qda"))
def q_qda(spark, sf):
    o = _ord_pair(spark, sf)
    m = classify.fit_discriminant(o, ORD_PAIR, "o_orderstatus", "qda")
    return finish(m.predict(o, keep=["o_orderkey", "o_orderstatus"]))


@check("naive_bayes", _da_sql("nb"))
def q_nb(spark, sf):
    o = _ord_pair(spark, sf)
    m = classify.fit_naive_bayes(o, ORD_PAIR, "o_orderstatus")
    return finish(m.predict(o, keep=["o_orderkey", "o_orderstatus"]))


def _li_pair(spark, sf):
    return t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", *PAIR2)


@check("rda_lda_limit", _da_sql("lda"))
def q_rda_limit(spark, sf):
    """RDA with lambda = 1, gamma = 0 is LDA: same probabilities."""
    o = _ord_pair(spark, sf)
    m = classify.fit_discriminant(o, ORD_PAIR, "o_orderstatus", "rda", gamma=0.0, lam=1.0)
    return finish(m.predict(o, keep=["o_orderkey", "o_orderstatus"]))


@check("fda_degree1", _da_sql("lda"))
def q_fda_degree1(spark, sf):
    """FDA on the degree-1 basis is LDA on the same features."""
    o = _ord_pair(spark, sf)
    m = classify.fit_fda(o, ORD_PAIR, "o_orderstatus", degree=1)
    return finish(m.predict(o, keep=["o_orderkey", "o_orderstatus"]))


@check("rda")
def q_rda(spark, sf):
    li = _li_pair(spark, sf)
    m = classify.fit_discriminant(li, PAIR2, "l_linestatus", "rda", gamma=0.1, lam=0.5)
    return finish(m.predict(li, keep=["l_orderkey", "l_linenumber", "l_linestatus"]))


@check("fda")
def q_fda(spark, sf):
    li = _li_pair(spark, sf)
    m = classify.fit_fda(li, PAIR2, "l_linestatus", degree=2)
    return finish(m.predict(li, keep=["l_orderkey", "l_linenumber", "l_linestatus"]))


# Fixed weights for the dense-layer check (a parameter, not data).
DENSE_W = np.array([[0.02, 0.00001, -3.0, 4.0], [-0.05, 0.00002, 5.0, -2.0], [0.01, -0.00001, 1.0, 1.0]])
DENSE_B = np.array([0.1, -0.2, 0.05])
LI_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _dense_sql(act: str) -> str:
    zs = []
    for j in range(3):
        terms = " + ".join(f"({float(DENSE_W[j, i])!r}) * {c}" for i, c in enumerate(LI_NUM))
        zs.append(f"({float(DENSE_B[j])!r} + {terms})")
    if act == "relu":
        sel = ", ".join(f"{R(f'greatest({z}, 0.0)')} AS z{j + 1}" for j, z in enumerate(zs))
        return f"SELECT l_orderkey, l_linenumber, {sel} FROM lineitem"
    m = f"greatest({', '.join(zs)})"
    den = " + ".join(f"exp({z} - {m})" for z in zs)
    sel = ", ".join(f"{R(f'exp({z} - {m}) / ({den})')} AS z{j + 1}" for j, z in enumerate(zs))
    return f"SELECT l_orderkey, l_linenumber, {sel} FROM lineitem"


@check("dense_forward", _dense_sql("relu"))
def q_dense(spark, sf):
    li = t(spark, sf, "lineitem")
    return finish(classify.dense_forward(li, LI_NUM, DENSE_W, DENSE_B, "relu",
                                         keep=["l_orderkey", "l_linenumber"]))


@check("dense_softmax", _dense_sql("softmax"))
def q_dense_softmax(spark, sf):
    li = t(spark, sf, "lineitem")
    return finish(classify.dense_forward(li, LI_NUM, DENSE_W, DENSE_B, "softmax",
                                         keep=["l_orderkey", "l_linenumber"]))
