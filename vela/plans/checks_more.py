"""Checks for sources, density/linkage clustering (SQL oracles) and the
fitted-model / iterative operators (rows-only; their invariants are in
pytest)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vela.operators import classify, clean, cluster, evaluate, hierarchy, manifold, neighbors, nets, reduce, split, tree, tune
from vela.plans import jobs
from vela.plans.checks import R, check, finish
from vela.plans.fixtures import scored_events, sparse_orders, t
from vela.session import checkpoint_dir
from vela.sources import io

EMB_SQL = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
EPS, MIN_PTS = 1.15, 4


def emb(spark, sf):
    return t(spark, sf, "embeddings")


def scratch(spark, name: str) -> str:
    """A fresh folder under the shared checkpoint folder (never machine-local
    on a cluster)."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- A1, A3, A6

@check("csv_roundtrip", f"""
SELECT p_partkey, p_name, p_brand, p_type, p_size::BIGINT AS p_size, {R('p_retailprice')} AS p_retailprice FROM part
""")
def q_csv_roundtrip(spark, sf):
    path = scratch(spark, "csv")
    io.write_table(t(spark, sf, "part"), path, fmt="csv")
    return finish(io.read_csv_checked(spark, path))


@check("attach_labels", """
SELECT f.vec_id, f.x0, l.label FROM
  (SELECT vec_id, embedding[1]::DOUBLE AS x0, row_number() OVER (ORDER BY vec_id) AS pos FROM embeddings) f
  JOIN (SELECT label, row_number() OVER (ORDER BY vec_id) AS pos FROM embeddings) l USING (pos)
""")
def q_attach_labels(spark, sf):
    e = emb(spark, sf)
    feats = e.select("vec_id", F.col("embedding")[0].cast("double").alias("x0"))
    labs = e.select(F.col("vec_id").alias("lab_order"), "label")
    out = io.attach_labels(feats, labs, order_features="vec_id", order_labels="lab_order")
    return finish(out.select("vec_id", "x0", "label"))


@check("reduce_then_classify")
def q_handoff(spark, sf):
    e = emb(spark, sf)
    m = reduce.pca_fit(e, "embedding")
    path = scratch(spark, "handoff")
    io.write_table(m.scores(e, 3, keep=["vec_id", "label"], prefix="Dim"), path)
    red = io.read_handoff(spark, path, ["vec_id", "Dim1", "Dim2", "Dim3", "label"])
    lda = classify.fit_discriminant(red, ["Dim1", "Dim2", "Dim3"], "label", "lda")
    return lda.predict(red, keep=["vec_id", "label"])


# ---------------------------------------------------------------- K10, K8 single

PR_SQL = f"""pr AS (SELECT a.vec_id AS i, b.vec_id AS j FROM {EMB_SQL} a JOIN {EMB_SQL} b
                    ON a.vec_id <> b.vec_id AND list_distance(a.v, b.v) <= {EPS})"""


@check("dbscan_core", f"""
WITH {PR_SQL}
SELECT e.vec_id, (count(pr.j) + 1 >= {MIN_PTS}) AS core FROM embeddings e LEFT JOIN pr ON pr.i = e.vec_id
GROUP BY e.vec_id
""")
def q_dbscan_core(spark, sf):
    return finish(cluster.dbscan(emb(spark, sf), "vec_id", "embedding", EPS, MIN_PTS).select("vec_id", "core"))


DBSCAN_SQL = f"""
WITH RECURSIVE {PR_SQL},
core AS (SELECT e.vec_id AS v, (count(pr.j) + 1 >= {MIN_PTS}) AS core FROM embeddings e
         LEFT JOIN pr ON pr.i = e.vec_id GROUP BY e.vec_id),
ce AS (SELECT pr.i, pr.j FROM pr JOIN core c1 ON c1.v = pr.i AND c1.core JOIN core c2 ON c2.v = pr.j AND c2.core),
cc(v, l) AS (SELECT v, v FROM core WHERE core UNION SELECT ce.j, cc.l FROM cc JOIN ce ON ce.i = cc.v),
comp AS (SELECT v, min(l) AS comp FROM cc GROUP BY v),
border AS (SELECT pr.i AS v, min({{'j': pr.j, 'comp': comp.comp}}).comp AS comp
           FROM pr JOIN core c ON c.v = pr.i AND NOT c.core JOIN comp ON comp.v = pr.j GROUP BY pr.i),
lab AS (SELECT v, comp FROM comp UNION ALL SELECT v, comp FROM border),
num AS (SELECT comp, row_number() OVER (ORDER BY comp) AS cluster FROM (SELECT DISTINCT comp FROM lab))
SELECT core.v AS vec_id, core.core, coalesce(num.cluster, 0)::BIGINT AS cluster
FROM core LEFT JOIN lab ON lab.v = core.v LEFT JOIN num ON num.comp = lab.comp
"""


@check("dbscan_clusters", DBSCAN_SQL)
def q_dbscan_clusters(spark, sf):
    return finish(cluster.dbscan(emb(spark, sf), "vec_id", "embedding", EPS, MIN_PTS))


#: The same on text keys: order of keys is order of texts.
@check("dbscan_text_key", DBSCAN_SQL.replace("SELECT vec_id, label,", "SELECT 'ID_' || vec_id::VARCHAR AS vec_id, label,")
       .replace("FROM embeddings e", "FROM (SELECT 'ID_' || vec_id::VARCHAR AS vec_id FROM embeddings) e"))
def q_dbscan_text(spark, sf):
    e = emb(spark, sf).withColumn("vec_id", F.concat(F.lit("ID_"), F.col("vec_id").cast("string")))
    return finish(cluster.dbscan(e, "vec_id", "embedding", EPS, MIN_PTS))


@check("single_linkage", f"""
WITH RECURSIVE {PR_SQL},
cc(v, l) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT pr.j, cc.l FROM cc JOIN pr ON pr.i = cc.v)
SELECT v AS vec_id, min(l)::BIGINT AS cluster FROM cc GROUP BY v
""")
def q_single_linkage(spark, sf):
    return finish(cluster.single_linkage_cut(emb(spark, sf), "vec_id", "embedding", EPS))


@check("single_linkage_tree", f"""
WITH RECURSIVE {PR_SQL},
cc(v, l) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT pr.j, cc.l FROM cc JOIN pr ON pr.i = cc.v)
SELECT v AS vec_id, min(l)::BIGINT AS cluster FROM cc GROUP BY v
""")
def q_single_linkage_tree(spark, sf):
    return finish(hierarchy.linkage_cut_at(emb(spark, sf), "vec_id", "embedding", EPS, "single"))


@check("ward_cut")
def q_ward(spark, sf):
    asg, _ = hierarchy.hierarchical(emb(spark, sf), "vec_id", "embedding", 10, "ward.D2")
    return asg


@check("average_tree")
def q_average_tree(spark, sf):
    return hierarchy.hierarchical(emb(spark, sf), "vec_id", "embedding", 10, "average")[1]


@check("divisive")
def q_divisive(spark, sf):
    asg, _, dc = hierarchy.divisive(emb(spark, sf), "vec_id", "embedding", 4)
    return asg.withColumn("coefficient", F.lit(dc))


#: The first medoid is the row of least total distance; no swap lowers the total at the end.
@check("kmedoids")
def q_kmedoids(spark, sf):
    asg, _, _ = hierarchy.kmedoids(emb(spark, sf), "vec_id", "embedding", 10)
    return asg


@check("medoid", f"""
WITH s AS (SELECT a.vec_id, sum(list_distance(a.v, b.v)) AS total FROM {EMB_SQL} a, {EMB_SQL} b GROUP BY a.vec_id)
SELECT vec_id, 1::BIGINT AS cluster FROM s ORDER BY total, vec_id LIMIT 1
""")
def q_medoid(spark, sf):
    asg, med, _ = hierarchy.kmedoids(emb(spark, sf), "vec_id", "embedding", 1)
    return finish(asg.where(F.col("vec_id") == med[0]).select("vec_id", "cluster"))


def _emb_pca(spark, sf):
    e = emb(spark, sf)
    return reduce.pca_fit(e, "embedding").scores(e, 3, keep=["vec_id", "label"])


@check("compare_dimensions")
def q_compare_dimensions(spark, sf):
    s = _emb_pca(spark, sf)
    means = []
    for dims in (2, 3):
        cols = [f"PC{i + 1}" for i in range(dims)]
        km = cluster.kmeans(s, cols, 10, seed=3)
        a = km.assign(s, cols, keep=["vec_id", *cols])
        means.append(cluster.silhouette_mean(cluster.silhouette(a, "vec_id", cols, "cluster")))
    return cluster.compare_dimensions(spark, means[0], means[1])


@check("clusters_on_plane")
def q_clusters_on_plane(spark, sf):
    s = _emb_pca(spark, sf)
    km = cluster.kmeans(s, ["PC1", "PC2"], 10, seed=3)
    a = km.assign(s, ["PC1", "PC2"], keep=["vec_id"])
    return cluster.clusters_on_plane(a, s.select("vec_id", "PC1", "PC2"), s.select("vec_id", "label"), "vec_id")


# ---------------------------------------------------------------- E5 - E11

@check("landmark_mds")
def q_landmark_mds(spark, sf):
    return manifold.landmark_mds(emb(spark, sf), "vec_id", "embedding", k=2).coords


@check("isomap")
def q_isomap(spark, sf):
    return manifold.isomap(emb(spark, sf), "vec_id", "embedding", k=12, dims=2).coords


@check("lle")
def q_lle(spark, sf):
    return manifold.lle(emb(spark, sf), "vec_id", "embedding", k=10, dims=2).coords


@check("laplacian_eigenmaps")
def q_laplacian(spark, sf):
    return manifold.laplacian_eigenmaps(emb(spark, sf), "vec_id", "embedding", dims=2, k=10).coords


@check("umap_graph")
def q_umap_graph(spark, sf):
    return manifold.neighbor_affinities(emb(spark, sf), "vec_id", "embedding", "umap", n_neighbors=15)


@check("tsne_affinities")
def q_tsne(spark, sf):
    return manifold.neighbor_affinities(emb(spark, sf), "vec_id", "embedding", "tsne")


@check("neighbor_embedding")
def q_neighbor_embedding(spark, sf):
    return manifold.neighbor_embedding(emb(spark, sf), "vec_id", "embedding", "umap", epochs=10).coords


@check("ica")
def q_ica(spark, sf):
    li = t(spark, sf, "lineitem")
    m = manifold.ica(li, ["l_quantity", "l_discount", "l_tax"], 2)
    return m.sources(li, keep=["l_orderkey", "l_linenumber"])


# ---------------------------------------------------------------- classifiers (rows-only)

def _orders_bin(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("x_cust"),
                                      F.when(F.col("o_orderstatus") == "F", "F").otherwise("notF").alias("status"))
    return clean.standardize(o, ["o_totalprice", "x_cust"])


OF = ["o_totalprice", "x_cust"]


@check("glm_scores")
def q_glm(spark, sf):
    o = _orders_bin(spark, sf)
    return classify.fit_logistic(o, OF, "status").predict(o, keep=["o_orderkey", "status"])


@check("svm_linear")
def q_svm_linear(spark, sf):
    o = _orders_bin(spark, sf)
    return classify.fit_svm_linear(o, OF, "status").predict(o, keep=["o_orderkey", "status"])


@check("svm_radial")
def q_svm_radial(spark, sf):
    o = _orders_bin(spark, sf)
    return classify.fit_svm_radial(o, OF, "status").predict(o, keep=["o_orderkey", "status"])


@check("svm_poly")
def q_svm_poly(spark, sf):
    o = _orders_bin(spark, sf)
    return classify.fit_svm_poly(o, OF, "status", degree=2).predict(o, keep=["o_orderkey", "status"])


TREE_FEATURES = ["l_quantity", "l_discount", "months", "l_linenumber"]


def _li_tree(spark, sf):
    li = t(spark, sf, "lineitem")
    months = F.year("l_shipdate") * 12 + F.month("l_shipdate")
    return li.select("l_returnflag", "l_quantity", "l_discount", months.alias("months"), "l_linenumber")


def _tree_sql(depth: int) -> str:
    """Growth of a Gini tree to ``depth`` (1 or 2), every split of every node compared, then weakest-link cp."""
    def best(d):
        return f"""
h{d} AS (SELECT node, feature, v, sum((y = 'A')::INT)::DOUBLE a, sum((y = 'N')::INT)::DOUBLE n, sum((y = 'R')::INT)::DOUBLE r
       FROM (SELECT node, y, unnest([1, 2, 3, 4]) AS feature, unnest([x1, x2, x3, x4]) AS v FROM g{d}) GROUP BY ALL),
w{d} AS (SELECT *, sum(a) OVER up la, sum(n) OVER up ln, sum(r) OVER up lr, sum(a) OVER al ta, sum(n) OVER al tn, sum(r) OVER al tr, lead(v) OVER (PARTITION BY node, feature ORDER BY v) nv
       FROM h{d} WINDOW up AS (PARTITION BY node, feature ORDER BY v), al AS (PARTITION BY node, feature)),
s{d} AS (SELECT node, feature, (v + nv) / 2 AS cut, round((la*la + ln*ln + lr*lr) / (la + ln + lr) + ((ta-la)*(ta-la) + (tn-ln)*(tn-ln) + (tr-lr)*(tr-lr)) / (ta+tn+tr-la-ln-lr)
              - (ta*ta + tn*tn + tr*tr) / (ta + tn + tr), 8) AS gain
       FROM w{d} WHERE nv IS NOT NULL AND la + ln + lr >= 7 AND ta+tn+tr-la-ln-lr >= 7),
c{d} AS (SELECT node, count(*) AS n, sum((y = 'A')::INT) AS n_A, sum((y = 'N')::INT) AS n_N, sum((y = 'R')::INT) AS n_R FROM g{d} GROUP BY node),
k{d} AS (SELECT *, n - greatest(n_A, n_N, n_R) AS risk FROM c{d}),
b{d} AS (SELECT s.* FROM s{d} s JOIN k{d} USING (node) WHERE gain > 0 AND n >= 20 AND risk > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, cut) = 1)"""
    def child(d):
        return f"""
g{d + 1} AS (SELECT g.* REPLACE (CASE WHEN [x1, x2, x3, x4][feature] < cut THEN 2 * node ELSE 2 * node + 1 END AS node) FROM g{d} g JOIN b{d} USING (node))"""
    parts = [f"""g0 AS (SELECT 1::BIGINT AS node, l_returnflag AS y, l_quantity::DOUBLE AS x1, l_discount::DOUBLE AS x2, (year(l_shipdate) * 12 + month(l_shipdate))::DOUBLE AS x3, l_linenumber::DOUBLE AS x4 FROM lineitem)"""]
    for d in range(depth):
        parts += [best(d), child(d)]
    last = depth
    parts.append(f"""
c{last} AS (SELECT node, count(*) AS n, sum((y = 'A')::INT) AS n_A, sum((y = 'N')::INT) AS n_N, sum((y = 'R')::INT) AS n_R FROM g{last} GROUP BY node),
k{last} AS (SELECT *, n - greatest(n_A, n_N, n_R) AS risk FROM c{last})""")
    every = " UNION ALL ".join(f"SELECT k.*, {d} AS depth, feature, cut, gain FROM k{d} k LEFT JOIN " + (f"b{d}" if d < depth else "(SELECT NULL::BIGINT AS node, NULL::INT AS feature, NULL::DOUBLE AS cut, NULL::DOUBLE AS gain)") + " USING (node)" for d in range(depth + 1))
    return "WITH " + ",".join(parts) + f""",
every AS ({every})
SELECT node, nullif(node // 2, 0) AS parent, depth::BIGINT AS depth, ['l_quantity', 'l_discount', 'months', 'l_linenumber'][feature] AS variable, {R('cut')} AS cut, n::BIGINT AS n,
       risk::BIGINT AS risk, {R('coalesce(gain, 0)')} AS gain, CASE WHEN n_A = n - risk THEN 'A' WHEN n_N = n - risk THEN 'N' ELSE 'R' END AS predicted,
       feature IS NULL AS leaf, n_A::BIGINT AS n_A, n_N::BIGINT AS n_N, n_R::BIGINT AS n_R FROM every"""


@check("tree_nodes", _tree_sql(2))
def q_tree_nodes(spark, sf):
    m = tree.fit_tree(_li_tree(spark, sf), TREE_FEATURES, "l_returnflag", ["A", "N", "R"], cp=-1.0, max_depth=2)
    return finish(m.node_table(spark).drop("cp"))


@check("tree_rules")
def q_tree_rules(spark, sf):
    li = _li_tree(spark, sf)
    m = classify.fit_tree(li, TREE_FEATURES, "l_returnflag", cp=0.001)
    return classify.tree_rules(m, li, "l_returnflag")


@check("tree_cp_table")
def q_tree_cp(spark, sf):
    return tree.fit_tree(_li_tree(spark, sf), TREE_FEATURES, "l_returnflag", cp=0.0005).cp_table(spark)


@check("tune_tree")
def q_tune_tree(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("months"), "o_orderpriority",
                                      F.when(F.col("o_orderstatus") == "F", "F").otherwise("notF").alias("status"))
    folds = split.stratified_folds(o, "status", "o_orderkey", 5, 3, seed=5)
    return tune.tune(o, "rpart", ["o_totalprice", "months"], "status", "o_orderkey", None, folds, ["F", "notF"]).results


@check("bagging")
def q_bagging(spark, sf):
    o = _orders_bin(spark, sf)
    return classify.fit_forest(o, OF, "status", n_trees=10, bagging=True, max_depth=6) \
        .predict(o, keep=["o_orderkey", "status"])


@check("random_forest")
def q_random_forest(spark, sf):
    o = _orders_bin(spark, sf)
    m = classify.fit_forest(o, OF, "status")
    return evaluate.model_importance(spark, OF, m.importances())


@check("gbt")
def q_gbt(spark, sf):
    o = _orders_bin(spark, sf)
    m = classify.fit_gbt(o, OF, "status", n_iter=10)
    hist = classify.gbt_loss_history(m, o, "status")
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def _li_net(spark, sf):
    li = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag",
                                         *["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    li = li.withColumn("rk", F.xxhash64("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))
    return clean.standardize(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@check("mlp_history")
def q_mlp_history(spark, sf):
    li = _li_net(spark, sf)
    m = nets.fit_mlp(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag", "rk",
                     hidden=(15,), epochs=4, n_batches=2)
    return m.history_table(spark)


@check("mlp_early_stop")
def q_mlp_early(spark, sf):
    li = _li_net(spark, sf)
    m = nets.fit_mlp(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "l_returnflag", "rk",
                     hidden=(32, 16), epochs=6, dropout=0.2, optimizer="rmsprop", lr=0.005, n_batches=2,
                     patience=2, lr_patience=1)
    return m.history_table(spark)


@check("tune_knn")
def q_tune_knn(spark, sf):
    e = emb(spark, sf)
    folds = split.stratified_folds(e, "label", "vec_id", 5, 1, seed=5)
    levels = sorted(str(r[0]) for r in e.select("label").distinct().collect())
    res = tune.tune(e, "knn", "embedding", "label", "vec_id", None, folds, levels)
    return res.summary


@check("pr_auc")
def q_pr_auc(spark, sf):
    s = scored_events(spark, sf).withColumn("real", F.when(F.col("label") == 1, "yes").otherwise("no"))
    return evaluate.pr_auc(s, "real", "score", "yes")


# ---------------------------------------------------------------- J1 - J4

@check("unsupervised_report")
def q_unsupervised(spark, sf):
    e = emb(spark, sf)
    flat = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(64)], "label")
    out = jobs.unsupervised_report(flat, "vec_id", "label", k=10)
    return out["reduced"]


@check("supervised_report")
def q_supervised(spark, sf):
    o = t(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("x_cust"),
                                      F.when(F.col("o_orderstatus") == "F", "F").otherwise("notF").alias("status"))
    out = jobs.supervised_report(o, "o_orderkey", "status", models=("glm", "lda", "rpart"))
    return out["comparison"]


@check("clean_mds_report")
def q_clean_mds(spark, sf):
    s = sparse_orders(spark, sf)
    out = jobs.clean_mds_report(s, "o_orderkey", ["o_totalprice", "x_cust", "x_price7", "x_mod"],
                                group="o_orderstatus", k=3)
    return out["by_group"]


@check("leak_safe_report")
def q_leak_safe(spark, sf):
    s = sparse_orders(spark, sf).withColumn("status", F.when(F.col("o_orderstatus") == "F", "F").otherwise("notF"))
    out = jobs.leak_safe_report(s, "o_orderkey", "status", ["o_totalprice", "x_cust", "x_price7", "x_mod"])
    return out["comparison"]


@check("leak_safe_multiclass")
def q_leak_safe_multiclass(spark, sf):
    s = sparse_orders(spark, sf)
    out = jobs.leak_safe_report(s, "o_orderkey", "o_orderstatus", ["o_totalprice", "x_cust", "x_price7", "x_mod"], repeats=1)
    return out["comparison"]
