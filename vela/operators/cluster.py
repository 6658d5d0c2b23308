"""Clustering and cluster quality.

k-means runs on ``pyspark.ml.clustering.KMeans`` (several seeds, best
training cost kept).  Merge trees, divisive trees and medoids are in
``vela.operators.hierarchy``.  The silhouette is the *Euclidean* one (not ml's
squared-distance evaluator): rows are packed into blocks, block pairs are
joined by equality, and each pair returns only per-row, per-cluster distance
sums, so the shuffle is O(n * clusters) while the compute is O(n^2 d).
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.functions.columns import feature_array
from vela.operators.patterns import block_arrays, block_count, map_block_pairs, near_sq_dists, pack_blocks, sq_dists
from vela.session import cut_lineage


@dataclass
class KMeansResult:
    model: object
    cost: float
    k: int
    seed: int

    def assign(self, df: DataFrame, features, label_col: str = "cluster", keep=None) -> DataFrame:
        keep = df.columns if keep is None else keep
        x = df.withColumn("__f", array_to_vector(feature_array(df, features)))
        out = self.model.transform(x)
        return out.select(*keep, (F.col("prediction") + 1).cast("int").alias(label_col))

    def centers(self):
        return np.array(self.model.clusterCenters())


def kmeans(df: DataFrame, features, k: int, nstart: int = 10, max_iter: int = 10,
           seed: int = 123, tol: float = 1e-4, parallelism: int = 4) -> KMeansResult:
    """K1: best of ``nstart`` seeded k-means fits by within sum of squares
    (``max_iter`` 10 as R's default ``iter.max``).

    The feature table is cached once, spread over the cores; the starts run
    as concurrent Spark jobs from a driver thread pool (k-means||
    initialisation, Lloyd iterations as distributed aggregates)."""
    x = _vectors(df, features)
    try:
        x.count()
        return _best_start(x, k, nstart, max_iter, seed, tol, parallelism)
    finally:
        x.unpersist()


def _vectors(df: DataFrame, features) -> DataFrame:
    return spread(df.select(array_to_vector(feature_array(df, features)).alias("__f"))).cache()


def _best_start(x: DataFrame, k: int, nstart: int, max_iter: int = 10, seed: int = 123, tol: float = 1e-4, parallelism: int = 4) -> KMeansResult:
    """The fit of least cost on the vectors of ``_vectors``.

    ml keeps the rows it prepares (vector, norm, weight) for all passes of a fit only
    if it sees an input that is not cached itself; else every pass prepares them anew."""
    from concurrent.futures import ThreadPoolExecutor
    at_once = max(1, min(parallelism, nstart, HELD_ROWS // max(1, x.count())))
    x = x.where(F.lit(True))

    def fit(s):
        km = KMeans(k=k, seed=seed + s, maxIter=max_iter, tol=tol, featuresCol="__f", initMode="k-means||")
        m = km.fit(x)
        return KMeansResult(m, _settled(m.summary.trainingCost), k, seed + s)

    with ThreadPoolExecutor(at_once) as ex:
        fits = list(ex.map(fit, range(nstart)))
    return min(fits, key=lambda r: (r.cost, r.seed))


#: Rows that concurrent starts may hold prepared, all together (about 150 bytes each).
HELD_ROWS = 30_000_000
#: Rows of a partition that ``spread`` deals out, at most about.
SPREAD_ROWS = 250_000


def spread(df: DataFrame) -> DataFrame:
    """Iterative fits re-read their input many times: spread a table that
    arrives in fewer partitions than there are cores (one-file inputs), or
    in partitions of more than ``SPREAD_ROWS`` rows."""
    par = df.sparkSession.sparkContext.defaultParallelism
    have = df.rdd.getNumPartitions()
    parts = max(par, math.ceil(df.count() / SPREAD_ROWS))
    return df.repartition(parts) if have < parts else df


def lloyd_step(df: DataFrame, features, centers: np.ndarray, label_col: str = "cluster") -> DataFrame:
    """One Lloyd step with given centres: nearest centre (ties to the lower
    index), as a column expression; returns the rows with their label."""
    x = feature_array(df, features)
    dists = []
    for j, c in enumerate(centers):
        terms = [(x[i] - F.lit(float(c[i]))) * (x[i] - F.lit(float(c[i]))) for i in range(len(c))]
        e = terms[0]
        for t in terms[1:]:
            e = e + t
        dists.append(F.struct(e.alias("d"), F.lit(j + 1).alias("c")))
    return df.withColumn(label_col, F.least(*dists)["c"]) if len(dists) > 1 else \
        df.withColumn(label_col, F.lit(1))


def cluster_variance(df: DataFrame, features, label_col: str) -> DataFrame:
    """K2: per cluster size and within SS; plus total SS and between share
    (one row per cluster, totals repeated).  Two aggregates."""
    x = feature_array(df, features)
    d = df.select(F.size(x).alias("d")).head(1)[0]["d"]
    xs = df.select(F.col(label_col).alias("cluster"), x.alias("v"))
    gm = xs.agg(*[F.avg(F.col("v")[i]).alias(f"g{i}") for i in range(d)]).collect()[0]
    g = [gm[f"g{i}"] for i in range(d)]
    per = xs.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("size"),
        *[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(d)],
        *[F.sum(F.col("v")[i] * F.col("v")[i]).alias(f"s{i}") for i in range(d)])
    within = sum((F.col(f"s{i}") - F.col("size") * F.col(f"m{i}") * F.col(f"m{i}")) for i in range(d))
    between = sum(F.col("size") * (F.col(f"m{i}") - F.lit(g[i])) * (F.col(f"m{i}") - F.lit(g[i]))
                  for i in range(d))
    t = per.select("cluster", F.col("size").cast("long").alias("size"),
                   within.alias("within_ss"), between.alias("between_part"))
    tot = t.agg(F.sum("within_ss").alias("w"), F.sum("between_part").alias("b")).collect()[0]
    total = tot["w"] + tot["b"]
    return t.select("cluster", "size", "within_ss",
                    F.lit(total).alias("total_ss"),
                    F.lit(tot["b"] / total if total else None).cast("double").alias("between_share"))


def elbow(df: DataFrame, features, ks=range(1, 11), nstart: int = 5, seed: int = 123, max_iter: int = 10, tol: float = 1e-4) -> DataFrame:
    """K3: (k, wss) for each k; k = 1 is the total sum of squares.

    Steps and stopping rule are those of ``kmeans``, but the starts of all k take their Lloyd steps
    together: a step is one pass over one cached table.  Up to ``DRAWN_ROWS`` rows the starts are ml's
    too; above, k-means++ draws the next centre of every start in one pass."""
    rows, more, x = [], [k for k in ks if k != 1], None
    try:
        if more:
            x = spread(df.select(feature_array(df, features).alias("a"))).cache()
            todo = [(k, s) for k in more for s in range(nstart)]
            starts = _ml_starts(x, todo, seed) if x.count() <= DRAWN_ROWS else _drawn_starts(x, todo, seed)
            costs = _lloyd_costs(x, starts, max_iter, tol)
        for k in ks:
            if k == 1:
                cv = cluster_variance(df.withColumn("__one", F.lit(1)), features, "__one").collect()[0]
                rows.append((1, float(cv["total_ss"])))
                continue
            rows.append((k, min(c for (j, _), c in zip(todo, costs) if j == k)))
    finally:
        if x is not None:
            x.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, wss double")


#: Rows above which ``elbow`` draws the centres of all its starts in common passes.
DRAWN_ROWS = 10_000


def _ml_starts(x: DataFrame, todo: list[tuple], seed: int) -> list[np.ndarray]:
    """The centres from which ml starts, for each (k, start)."""
    from concurrent.futures import ThreadPoolExecutor
    vectors = x.select(array_to_vector("a").alias("__f"))
    begin = lambda t: KMeans(k=t[0], seed=seed + t[1], maxIter=0, featuresCol="__f", initMode="k-means||").fit(vectors).clusterCenters()
    with ThreadPoolExecutor(4) as ex:
        return [np.array(c) for c in ex.map(begin, todo)]


def _drawn_starts(x: DataFrame, todo: list[tuple], seed: int) -> list[np.ndarray]:
    """k-means++ for each (k, start): a row becomes the next centre with a probability in
    proportion to its squared distance from the centres so far; one pass draws it for all."""
    d = x.select(F.size("a").alias("d")).head(1)[0]["d"]
    centers, left = [np.zeros((0, d)) for _ in todo], list(range(len(todo)))
    for j in range(max(k for k, _ in todo)):
        left = [p for p in left if todo[p][0] > j]
        if not left:
            break
        found = _drawn(x, np.stack([centers[p] for p in left]), seed, j)
        for i, v in found.items():
            centers[left[i]] = np.vstack([centers[left[i]], v])
        left = [p for i, p in enumerate(left) if i in found]  # the others hold every distinct row
    return centers


def _drawn(x: DataFrame, C: np.ndarray, seed: int, j: int) -> dict[int, list]:
    """The drawn row of each of the sets of ``j`` centres: the first of races whose pace is the squared distance."""
    import pyarrow as pa
    from pyspark import TaskContext
    P, _, d = C.shape

    def partial(batches):
        rng = np.random.default_rng([seed, j, TaskContext.get().partitionId()])
        best, rows = np.full(P, np.inf), np.zeros((P, d))
        for batch in batches:
            whole = _rows_of(batch, d)
            for s in range(0, len(whole), 1024):
                X = whole[s:s + 1024]
                near = np.ones((len(X), P))
                if j:
                    near = sum((X[:, i][:, None, None] - C[None, :, :, i]) ** 2 for i in range(d)).min(axis=2)
                with np.errstate(divide="ignore"):
                    race = np.where(near > 0, rng.exponential(size=near.shape) / near, np.inf)
                first = race.argmin(axis=0)
                time = race[first, np.arange(P)]
                won = time < best
                best[won], rows[won] = time[won], X[first[won]]
        at = np.flatnonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(best[at]), pa.array(rows[at].tolist(), pa.list_(pa.float64()))], names=["p", "time", "v"])

    found = x.mapInArrow(partial, "p int, time double, v array<double>").groupBy("p").agg(F.min_by("v", "time").alias("v"))
    return {r["p"]: r["v"] for r in found.collect()}  # a row a start


def _rows_of(batch, d: int) -> np.ndarray:
    a = batch.column("a")
    if a.null_count or a.flatten().null_count:
        raise ValueError("a feature is null")
    return a.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(batch.num_rows, d)


def _lloyd_costs(x: DataFrame, starts: list[np.ndarray], max_iter: int, tol: float) -> list[float]:
    """Training cost of Lloyd steps from each start, as ml takes them: the cost of the last
    step's pass; a centre without rows stays; no centre moves by more than ``tol`` at the end."""
    centers, costs, todo = [c.copy() for c in starts], [0.0] * len(starts), list(range(len(starts)))
    for _ in range(max_iter):
        still = []
        for p, (cost, counts, sums) in zip(todo, _lloyd_sums(x, [centers[p] for p in todo])):
            new = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers[p])
            moved = ((new - centers[p]) ** 2).sum(axis=1)
            centers[p], costs[p] = new, _settled(cost)
            if (moved > tol * tol).any():
                still.append(p)
        todo = still
        if not todo:
            break
    return costs


def _lloyd_sums(x: DataFrame, centers: list[np.ndarray]) -> list[tuple]:
    """(cost, rows and sum of the rows of each centre) for each set of centres, in one pass."""
    import pyarrow as pa

    from vela.operators.svm import _CHUNK, _summed
    d = centers[0].shape[1]
    shift = np.concatenate(centers).mean(axis=0)
    sizes = np.array([len(c) for c in centers])
    ends = np.cumsum(1 + sizes * (1 + d))
    by_size = [(k, np.flatnonzero(sizes == k)) for k in np.unique(sizes)]
    held = [(k, at, np.stack([centers[p] for p in at]) - shift) for k, at in by_size]

    def partial(batches):
        found = [np.zeros((len(at), 1 + k * (1 + d))) for k, at, _ in held]
        for batch in batches:
            whole = _rows_of(batch, d) - shift
            for s in range(0, len(whole), 2048):
                X = whole[s:s + 2048]
                for total, (k, at, C) in zip(found, held):
                    P = len(at)
                    D = (X @ C.reshape(P * k, d).T).reshape(len(X), P, k)
                    D *= -2
                    D += (C ** 2).sum(axis=2)
                    near = D.argmin(axis=2) + np.arange(P) * k
                    flat, n = near.ravel(), P * k
                    counts = np.bincount(flat, minlength=n).reshape(P, k)
                    total[:, 1:1 + k] += counts
                    cost = np.zeros((len(X), P))
                    for j in range(d):
                        xj = np.repeat(X[:, j], P)
                        total[:, 1 + k + j::d] += np.bincount(flat, xj, n).reshape(P, k)
                        cost += ((xj - C[:, :, j].ravel()[flat]) ** 2).reshape(len(X), P)
                    total[:, 0] += cost.sum(axis=0)
        flat = np.concatenate([f.ravel() for f in found])
        at = range(0, len(flat), _CHUNK)
        yield pa.RecordBatch.from_arrays([pa.array(list(range(len(at))), pa.int32()), pa.array([flat[a:a + _CHUNK].tobytes() for a in at], pa.binary())], names=["chunk", "v"])

    flat, out, begin = _summed(x.mapInArrow(partial, "chunk int, v binary"), int(ends[-1])), [None] * len(centers), 0
    for k, at, _ in held:
        width = 1 + k * (1 + d)
        for p, v in zip(at, flat[begin:begin + width * len(at)].reshape(len(at), width)):
            counts = v[1:1 + k]
            out[p] = v[0], counts, v[1 + k:].reshape(k, d) + counts[:, None] * shift
        begin += width * len(at)
    return out


def _settled(cost: float) -> float:
    """Without the digits that hang on the order in which partial sums come: they would choose between equal fits."""
    return float(f"{cost:.12g}")


def _block_rows(spark, n: int) -> int:
    par = max(1, spark.sparkContext.defaultParallelism)
    b = max(1, int(math.sqrt(8 * par)))
    return int(min(2048, max(16, math.ceil(n / b))))


def silhouette(df: DataFrame, key: str, features, label_col: str, block_rows: int | None = None,
               squared: bool = False) -> DataFrame:
    """K4: per row (key, cluster, neighbor, sil_width), Euclidean.

    Width 0 for a row alone in its cluster; the neighbour is the other
    cluster of least mean distance (ties to the lower label).  Exact:
    O(n^2 d) compute over block pairs, O(n k) shuffle.  ``squared`` uses
    squared distances (what ml's evaluator averages)."""
    from vela.operators.patterns import via_long_key
    return via_long_key(df, key, lambda x: _silhouette(x, key, features, label_col, block_rows, squared), [key])


def _silhouette(df, key, features, label_col, block_rows, squared):
    spark = df.sparkSession
    n = df.count()
    br = block_rows or _block_rows(spark, n)
    nb = block_count(n, br)
    vec = feature_array(df, features)
    d = df.select(F.size(vec).alias("d")).head(1)[0]["d"]
    blocks = pack_blocks(df, key, vec, nb, F.col(label_col))

    def sums(it):
        import pandas as pd
        for pdf in it:
            out_k, out_c, out_s, out_n = [], [], [], []
            for _, row in pdf.iterrows():
                ka, va, ta = block_arrays(row, "a", d)
                kb, vb, tb = block_arrays(row, "b", d)
                if len(ka) == 0 or len(kb) == 0:
                    continue
                D = near_sq_dists(va, vb)
                if not squared:
                    D = np.sqrt(D)
                sides = [(ka, tb, D)]
                if row["a"] != row["b"]:
                    sides.append((kb, ta, D.T))
                for keys, tags, M in sides:
                    for c in np.unique(tags):
                        sel = tags == c
                        out_k.append(keys)
                        out_c.append(np.full(len(keys), c))
                        out_s.append(M[:, sel].sum(1))
                        out_n.append(np.full(len(keys), int(sel.sum())))
            if out_k:
                yield pd.DataFrame({"k": np.concatenate(out_k), "c": np.concatenate(out_c),
                                    "s": np.concatenate(out_s), "n": np.concatenate(out_n)})

    part = map_block_pairs(blocks, nb, 8 * n * d, sums, "k long, c long, s double, n long")
    per = part.groupBy("k", "c").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    own = df.select(F.col(key).cast("long").alias("k"), F.col(label_col).cast("long").alias("own"))
    j = per.join(own, "k")
    res = j.groupBy("k", "own").agg(
        F.max(F.when(F.col("c") == F.col("own"), F.col("n"))).alias("n_own"),
        F.max(F.when(F.col("c") == F.col("own"), F.col("s"))).alias("s_own"),
        F.min(F.when(F.col("c") != F.col("own"),
                     F.struct((F.col("s") / F.col("n")).alias("m"), F.col("c").alias("c")))).alias("nb"))
    a = F.when(F.col("n_own") > 1, F.col("s_own") / (F.col("n_own") - 1))
    b = F.col("nb.m")
    width = F.when((F.col("n_own") <= 1) | b.isNull(), F.lit(0.0)) \
        .otherwise((b - a) / F.greatest(a, b))
    return res.select(F.col("k").alias(key), F.col("own").alias("cluster"),
                      F.col("nb.c").alias("neighbor"), width.alias("sil_width"))


def silhouette_mean(sil: DataFrame) -> float:
    return sil.agg(F.avg("sil_width")).collect()[0][0]


# The bands used to read a mean silhouette.
SILHOUETTE_BANDS = [(0.70, "strong"), (0.50, "fair"), (0.25, "weak")]
SILHOUETTE_BANDS_3 = [(0.50, "fair"), (0.25, "weak")]


def silhouette_band(col, bands=SILHOUETTE_BANDS, otherwise: str = "none"):
    """K5: band label for a silhouette value (column expression)."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for lim, name in bands:
        expr = F.when(c >= lim, F.lit(name)) if expr is None else expr.when(c >= lim, F.lit(name))
    return expr.otherwise(F.lit(otherwise))


def compare_dimensions(spark, mean_2d: float, mean_3d: float) -> DataFrame:
    """K6: 2D against 3D mean silhouette; the larger wins (2D on ties)."""
    best = "3D" if mean_3d > mean_2d else "2D"
    return spark.createDataFrame([("2D", float(mean_2d), best == "2D"), ("3D", float(mean_3d), best == "3D")],
                                 "dims string, mean_silhouette double, chosen boolean")


def clusters_on_plane(assign: DataFrame, scores: DataFrame, labels: DataFrame | None, key: str) -> DataFrame:
    """Assignment joined by key to the first two scores and the label."""
    out = assign.join(scores, key)
    return out.join(labels, key, "left") if labels is not None else out


# ---------------------------------------------------------------- K7 - K10

def dbscan(df: DataFrame, key: str, features, eps: float, min_pts: int,
           block_rows: int | None = None) -> DataFrame:
    """Density clusters.  A row is core when at least ``min_pts`` rows
    (itself included) lie within ``eps``; core rows within eps of each other
    share a cluster (connected components, P3); a border row joins the
    cluster of its lowest-key core neighbour; the rest is noise (cluster 0).
    Clusters are numbered 1.. by their smallest key.  Neighbourhoods come
    from block pairs (exact) in two passes, which hand on counts and then at most
    a link a row and cell of the grid, not the pairs within eps."""
    from vela.operators.patterns import via_long_key
    return via_long_key(df, key, lambda x: _dbscan(x, key, features, eps, min_pts, block_rows), [key])


def _dbscan(df, key, features, eps, min_pts, block_rows):
    from vela.operators.neighbors import cells_help, eps_counts, eps_links
    from vela.operators.patterns import connected_components
    in_cells = cells_help(df, key, features, eps)
    keys = df.select(F.col(key).cast("long").alias("v"))
    deg = eps_counts(df, key, features, eps, block_rows, in_cells)
    core = cut_lineage(keys.join(deg, "v", "left").select("v", ((F.coalesce("nb", F.lit(0)) + 1) >= min_pts).alias("core")))
    cv = core.filter("core").select("v").distinct()
    tagged = df.withColumn("__v", F.col(key).cast("long")).join(cv.select(F.col("v").alias("__v"), F.lit(1).alias("__core")), "__v", "left")
    links = cut_lineage(eps_links(tagged, key, features, eps, block_rows, F.coalesce("__core", F.lit(0)), in_cells))
    comp = connected_components(cv, links.filter("kind = 0"))
    # border rows: lowest-key core neighbour
    border = links.filter("kind = 1").join(comp.select(F.col("v").alias("j"), "comp"), "j") \
        .groupBy(F.col("i").alias("v")).agg(F.min(F.struct("j", "comp")).alias("s")) \
        .select("v", F.col("s.comp").alias("comp"))
    lab = comp.unionByName(border)
    ids = lab.select("comp").distinct()
    from vela.operators.patterns import bucket_rank
    numbered = bucket_rank(ids, [], "comp", "comp", "cluster", lo=None, n_buckets=64)
    out = core.join(lab, "v", "left").join(numbered, "comp", "left") \
        .select(F.col("v").alias(key), "core", F.coalesce(F.col("cluster"), F.lit(0)).cast("long").alias("cluster"))
    return out


def single_linkage_cut(df: DataFrame, key: str, features, height: float) -> DataFrame:
    """K8 (single linkage) cut at ``height``: clusters are the connected
    components of the graph of pairs closer than ``height`` (exact).
    Cluster id = smallest key in the cluster."""
    from vela.operators.patterns import via_long_key
    return via_long_key(df, key, lambda x: _single_linkage(x, key, features, height), [key, "cluster"])


def _single_linkage(df, key, features, height):
    from vela.operators.neighbors import eps_links
    from vela.operators.patterns import connected_components
    pairs = eps_links(df, key, features, height)
    keys = df.select(F.col(key).cast("long").alias("v"))
    comp = connected_components(keys, pairs)
    return comp.select(F.col("v").alias(key), F.col("comp").alias("cluster"))


def _nearest(x: DataFrame, centers: np.ndarray) -> DataFrame:
    """(key, cluster 1.., dist) to the nearest of ``centers`` (numpy per batch)."""
    C = np.asarray(centers, dtype=float)

    def run(it):
        import pandas as pd
        for pdf in it:
            if len(pdf) == 0:
                continue
            V = np.stack(pdf["__v"].to_numpy()).astype(float)
            D = np.sqrt(sq_dists(V, C))
            j = D.argmin(1)
            yield pd.DataFrame({"__k": pdf["__k"].to_numpy(), "cluster": (j + 1).astype(np.int32),
                                "dist": D[np.arange(len(V)), j]})

    kt = x.schema["__k"].dataType.simpleString()
    return x.mapInPandas(run, f"__k {kt}, cluster int, dist double")
