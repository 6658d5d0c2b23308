"""Composed jobs (J1-J5): the whole analyses, one function each.

Each returns a dict of result DataFrames (small tables plus per-row
assignments/predictions).  The feature table is cached once per job and
released at the end; every statistic is learned with a Spark aggregate.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.operators import classify, clean, cluster, evaluate, profile, reduce, split, tune


def unsupervised_report(df: DataFrame, key: str, label: str | None = None, k: int = 3,
                        method: str = "pca", cluster_on: str = "scores", exclude=(),
                        nstart: int = 10, seed: int = 123) -> dict:
    """Profile -> numeric matrix -> 2D and 3D reduction -> k-means on
    the coordinates (or on the standardised features) -> Euclidean
    silhouette -> 2D vs 3D -> clusters on the plane and against the label."""
    out = {"profile": profile.profile(df), "na_summary": profile.na_summary(df),
           "numeric_summary": profile.numeric_summary(df, [c for c in clean.select_numeric(
               df, exclude=tuple(exclude) + ((label,) if label else ()) , key=key).columns if c != key])}
    prep = clean.numeric_matrix(df, key=key, exclude=tuple(exclude) + ((label,) if label else ()))
    feats = prep.features
    x = prep.df.cache()
    try:
        if method == "pca":
            model = reduce.pca_fit(x, feats)
            out["variance"] = clean.axis_labels(model.variance(df.sparkSession))
            scores = model.scores(x, 3, keep=[key], prefix="Dim")
        else:
            mds = reduce.mds_euclidean(x, feats)
            out["variance"] = mds.eigen_table(df.sparkSession)
            scores = mds.coordinates(x, 3, keep=[key])
        scores = scores.cache()
        means = {}
        for dims in (2, 3):
            cols = [f"Dim{i + 1}" for i in range(dims)]
            src, fcols = (scores, cols) if cluster_on == "scores" else (x, feats)
            km = cluster.kmeans(src, fcols, k, nstart=nstart, seed=seed)
            assign = km.assign(src, fcols, label_col=f"Cluster_{dims}D", keep=[key])
            sil = cluster.silhouette(assign.join(src, key), key, fcols, f"Cluster_{dims}D")
            means[dims] = cluster.silhouette_mean(sil)
            out[f"assign_{dims}d"] = assign
            out[f"silhouette_{dims}d"] = sil
        out["compare_dimensions"] = cluster.compare_dimensions(df.sparkSession, means[2], means[3])
        plane = out["assign_2d"].join(out["assign_3d"], key).join(scores, key)
        if label:
            plane = plane.join(df.select(key, label), key)
            out["contingency_2d"] = profile.contingency(plane, "Cluster_2D", label, wide=True)
            out["contingency_3d"] = profile.contingency(plane, "Cluster_3D", label, wide=True)
        out["reduced"] = plane
        out["mean_silhouette"] = means
    finally:
        x.unpersist()
    return out


def supervised_report(df: DataFrame, key: str, target: str, models=("glm", "knn", "rpart"),
                      positive=None, p: float = 0.8, seed: int = 1995, k_folds: int = 5, repeats: int = 1,
                      grids: dict | None = None, exclude=(), parallelism: int = 4,
                      on_error: str = "raise") -> dict:
    """Encoded target -> stratified split -> train-fitted scaling (for
    knn/svm) -> folds -> tuned models -> test predictions -> metrics -> the
    comparison table ordered by AUC then F1."""
    x, tgt, prep = clean.supervised_frame(df, target, key=key, positive=positive, exclude=exclude)
    feats = prep.features
    levels = tgt.levels
    pos = tgt.positive
    _, train, test = split.stratified_split(x, target, key, p, seed)
    train, test = train.cache(), test.cache()
    k = split.safe_folds(train, target, k_folds)
    folds = split.stratified_folds(train, target, key, k, repeats, seed).cache()
    tr_s, te_s, scaler = clean.standardize_train(train, test, feats)
    grids = grids or {}
    out = {"levels": levels, "positive": pos, "tuning": {}, "predictions": {}, "errors": {}}
    preds = []
    for name in models:
        try:
            scaled = name in classify.SCALED_MODELS
            tr, te = (tr_s, te_s) if scaled else (train, test)
            grid = grids.get(name)
            res = tune.tune(tr, name, feats, target, key, grid, folds, levels, pos, parallelism=parallelism)
            pr = res.model.predict(te, keep=[key, target])
            out["tuning"][name] = res
            out["predictions"][name] = pr
            preds.append(_scored(pr, name, key, target, levels, pos))
        except Exception as e:  # noqa: BLE001
            if on_error != "skip":
                raise
            out["errors"][name] = str(e)
    if preds:
        allp = preds[0]
        for q in preds[1:]:
            allp = allp.unionByName(q)
        out["all_predictions"] = allp
        if len(levels) == 2:
            out["comparison"] = evaluate.compare_models(allp, "model", "real", "predicted", "prob", pos)
            out["roc_curves"] = evaluate.roc_curves(allp, "model", "real", "prob", pos)
        else:
            out["comparison"] = evaluate.compare_models_multiclass(allp, "model", "real", "predicted", _prob_cols(levels))
    return out


def _prob_cols(levels) -> dict:
    return {str(c): f"prob_{c}" for c in levels}


def _scored(pred: DataFrame, model: str, key: str, target: str, levels, positive) -> DataFrame:
    """model, key, real, predicted and every class's probability; ``prob`` is the positive class's with two classes."""
    own = [F.col(f"`prob_{positive}`").alias("prob")] if len(levels) == 2 else []
    return pred.select(F.lit(model).alias("model"), key, F.col(target).cast("string").alias("real"), "predicted", *own, *[F.col(f"`{c}`") for c in _prob_cols(levels).values()])


def clean_mds_report(df: DataFrame, key: str, features: list[str], group: str | None = None,
                     max_row_null: float = 0.5, k: int = 3, nstart: int = 10, seed: int = 123) -> dict:
    """Drop sparse rows -> median imputation -> zero variance ->
    standardise -> classical MDS (eigen table, 2D/3D coordinates) ->
    k-means on the standardised features -> silhouette -> clusters by group."""
    x = clean.nonfinite_to_null(df, features)
    kept, report = clean.drop_sparse_rows(x, features, max_row_null, key)
    imp, med = clean.impute_median(kept, features)
    flat = clean.zero_variance_columns(imp, features)
    feats = [c for c in features if c not in flat]
    z = clean.standardize(imp, feats).cache()
    mds = reduce.mds_euclidean(z, feats)
    coords = mds.coordinates(z, 3, keep=[key])
    km = cluster.kmeans(z, feats, k, nstart=nstart, seed=seed)
    assign = km.assign(z, feats, keep=[key] + ([group] if group else []))
    sil = cluster.silhouette(assign.join(z.select(key, *feats), key), key, feats, "cluster")
    out = {"dropped_rows": report, "medians": med, "eigen": mds.eigen_table(df.sparkSession),
           "coordinates": coords, "assign": assign, "silhouette": sil,
           "cluster_variance": cluster.cluster_variance(assign.join(z.select(key, *feats), key), feats, "cluster")}
    if group:
        out["by_group"] = profile.contingency(assign, "cluster", group, wide=True)
    return out


def leak_safe_report(df: DataFrame, key: str, target: str, features: list[str], positive=None,
                     p: float = 0.8, seed: int = 1995, max_row_null: float = 0.6, max_col_null: float = 0.4,
                     models=("lda", "rpart"), k_folds: int = 5, repeats: int = 3, grids=None,
                     parallelism: int = 4) -> dict:
    """Rows -> split -> columns, medians and near-zero variance learned
    from train only -> LDA and tree over repeated folds -> comparison (without
    ROC above two classes) and filter importance."""
    x = clean.nonfinite_to_null(df, features)
    x, _ = clean.drop_sparse_rows(x, features, max_row_null, key)
    x = clean.drop_null_target(x, target)
    x, tgt = clean.encode_target(x, target, positive)
    _, train, test = split.stratified_split(x, target, key, p, seed)
    train, test, dropped = clean.drop_sparse_columns(train, test, features, max_col_null)
    feats = [c for c in features if c not in dropped]
    train, test, med = clean.impute_median_train(train, test, feats)
    nzv = clean.near_zero_variance(train, feats).filter("nzv").select("variable").collect()
    feats = [c for c in feats if c not in {r[0] for r in nzv}]
    train, test = train.cache(), test.cache()
    folds = split.stratified_folds(train, target, key, split.safe_folds(train, target, k_folds), repeats, seed)
    preds, tuned = [], {}
    for name in models:
        res = tune.tune(train, name, feats, target, key, (grids or {}).get(name), folds, tgt.levels,
                        tgt.positive, parallelism=parallelism)
        tuned[name] = res
        pr = res.model.predict(test, keep=[key, target])
        preds.append(_scored(pr, name, key, target, tgt.levels, tgt.positive))
    allp = preds[0]
    for q in preds[1:]:
        allp = allp.unionByName(q)
    return {"dropped_columns": dropped, "medians": med, "features": feats, "tuning": tuned,
            "predictions": allp,
            "resamples": tune.resample_summary(
                reduce_frames([tuned[m].results for m in models]), "model",
                [c for c in ("ROC", "Sens", "Spec", "Accuracy") if c in tuned[models[0]].results.columns]),
            "comparison": evaluate.compare_models(allp, "model", "real", "predicted", "prob", tgt.positive, order=("auc", "accuracy"))
            if len(tgt.levels) == 2 else evaluate.compare_models_multiclass(allp, "model", "real", "predicted", _prob_cols(tgt.levels)),
            "importance": evaluate.filter_importance(train, feats, target, tgt.levels)}


def reduce_frames(frames):
    """Union of several tables with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def full_report(df: DataFrame, key: str, target: str, **kw) -> dict:
    """J1 then J2 on the same table."""
    return {"unsupervised": unsupervised_report(df, key, target, **kw.get("unsupervised", {})),
            "supervised": supervised_report(df, key, target, **kw.get("supervised", {}))}
