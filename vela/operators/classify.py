"""Classifiers.

Gaussian discriminants (LDA, QDA, RDA, FDA) and Gaussian naive Bayes fit
from one grouped-moments pass (n, mean, scatter per class), solve d x d
systems on the driver, and score with column expressions (one linear or
quadratic form per class, then a softmax) -- no UDF on the scoring path.
Tree, forest, boosting, SVM and logistic models are ``pyspark.ml`` fits;
k-NN is the exact block-pair join.  Every model's ``predict`` adds the class
and one probability column per class.
"""
from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vela.functions.columns import feature_array
from vela.operators.patterns import column_means, grouped_moments


def _dot(x: Column, w: np.ndarray, b: float = 0.0) -> Column:
    e = F.lit(float(b))
    for i, wi in enumerate(w):
        if wi != 0:
            e = e + x[i] * F.lit(float(wi))
    return e


def _quad(x: Column, mu: np.ndarray, A: np.ndarray) -> Column:
    """(x - mu)^T A (x - mu) as a column expression."""
    d = len(mu)
    c = [x[i] - F.lit(float(mu[i])) for i in range(d)]
    e = F.lit(0.0)
    for i in range(d):
        e = e + c[i] * c[i] * F.lit(float(A[i, i]))
        for j in range(i + 1, d):
            e = e + c[i] * c[j] * F.lit(float(2 * A[i, j]))
    return e


def _softmax_cols(scores: list[Column], levels: list[str], prefix: str = "prob_") -> list[Column]:
    m = F.greatest(*scores) if len(scores) > 1 else scores[0]
    ex = [F.exp(s - m) for s in scores]
    tot = reduce(lambda a, b: a + b, ex)
    return [(e / tot).alias(f"{prefix}{lv}") for e, lv in zip(ex, levels)]


def _argmax_col(levels: list[str], prefix: str = "prob_") -> Column:
    if len(levels) == 1:
        return F.lit(levels[0])
    best = F.greatest(*[F.struct(F.col(f"{prefix}{lv}").alias("p"), F.lit(-i).alias("o"),
                                 F.lit(lv).alias("c")) for i, lv in enumerate(levels)])
    return best["c"]


@dataclass
class Probabilistic:
    """Shared predict: add prob_<level> columns and the argmax class."""
    features: object
    levels: list

    def scores(self, x: Column) -> list[Column]:
        raise NotImplementedError

    def predict(self, df: DataFrame, keep=None, pred_col: str = "predicted") -> DataFrame:
        keep = df.columns if keep is None else keep
        x = feature_array(df, self.features)
        probs = _softmax_cols(self.scores(x), [str(lv) for lv in self.levels])
        out = df.select(*keep, *probs)
        return out.withColumn(pred_col, _argmax_col([str(lv) for lv in self.levels]))


def _moments(df: DataFrame, features, target: str):
    x = feature_array(df, features)
    d = df.select(F.size(x).alias("d")).head(1)[0]["d"]
    shift = column_means(df, x, d)
    return grouped_moments(df, x, target, shift), d


@dataclass
class GaussianDA(Probabilistic):
    """H2/H3/H4: LDA (pooled covariance), QDA (per class), RDA (blend)."""
    priors: np.ndarray = None
    means: np.ndarray = None
    covs: np.ndarray = None       # per class covariance used for scoring
    kind: str = "lda"
    scaling: np.ndarray | None = None

    def scores(self, x: Column) -> list[Column]:
        out = []
        if self.kind == "lda":
            inv = np.linalg.inv(self.covs[0])
            for k in range(len(self.levels)):
                w = inv @ self.means[k]
                b = -0.5 * self.means[k] @ w + math.log(self.priors[k])
                out.append(_dot(x, w, b))
        else:
            for k in range(len(self.levels)):
                inv = np.linalg.inv(self.covs[k])
                _, logdet = np.linalg.slogdet(self.covs[k])
                out.append(F.lit(float(math.log(self.priors[k]) - 0.5 * logdet)) - 0.5 * _quad(x, self.means[k], inv))
        return out

    def discriminant_scores(self, df: DataFrame, keep=None) -> DataFrame:
        """LD1.. coordinates (LDA): centred on the prior-weighted mean."""
        keep = df.columns if keep is None else keep
        x = feature_array(df, self.features)
        xbar = self.priors @ self.means
        return df.select(*keep, *[_dot(x, self.scaling[:, j], -float(xbar @ self.scaling[:, j])).alias(f"LD{j + 1}")
                                  for j in range(self.scaling.shape[1])])


def _lda_scaling(pooled: np.ndarray, means: np.ndarray, priors: np.ndarray, n: float) -> np.ndarray:
    """Discriminant directions: S_w^-1 S_b eigenvectors normalised to unit
    within-class variance (v^T S_w v = 1), largest eigenvalue first."""
    k = means.shape[0]
    xbar = priors @ means
    dm = means - xbar
    Sb = (dm.T * (n * priors)) @ dm / max(k - 1, 1)
    L = np.linalg.cholesky(pooled)
    Li = np.linalg.inv(L)
    M = Li @ Sb @ Li.T
    w, v = np.linalg.eigh(M)
    order = np.argsort(w)[::-1][:max(1, min(k - 1, means.shape[1]))]
    return Li.T @ v[:, order]


def fit_discriminant(df: DataFrame, features, target: str, kind: str = "lda", gamma: float = 0.0,
                     lam: float = 1.0, levels: list | None = None) -> GaussianDA:
    """LDA (``kind='lda'``), QDA (``'qda'``) or RDA (``'rda'`` with gamma,
    lambda).  Priors are the training class shares."""
    mom, d = _moments(df, features, target)
    groups = mom.groups
    lv = levels or groups
    idx = [groups.index(str(g)) for g in lv]
    return discriminant_from_moments(features, [str(x) for x in lv], mom.n[idx], mom.mean[idx],
                                     mom.scatter[idx], kind, gamma, lam)


def discriminant_from_moments(features, lv: list, n_k, means, scat, kind: str = "lda", gamma: float = 0.0,
                              lam: float = 1.0) -> GaussianDA:
    """The fit itself, from per-class (n, mean, scatter): d x d work only."""
    d = means.shape[1]
    n = n_k.sum()
    priors = n_k / n
    K = len(lv)
    pooled = scat.sum(0) / (n - K)
    if kind == "lda":
        return GaussianDA(features, lv, priors, means, np.array([pooled]), "lda",
                          _lda_scaling(pooled, means, priors, n))
    per = np.array([scat[k] / (n_k[k] - 1) for k in range(K)])
    if kind == "qda":
        return GaussianDA(features, lv, priors, means, per, "qda")
    if kind == "rda":
        covs = []
        for k in range(K):
            s_ = (1 - lam) * per[k] + lam * pooled
            s_ = (1 - gamma) * s_ + gamma * np.trace(s_) / d * np.eye(d)
            covs.append(s_)
        return GaussianDA(features, lv, priors, means, np.array(covs), "rda")
    raise ValueError(f"unknown discriminant {kind!r}")


def polynomial_columns(df: DataFrame, features: list[str], degree: int) -> tuple[DataFrame, list[str]]:
    """Polynomial expansion (products of features up to ``degree``)."""
    from itertools import combinations_with_replacement
    cols, names = [], []
    for deg in range(1, degree + 1):
        for combo in combinations_with_replacement(features, deg):
            name = "_x_".join(combo)
            e = reduce(lambda a, b: a * b, [F.col(c).cast("double") for c in combo])
            cols.append(e.alias(name))
            names.append(name)
    return df.select("*", *[c for c, n in zip(cols, names) if n not in df.columns]), names


@dataclass
class FDAModel:
    degree: int
    features: list
    lda: GaussianDA

    def predict(self, df: DataFrame, keep=None, pred_col: str = "predicted") -> DataFrame:
        x, _ = polynomial_columns(df, self.features, self.degree)
        return self.lda.predict(x, keep=df.columns if keep is None else keep, pred_col=pred_col)


def fit_fda(df: DataFrame, features: list[str], target: str, degree: int = 1) -> FDAModel:
    """H5: flexible discriminant analysis by optimal scoring on a polynomial
    basis; the classes of degree 1 are those of LDA."""
    x, names = polynomial_columns(df, features, degree)
    return FDAModel(degree, features, fit_discriminant(x, names, target, "lda"))


@dataclass
class GaussianNB(Probabilistic):
    """Gaussian naive Bayes (sample sd per class and feature)."""
    priors: np.ndarray = None
    means: np.ndarray = None
    sds: np.ndarray = None

    def scores(self, x: Column) -> list[Column]:
        out = []
        for k in range(len(self.levels)):
            e = F.lit(float(math.log(self.priors[k]) - np.log(self.sds[k]).sum()
                            - 0.5 * len(self.sds[k]) * math.log(2 * math.pi)))
            for i in range(len(self.sds[k])):
                z = (x[i] - F.lit(float(self.means[k, i]))) / F.lit(float(self.sds[k, i]))
                e = e - 0.5 * z * z
            out.append(e)
        return out


def fit_naive_bayes(df: DataFrame, features, target: str, levels: list | None = None) -> GaussianNB:
    mom, d = _moments(df, features, target)
    lv = levels or mom.groups
    idx = [mom.groups.index(str(g)) for g in lv]
    return nb_from_moments(features, [str(x) for x in lv], mom.n[idx], mom.mean[idx], mom.scatter[idx])


def nb_from_moments(features, lv: list, n_k, means, scat) -> GaussianNB:
    var = np.array([np.diag(scat[i]) / (n_k[i] - 1) for i in range(len(lv))])
    return GaussianNB(features, lv, n_k / n_k.sum(), means, np.sqrt(var))


# ------------------------------------------------------------------ H17

ACTIVATIONS = ("linear", "relu", "sigmoid", "softmax")


def dense_forward(df: DataFrame, features, weights: np.ndarray, bias: np.ndarray,
                  activation: str = "relu", keep=(), prefix: str = "z") -> DataFrame:
    """z = W x + b with ReLU, sigmoid or softmax, as column expressions.
    ``weights`` has one row per output unit."""
    x = feature_array(df, features)
    W = np.atleast_2d(weights)
    z = [_dot(x, W[j], float(bias[j])) for j in range(W.shape[0])]
    if activation == "relu":
        out = [F.greatest(c, F.lit(0.0)) for c in z]
    elif activation == "sigmoid":
        out = [1 / (1 + F.exp(-c)) for c in z]
    elif activation == "softmax":
        out = [c for c in _softmax_cols(z, [str(j + 1) for j in range(len(z))], prefix)]
        return df.select(*keep, *out)
    elif activation == "linear":
        out = z
    else:
        raise ValueError(f"activation must be one of {ACTIVATIONS}")
    return df.select(*keep, *[c.alias(f"{prefix}{j + 1}") for j, c in enumerate(out)])


# ------------------------------------------------------------------ H6

def knn_classify(train: DataFrame, key: str, features, target: str, k: int,
                 query: DataFrame | None = None, levels: list | None = None) -> DataFrame:
    """H6: k nearest training rows vote; probabilities are vote shares; the
    class is the most voted (ties to the first level).  Without ``query``
    the training rows are classified leave-one-out."""
    from vela.operators.neighbors import knn
    lv = levels or sorted(str(r) for r in _levels(train, target, None))
    nn = knn(query if query is not None else train, key, features, k,
             reference=train if query is not None else None)
    return knn_votes(nn, train, key, target, lv)


def knn_votes(nn: DataFrame, train: DataFrame, key: str, target: str, lv: list) -> DataFrame:
    """H6: vote shares and class of every row from its neighbours (key, neighbor)."""
    lab = train.select(F.col(key).alias("neighbor"), F.col(target).alias("__y"))
    votes = nn.join(lab, "neighbor").groupBy(key).agg(
        *[(F.sum((F.col("__y").cast("string") == F.lit(str(c))).cast("int")) / F.count(F.lit(1))).alias(f"prob_{c}")
          for c in lv])
    return votes.withColumn("predicted", _argmax_col([str(c) for c in lv]))


# ------------------------------------------------------------------ ml-backed models

def _index_expr(target: str, levels: list) -> Column:
    m = F.create_map(*[x for i, lv in enumerate(levels) for x in (F.lit(str(lv)), F.lit(float(i)))])
    return m[F.col(target).cast("string")]


def _spread(df: DataFrame) -> DataFrame:
    from vela.operators.cluster import spread
    return spread(df)


@dataclass
class MLModel:
    """A fitted ``pyspark.ml`` classifier with our level order.

    ``featurize`` maps the feature array to the model's vector column (the
    identity, a polynomial expansion or random Fourier features), so scoring
    stays a column expression plus the model's own transform."""
    model: object
    features: object
    levels: list
    featurize: object = None
    calibration: tuple | None = None   # (a, b): p = sigmoid(a * margin + b) for SVMs
    name: str = ""
    class_calibration: list | None = None   # the same for each one-vs-rest score
    glm: bool = False                  # binomial GLM: ``prediction`` is P(second level)

    def _vec(self, df: DataFrame) -> DataFrame:
        from pyspark.ml.functions import array_to_vector
        arr = feature_array(df, self.features)
        if self.featurize is not None:
            arr = self.featurize(arr)
        return df.withColumn("__f", array_to_vector(arr))

    def predict(self, df: DataFrame, keep=None, pred_col: str = "predicted") -> DataFrame:
        from pyspark.ml.functions import vector_to_array
        keep = df.columns if keep is None else keep
        out = self.model.transform(self._vec(df))
        lv = [str(x) for x in self.levels]
        if self.glm:
            p1 = F.col("prediction")
            probs = [(1 - p1).alias(f"prob_{lv[0]}"), p1.alias(f"prob_{lv[1]}")]
        elif self.calibration is not None:
            a, b = self.calibration
            margin = vector_to_array("rawPrediction")[1]
            p1 = 1 / (1 + F.exp(-(F.lit(a) * margin + F.lit(b))))
            probs = [(1 - p1).alias(f"prob_{lv[0]}"), p1.alias(f"prob_{lv[1]}")]
        elif "probability" in out.columns:
            pa = vector_to_array("probability")
            probs = [pa[i].alias(f"prob_{x}") for i, x in enumerate(lv)]
        else:
            # one-vs-rest: a calibrated score for each class, normalised to one
            raw = vector_to_array("rawPrediction")
            own = [1 / (1 + F.exp(-(F.lit(a) * raw[i] + F.lit(b)))) for i, (a, b) in enumerate(self.class_calibration)]
            out = out.withColumn("__own", F.array(*own))
            total = F.aggregate("__own", F.lit(0.0), lambda t, x: t + x)
            probs = [(F.col("__own")[i] / total).alias(f"prob_{x}") for i, x in enumerate(lv)]
        return out.select(*keep, *probs).withColumn(pred_col, _argmax_col(lv))

    def importances(self):
        return list(self.model.featureImportances.toArray()) if hasattr(self.model, "featureImportances") else None


def _train_frame(df: DataFrame, features, target: str, levels: list, featurize=None) -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    arr = feature_array(df, features)
    if featurize is not None:
        arr = featurize(arr)
    return _spread(df.select(array_to_vector(arr).alias("__f"), _index_expr(target, levels).alias("__y")))


def _levels(df: DataFrame, target: str, levels, limit: int = 10_000):
    if levels is not None:
        return [str(x) for x in levels]
    from vela.operators.patterns import bounded_collect
    rows = bounded_collect(df.select(target).distinct(), limit)
    if rows is None:
        raise ValueError(f"{target} has more than {limit} classes")
    return sorted(str(r[0]) for r in rows)


def fit_ml(df: DataFrame, features, target: str, estimator, levels=None, featurize=None,
           name: str = "") -> MLModel:
    lv = _levels(df, target, levels)
    tr = _train_frame(df, features, target, lv, featurize).cache()
    try:
        est = estimator.copy()
        est.setFeaturesCol("__f").setLabelCol("__y")
        model = est.fit(tr)
    finally:
        tr.unpersist()
    return MLModel(model, features, lv, featurize, None, name)


def fit_logistic(df, features, target, levels=None, reg: float = 0.0, max_iter: int = 100,
                 tol: float = 1e-10) -> MLModel:
    """H1: unpenalised logistic regression.  Two classes: binomial GLM by
    IRLS (ml ``GeneralizedLinearRegression``, as R's ``glm``: one d x d
    weighted least-squares aggregate per iteration, converging in a handful
    of iterations); P(second level) is modelled, as in R.  More classes:
    multinomial ``LogisticRegression``."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.regression import GeneralizedLinearRegression
    lv = _levels(df, target, levels)
    if len(lv) == 2 and reg == 0.0:
        m = fit_ml(df, features, target, GeneralizedLinearRegression(
            family="binomial", link="logit", maxIter=25, tol=1e-8, regParam=0.0), lv, name="glm")
        m.glm = True
        return m
    fam = "binomial" if len(lv) == 2 else "multinomial"
    return fit_ml(df, features, target, LogisticRegression(regParam=reg, maxIter=max_iter, tol=tol,
                                                           family=fam, standardization=False),
                  lv, name="glm")


def fit_svm_linear(df, features, target, levels=None, C: float = 1.0, **params):
    """H7: linear SVM (hinge loss) with calibrated probabilities (``vela.operators.svm``)."""
    from vela.operators import svm
    return svm.fit_svm(df, features, target, {"kind": "linear"}, levels, C, name="svmLinear", **params)


def fit_svm_radial(df, features, target, levels=None, C: float = 1.0, sigma: float | None = None, landmarks: int = 200, seed: int = 7, **params):
    """H8: radial-kernel SVM over a landmark map; ``sigma`` is estimated from the data when not given."""
    from vela.operators import svm
    sigma = sigma or svm.estimate_sigma(df, features)
    return svm.fit_svm(df, features, target, svm.landmark_map(df, features, sigma, landmarks, seed), levels, C, name="svmRadial", **params)


def fit_svm_poly(df, features, target, levels=None, degree: int = 2, scale: float = 1.0, C: float = 1.0, **params):
    """H9: polynomial-kernel SVM on its explicit monomials."""
    from vela.operators import svm
    return svm.fit_svm(df, features, target, {"kind": "poly", "degree": degree, "scale": scale}, levels, C, name="svmPoly", **params)


def fit_tree(df, features, target, levels=None, cp: float = 0.01, **params):
    """Classification tree with cost-complexity pruning (``vela.operators.tree``)."""
    from vela.operators import tree
    return tree.fit_tree(df, features, target, levels=levels, cp=cp, **params)


def tree_rules(model, df: DataFrame, target: str) -> DataFrame:
    """Per leaf the rule text and, over the rows of ``df``, their number and class shares."""
    lv = [str(x) for x in model.levels]
    seen = df.select(model.leaf_column(feature_array(df, model.features)).cast("long").alias("leaf"), F.col(target).cast("string").alias("__y"))
    shares = seen.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), *[F.avg((F.col("__y") == x).cast("double")).alias(f"share_{x}") for x in lv])
    return model.rules(df.sparkSession).select("leaf", "rule", "predicted").join(shares, "leaf")


def fit_forest(df, features, target, levels=None, n_trees: int = 500, mtry: str = "sqrt",
               seed: int = 1, max_depth: int = 12, bagging: bool = False) -> MLModel:
    """H13 (and H11 with ``bagging=True``: every feature at every split)."""
    from pyspark.ml.classification import RandomForestClassifier
    est = RandomForestClassifier(numTrees=n_trees, featureSubsetStrategy="all" if bagging else mtry,
                                 bootstrap=True, seed=seed, maxDepth=max_depth, maxBins=64)
    return fit_ml(df, features, target, est, levels, name="treebag" if bagging else "rf")


def fit_gbt(df, features, target, levels=None, n_iter: int = 100, depth: int = 3, step: float = 0.1,
            seed: int = 1) -> MLModel:
    """Gradient boosting (logistic loss); one-vs-rest with > 2 classes."""
    from pyspark.ml.classification import GBTClassifier, OneVsRest
    lv = _levels(df, target, levels)
    gbt = GBTClassifier(maxIter=n_iter, maxDepth=depth, stepSize=step, seed=seed, maxBins=64)
    est = gbt if len(lv) == 2 else OneVsRest(classifier=gbt)
    m = fit_ml(df, features, target, est, lv, name="gbm")
    if len(lv) > 2:      # a boosted margin is half the log-odds
        m.class_calibration = [(2.0, 0.0)] * len(lv)
    return m


def gbt_loss_history(model: MLModel, df: DataFrame, target: str) -> list:
    """Training loss after each boosting iteration (binary models)."""
    x = model._vec(df).withColumn("__y", _index_expr(target, model.levels))
    m = model.model
    m.setFeaturesCol("__f")
    return list(m.evaluateEachIteration(x.withColumnRenamed("__y", m.getLabelCol())))


# ------------------------------------------------------------------ H18

def _wrap_closed(fn):
    def fit(df, features, target, levels=None, **kw):
        return fn(df, features, target, levels=levels, **kw)
    return fit


CLASSIFIERS = {
    "glm": fit_logistic,
    "lda": lambda df, f, t, levels=None, **kw: fit_discriminant(df, f, t, "lda", levels=levels),
    "qda": lambda df, f, t, levels=None, **kw: fit_discriminant(df, f, t, "qda", levels=levels),
    "rda": lambda df, f, t, levels=None, gamma=0.0, lam=1.0, **kw:
        fit_discriminant(df, f, t, "rda", gamma=gamma, lam=lam, levels=levels),
    "nb": lambda df, f, t, levels=None, **kw: fit_naive_bayes(df, f, t, levels=levels),
    "svmLinear": fit_svm_linear,
    "svmRadial": fit_svm_radial,
    "svmPoly": fit_svm_poly,
    "rpart": fit_tree,
    "treebag": lambda df, f, t, levels=None, **kw: fit_forest(df, f, t, levels, bagging=True, **kw),
    "rf": fit_forest,
    "gbm": fit_gbt,
    "fda": lambda df, f, t, levels=None, degree=1, **kw: fit_fda(df, f, t, degree),
    "mlp": lambda df, f, t, levels=None, key=None, **kw: _fit_mlp(df, f, t, levels, key, **kw),
}


def _fit_mlp(df, features, target, levels, key, **kw):
    from vela.operators.nets import fit_mlp
    if key is None:
        raise ValueError("mlp needs a key column")
    return fit_mlp(df, features, target, key, levels=levels, **kw)
# models that need standardised inputs (distance or margin based)
SCALED_MODELS = {"knn", "svmLinear", "svmRadial", "svmPoly"}


@dataclass
class KNNModel:
    train: DataFrame
    key: str
    features: object
    target: str
    k: int
    levels: list

    def predict(self, df: DataFrame, keep=None, pred_col: str = "predicted") -> DataFrame:
        keep = df.columns if keep is None else keep
        v = knn_classify(self.train, self.key, self.features, self.target, self.k, query=df, levels=self.levels)
        v = v.withColumnRenamed("predicted", pred_col)
        return df.select(*keep).join(v, self.key) if self.key in keep else df.select(*keep, self.key).join(v, self.key)


def fit_classifier(name: str, df: DataFrame, features, target: str, levels=None, key: str | None = None,
                   **params):
    """Fit a classifier by name; unknown names are an error."""
    if name == "knn":
        if key is None:
            raise ValueError("knn needs a key column")
        return KNNModel(df, key, features, target, params.get("k", 5), _levels(df, target, levels))
    if name not in CLASSIFIERS:
        raise ValueError(f"unknown classifier {name!r}; choose from {sorted(CLASSIFIERS) + ['knn']}")
    if name == "mlp":
        return CLASSIFIERS[name](df, features, target, levels=levels, key=key, **params)
    return CLASSIFIERS[name](df, features, target, levels=levels, **params)


def fit_many(names: list[str], df: DataFrame, features, target: str, levels=None, key=None,
             on_error: str = "raise", params: dict | None = None) -> dict:
    """Fit several classifiers; with ``on_error='skip'`` a failing model is
    left out (and reported) instead of stopping the others."""
    out, errors = {}, {}
    for n in names:
        try:
            out[n] = fit_classifier(n, df, features, target, levels, key, **((params or {}).get(n, {})))
        except Exception as e:  # noqa: BLE001
            if on_error != "skip":
                raise
            errors[n] = str(e)
    out["__errors__"] = errors
    return out
