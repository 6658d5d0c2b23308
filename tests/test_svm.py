"""The duality gap certifies the SVMs; feature maps give their kernels; probabilities come from held-out margins."""
import numpy as np
import pytest

from vela.operators import classify, svm


@pytest.fixture(scope="module")
def moons(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(400, 2))
    y = np.where(X[:, 0] ** 2 + X[:, 1] ** 2 + 0.3 * rng.normal(size=400) > 1.3, "out", "in")
    return spark.createDataFrame([(i, float(a), float(b), str(c)) for i, ((a, b), c) in enumerate(zip(X, y))], "key long, x1 double, x2 double, y string").repartition(3), X, y


def test_gap_bounds_the_objective(moons):
    """Weak duality: no weights are better by more than the gap; random and fine-tuned ones are not."""
    df, X, y = moons
    m = classify.fit_svm_poly(df, ["x1", "x2"], "y", degree=2, C=1.0)
    assert 0 <= m.gap <= 1e-3
    Z, s, R = svm.mapped(X, m.kernel), np.where(y == "out", 1.0, -1.0), np.r_[np.ones(5), svm._BIAS]
    value = lambda w: 0.5 * (R * w * w).sum() + np.maximum(0, 1 - s * (Z @ w)).sum()
    w = np.array(m.weights[0])
    rng = np.random.default_rng(0)
    for scale in (1e-3, 1e-2, 0.1, 1):
        for _ in range(50):
            assert value(w + scale * rng.normal(size=len(w))) >= value(w) * (1 - m.gap) - 1e-9
    out = m.predict(df, keep=["key", "y"]).toPandas()
    assert (out.predicted == out.y).mean() > 0.85
    assert np.allclose(out.prob_in + out.prob_out, 1)


def test_radial_and_linear(moons):
    df, X, y = moons
    r = classify.fit_svm_radial(df, ["x1", "x2"], "y", landmarks=60).predict(df, keep=["y"]).toPandas()
    line = classify.fit_svm_linear(df, ["x1", "x2"], "y").predict(df, keep=["y"]).toPandas()
    assert (r.predicted == r.y).mean() > 0.85 > (line.predicted == line.y).mean()
    # calibrated: the mean probability of a class is close to its share
    assert abs(r.prob_out.mean() - (y == "out").mean()) < 0.05


def test_maps_give_their_kernels():
    X = np.random.default_rng(4).normal(size=(12, 3))
    for degree, scale in ((2, 1.0), (3, 0.5)):
        Z = svm.mapped(X, {"kind": "poly", "degree": degree, "scale": scale})[:, :-1]
        assert np.allclose(Z @ Z.T + 1, (scale * X @ X.T + 1) ** degree)
    K = svm.radial_kernel(X, X, 0.4)
    w, V = np.linalg.eigh(K)
    Z = svm.mapped(X, {"kind": "radial", "sigma": 0.4, "landmarks": X.tolist(), "root": (V / np.sqrt(w)).tolist()})[:, :-1]
    assert np.allclose(Z @ Z.T, K)


def test_landmarks_are_distinct_rows(spark):
    df = spark.createDataFrame([([float(i % 5), 1.0],) for i in range(100)], "v array<double>")
    m = svm.landmark_map(df, "v", 0.5, landmarks=50)
    assert sorted(v[0] for v in m["landmarks"]) == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert svm.estimate_sigma(df, "v") > 0


def test_unfinished_fit_is_an_error(moons):
    with pytest.raises(RuntimeError, match="duality gap"):
        classify.fit_svm_linear(moons[0], ["x1", "x2"], "y", max_passes=2)


def test_large_tables_begin_at_a_share(spark, monkeypatch):
    """The weights of a share only save passes over all rows: the gap of all rows is as small as without."""
    rng = np.random.default_rng(9)
    X = rng.normal(size=(6000, 2))
    y = np.where(X[:, 0] + rng.normal(size=6000) > 0, "out", "in")
    df = spark.createDataFrame([(float(a), float(b), str(c)) for (a, b), c in zip(X, y)], "x1 double, x2 double, y string").repartition(3)
    cold = classify.fit_svm_linear(df, ["x1", "x2"], "y")
    monkeypatch.setattr(svm, "WARM_ROWS", 3000, raising=False)
    monkeypatch.setattr(svm, "_SHARE", 3, raising=False)
    counts, inner = [], svm._sums
    monkeypatch.setattr(svm, "_sums", lambda rows, *a: counts.append(rows.count()) or inner(rows, *a))
    warm = classify.fit_svm_linear(df, ["x1", "x2"], "y")
    assert warm.gap <= 1e-3 and counts.count(6000) == warm.passes < cold.passes and 1500 < counts[0] < 2500
    Z, s, R = np.hstack([X, np.ones((6000, 1))]), np.where(y == "out", 1.0, -1.0), np.r_[np.ones(2), svm._BIAS]
    value = lambda w: 0.5 * (R * w * w).sum() + np.maximum(0, 1 - s * (Z @ w)).sum()
    assert abs(value(np.array(warm.weights[0])) / value(np.array(cold.weights[0])) - 1) <= 1e-3


def test_margins_are_made_once(moons, monkeypatch):
    df, made = moons[0], []
    inner = svm._logistic
    monkeypatch.setattr(svm, "_logistic", lambda held, *a: made.append((held.columns, held.count())) or inner(held, *a), raising=False)
    classify.fit_svm_linear(df, ["x1", "x2"], "y")
    assert made == [(["cls", "m"], 400)]


def test_width_stays_while_only_the_gradient_is_left(monkeypatch):
    """Classes that the features do not tell apart: all rows of one lie on the hinge's kink, where ever smaller widths never ended."""
    rng = np.random.default_rng(3)
    X, cls, fold = rng.normal(size=(400, 2)), (rng.random(400) < 0.67).astype(int), rng.integers(0, 3, 400)

    def sums(rows, base, move, mus, kernel, targets, left_out):
        Z, out = svm.mapped(X, kernel), []
        for p in range(len(base)):
            own, y = fold != left_out[p], np.where(cls == targets[p], 1.0, -1.0)
            y, Zp = y[own], Z[own]
            out.append(svm._losses(Zp, y, y * (Zp @ base[p]), y * (Zp @ move[p]), mus[p]))
        return np.array(out)

    monkeypatch.setattr(svm, "_sums", sums)
    found, mus, _, gaps, done, passes = svm._steps(None, 400, 0, 6, {"kind": "poly", "degree": 2, "scale": 1.0}, np.ones(4), np.array([-1, 0, 1, 2]), 100.0, 1e-3, 200)
    assert done and gaps.max() <= 1e-3 and passes < 100 and mus.min() > 1e-6
