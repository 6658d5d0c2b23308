"""Probabilities of one-vs-rest classifiers."""
import numpy as np
import pytest

from vela.operators import classify


@pytest.mark.parametrize("fit", [lambda df: classify.fit_svm_linear(df, ["x1", "x2", "x3"], "cluster"),
                                 lambda df: classify.fit_gbt(df, ["x1", "x2", "x3"], "cluster", n_iter=4)])
def test_scores_are_probabilities_and_beat_the_shares(blobs, fit):
    out = fit(blobs).predict(blobs).toPandas()
    p = out[["prob_c1", "prob_c2", "prob_c3"]].to_numpy()
    assert np.allclose(p.sum(1), 1) and (p > 0).all() and (p < 1).all()
    own = p[np.arange(len(out)), out.cluster.str[1:].astype(int) - 1]
    assert -np.log(own).mean() < np.log(3) / 2
    assert (out.predicted == out.cluster).mean() > 0.95
