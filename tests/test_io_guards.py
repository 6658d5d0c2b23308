import numpy as np
import pytest

from vela.operators import classify, profile, split
from vela.sources import load_model, save_model


def test_save_and_load_model_give_same_scores(spark, blobs, tmp_path):
    m = classify.fit_discriminant(blobs, ["x1", "x2", "x3"], "cluster", "qda")
    save_model(spark, m, str(tmp_path / "qda"))
    back = load_model(spark, str(tmp_path / "qda"))
    a = m.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    b = back.predict(blobs, keep=["key"]).orderBy("key").toPandas()
    assert np.allclose(a.filter(like="prob_").values, b.filter(like="prob_").values)


def test_size_guards():
    assert split.clamp_k(10, 5, 3) == 3 and split.clamp_k(1, 100, 100) == 2
    assert split.neighbours_for(100) == 15 and split.neighbours_for(5) == 2
    assert split.max_perplexity(100) == 32
    assert split.min_pts_for(3, 100) == 6 and split.min_pts_for(3, 4) == 3


def test_require_columns_lists_available(spark, blobs):
    with pytest.raises(ValueError, match="available"):
        profile.require_columns(blobs, ["nope"])


def test_unknown_names_are_errors(spark, blobs):
    from vela.operators import reduce
    with pytest.raises(ValueError):
        classify.fit_classifier("nope", blobs, ["x1"], "cluster")
    with pytest.raises(ValueError):
        reduce.reduce(blobs, "nope", ["x1"])
