import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vela.operators.patterns import bucket_rank, exact_quantiles, grouped_moments, quantile_name, top_m_flag


@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_exact_quantiles_match_numpy_with_ties_and_a_hot_value(spark, accuracy):
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.normal(size=3000), np.full(2000, 0.25), rng.integers(0, 5, 1000)])
    pdf = pd.DataFrame({"g": ["a"] * 3000 + ["b"] * 3000, "v": vals})
    df = spark.createDataFrame(pdf)
    probs = [0.1, 0.25, 0.5, 0.75, 0.9]
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", probs, accuracy=accuracy).collect()}
    for g in "ab":
        want = np.quantile(pdf[pdf.g == g].v.to_numpy(), probs)  # numpy default = type 7
        for p, w in zip(probs, want):
            assert abs(got[g][quantile_name(p)] - w) < 1e-12


def test_bucket_rank_equals_row_number(spark):
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"k": np.arange(2000), "g": rng.integers(0, 3, 2000),
                        "h": rng.integers(0, 50, 2000).astype(float)})
    df = spark.createDataFrame(pdf)
    got = bucket_rank(df, ["g"], "h", "k", "r", n_buckets=7, lo=0, hi=50).toPandas().sort_values("k")
    want = pdf.sort_values(["g", "h", "k"]).groupby("g").cumcount() + 1
    assert (got.set_index("k")["r"] == want.sort_index().values).all()


def test_top_m_flag_is_exact_and_partition_independent(spark):
    pdf = pd.DataFrame({"k": np.arange(1000), "g": np.arange(1000) % 2, "h": (np.arange(1000) * 37) % 101})
    m = spark.createDataFrame([(0, 123), (1, 7)], "g long, m long")
    for parts in (1, 7):
        df = spark.createDataFrame(pdf).repartition(parts)
        got = top_m_flag(df, ["g"], "h", "k", m, "m", "f", n_buckets=5, lo=0, hi=101).toPandas()
        sizes = got[got.f].groupby("g").size().to_dict()
        assert sizes == {0: 123, 1: 7}
        first = pdf[pdf.g == 1].sort_values(["h", "k"]).k.head(7).tolist()
        assert sorted(got[(got.g == 1) & got.f].k) == sorted(first)


def test_grouped_moments(spark):
    rng = np.random.default_rng(3)
    X = rng.normal(size=(500, 3)) * [1, 10, 100] + 1e6
    pdf = pd.DataFrame({"g": np.where(np.arange(500) % 3 == 0, "a", "b"), "v": list(X)})
    df = spark.createDataFrame(pdf)
    m = grouped_moments(df, F.col("v"), "g", shift=X.mean(0))
    for i, g in enumerate(m.groups):
        sub = X[pdf.g.to_numpy() == g]
        assert m.n[i] == len(sub)
        assert np.allclose(m.mean[i], sub.mean(0))
        assert np.allclose(m.scatter[i] / (len(sub) - 1), np.cov(sub.T), rtol=1e-9)


def test_results_do_not_depend_on_partitioning(spark):
    from vela.operators import profile, split
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"k": np.arange(3000), "y": rng.choice(["a", "b", "c"], 3000, p=[.6, .3, .1]),
                        "v": np.round(rng.normal(size=3000), 2)})
    outs = []
    for parts in (1, 7):
        df = spark.createDataFrame(pdf).repartition(parts)
        q = exact_quantiles(df, ["y"], "v", [0.1, 0.5, 0.9]).orderBy("y").collect()
        f, _, _ = split.stratified_split(df, "y", "k", 0.7, 3)
        tr = sorted(r[0] for r in f.filter("is_train").select("k").collect())
        outs.append((q, tr))
    assert outs[0] == outs[1]
    df = spark.createDataFrame(pdf)
    a = profile.profile(df.unionAll(df)).collect()[0]
    b = profile.profile(df.unionAll(df), exact=False).collect()[0]
    assert a == b


def test_column_stats_are_exact_whatever_the_bounds(spark):
    import numpy as np
    from vela.operators.patterns import column_stats
    rng = np.random.default_rng(3)
    n = 20_000
    pdf = pd.DataFrame({"a": rng.normal(size=n), "b": rng.integers(0, 9, n).astype(float), "c": np.where(rng.random(n) < 0.3, np.nan, rng.exponential(size=n)), "d": 5.0})
    df = spark.createDataFrame(pdf).repartition(4).replace(float("nan"), None)
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    for kw in ({}, {"accuracy": 200, "limit": 2000}):
        got = column_stats(df, list("abcd"), probs, **kw)
        for c in "abcd":
            v = pdf[c].dropna().to_numpy()
            assert got[c].n == len(v) and abs(got[c].mean - v.mean()) < 1e-9
            assert np.allclose([got[c].quantiles[p] for p in probs], np.quantile(v, probs), rtol=0, atol=1e-12), (c, kw)
    empty = column_stats(df.filter("a > 100"), ["a"], [0.5])["a"]
    assert empty.n == 0 and empty.quantiles[0.5] is None
