"""The seeded order is random over the keys, and seeds, repeats and columns are independent."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from vela.operators import clean, evaluate, split


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(12_000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("y"), F.col("id").cast("double").alias("u"),
                                      F.col("id").cast("double").alias("v"), F.concat(F.lit("ID_"), F.col("id").cast("string")).alias("t"))


def test_sample_is_spread_over_the_keys(table):
    k = np.array([r.k for r in split.sample_n(table, 1000, 7, "k").collect()])
    assert len(k) == 1000 and abs(k.mean() - 6000) < 4 * 3464 / np.sqrt(1000)
    assert (np.histogram(k, bins=10, range=(0, 12000))[0] > 60).all()
    other = {r.k for r in split.sample_n(table, 1000, 8, "k").collect()}
    assert len(other & set(k.tolist())) < 160


@pytest.mark.parametrize("key", ["k", "t"])
def test_split_is_not_by_key(table, key):
    _, train, test = split.stratified_split(table, "y", key)
    a, b = (np.array([r.u for r in x.select("u").collect()]) for x in (train, test))
    assert len(a) == 9600 and abs(a.mean() - b.mean()) < 4 * 3464 * np.sqrt(1 / 9600 + 1 / 2400)


def test_repeats_are_independent(table):
    f = split.stratified_folds(table, "y", "k", 5, 3).toPandas().pivot(index="k", columns="repeat", values="fold")
    for a, b in ((1, 2), (1, 3), (2, 3)):
        assert abs((f[a] == f[b]).mean() - 0.2) < 0.02
    assert len(f.value_counts()) == 125


def test_columns_are_blanked_independently(table):
    out = clean.inject_nulls(table.select("k", "u", "v"), ["u", "v"], 0.12, 42, "k").toPandas()
    assert out.u.isna().sum() == out.v.isna().sum() == 1440
    assert abs((out.u.isna() & out.v.isna()).mean() - 0.12 ** 2) < 0.005
    assert abs(out.k[out.u.isna()].mean() - 6000) < 4 * 3464 / np.sqrt(1440)


def test_integer_median_is_the_midpoint(spark):
    df = spark.createDataFrame([(309,), (310,), (None,)], "x int")
    out, medians = clean.impute_median(df, ["x"])
    assert medians["x"] == 309.5 and sorted(r.x for r in out.collect()) == [309, 309.5, 310]


def test_unique_ids_skip_names_that_are_taken(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a_rep1"), (4, "a"), (5, "a_rep3"), (6, "a_rep1")], "o int, id string")
    got = [r.id for r in clean.make_unique_ids(df, "id", "o").orderBy("o").collect()]
    assert got == ["a", "a_rep2", "a_rep1", "a_rep4", "a_rep3", "a_rep1_rep1"]


def test_auc_guards(spark):
    rows = [("p", 0.9), ("n", 0.1), ("p", None)]
    for bad in (rows, [("p", 0.9), ("p", 0.2)], [("p", float("nan")), ("n", 0.1)]):
        df = spark.createDataFrame(bad, "y string, s double")
        for f in (evaluate.auc, evaluate.pr_curve, evaluate.pr_auc):
            with pytest.raises(ValueError):
                f(df, "y", "s", "p").collect()


def test_one_outlier_key_does_not_fill_a_bucket(spark):
    from vela.operators.patterns import balanced_buckets
    df = spark.range(2000).select(F.when(F.col("id") == 0, 10 ** 12).otherwise(F.col("id")).alias("o"))
    sizes = [r["count"] for r in balanced_buckets(df, "o", "b", 20).groupBy("b").count().collect()]
    assert max(sizes) < 300
    ids = clean.sequential_ids(df, "o").orderBy("o").collect()
    assert [r.id for r in ids[:2]] == ["M001", "M002"] and ids[-1].id == "M2000"


def test_identical_points_give_k_neighbours_each(spark):
    from vela.operators import neighbors
    df = spark.createDataFrame([(i, 1.0, 2.0) for i in range(300)], "k long, a double, b double")
    nn = neighbors.knn(df, "k", ["a", "b"], 5).toPandas()
    assert len(nn) == 1500
    assert sorted(nn[nn.k == 250].neighbor) == [0, 1, 2, 3, 4] and sorted(nn[nn.k == 0].neighbor) == [1, 2, 3, 4, 5]
