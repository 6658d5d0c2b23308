import math

import pandas as pd
from pyspark.sql import functions as F

from vela.operators import clean, split, profile


def test_split_sizes_are_ceil_and_medians_ignore_test(spark):
    pdf = pd.DataFrame({"k": range(700), "y": ["a"] * 458 + ["b"] * 242, "x": [float(i) for i in range(700)]})
    df = spark.createDataFrame(pdf)
    _, tr, te = split.stratified_split(df, "y", "k", 0.8, 1995)
    sizes = {r[0]: r[1] for r in tr.groupBy("y").count().collect()}
    assert sizes == {"a": math.ceil(0.8 * 458), "b": math.ceil(0.8 * 242)}
    tr2, te2, med = clean.impute_median_train(tr, te.withColumn("x", F.lit(None).cast("double")), ["x"])
    assert med["x"] == tr.toPandas().x.median()


def test_folds_balanced(spark):
    df = spark.createDataFrame(pd.DataFrame({"k": range(103), "y": ["a"] * 50 + ["b"] * 53}))
    f = split.stratified_folds(df, "y", "k", 5, 2).toPandas().merge(df.toPandas(), on="k")
    per = f.groupby(["repeat", "y", "fold"]).size()
    assert per.groupby(["repeat", "y"]).agg(lambda s: s.max() - s.min()).max() <= 1


def test_nonfinite_blank_and_unique_ids(spark):
    df = spark.createDataFrame([(1, float("nan"), " ", "A"), (2, float("inf"), "x", "A"), (3, 1.0, "", "B")],
                               "k int, v double, s string, id string")
    out = clean.blank_to_null(clean.nonfinite_to_null(df)).orderBy("k").collect()
    assert out[0]["v"] is None and out[1]["v"] is None and out[0]["s"] is None and out[2]["s"] is None
    ids = clean.make_unique_ids(df, "id", "k").orderBy("k").collect()
    assert [r["id"] for r in ids] == ["A", "A_rep1", "B"]


def test_encode_target_make_names(spark):
    df = spark.createDataFrame([("1-URGENT",), ("no",), ("if",)], "y string")
    _, tgt = clean.encode_target(df, "y", positive="no")
    assert tgt.levels[0] == "no" and set(tgt.levels) == {"X1.URGENT", "no", "if."}


def test_profile_counts(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = profile.profile(df).collect()[0]
    assert (r["n_rows"], r["n_duplicate_rows"], r["n_null_cells"]) == (3, 1, 2)


def test_csv_roundtrip_with_decimal_comma(spark, tmp_path):
    from vela.sources import read_csv_checked
    p = tmp_path / "t.csv"
    p.write_text("a;b;c\n1,5;x;NA\n2;y;3\n")
    df = read_csv_checked(spark, str(p), sep=";", dec=",")
    rows = df.orderBy("b").collect()
    assert rows[0]["a"] == 1.5 and rows[0]["c"] is None
