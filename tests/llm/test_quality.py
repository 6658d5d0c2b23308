import numpy as np
from pyspark.sql import functions as F

from vela.llm.quality import STATISTICS, fit_rules, score_quality, statistics_of, text_statistics
from vela.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = QUERIES["op5_quality"](spark, sf).join(labels, "doc_id").toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    held = got[got.held_out]
    assert (held.quality == held.predicted).mean() > 0.95


def test_rules_in_spark_equal_rules_in_numpy(spark, docs):
    stats = text_statistics(docs)
    x = np.array([[r[s] for s in STATISTICS] for r in stats.collect()])
    y = (x[:, STATISTICS.index("word_length")] > np.median(x[:, STATISTICS.index("word_length")])).astype(float)
    model = fit_rules(x, y)
    plain = 1 / (1 + np.exp(-(model.intercept + sum(w * r.holds(x) for r, w in model.rules))))
    assert model.rules and ((plain > 0.5) == y).mean() > 0.95
    got = np.sort([r.score for r in stats.select(model.column().alias("score")).collect()])
    assert np.allclose(got, np.sort(plain))


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 0), (2, 0), (6, 1), (7, 1), (8, None), (99, 1)], "doc_id long, quality int")
    got = score_quality(odd, labels)
    assert got.count() == odd.count() and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert score_quality(empty, labels).count() == 0
    none = score_quality(odd, labels.where("false")).select("score").distinct().collect()
    assert [round(r.score, 6) for r in none] == [0.5]
    assert score_quality(odd, labels.where("quality = 1")).select(F.min("score")).first()[0] > 0.9


def test_statistics_of_empty_and_simple_texts():
    from vela.llm import textbytes as tb
    import pyarrow as pa
    s = dict(zip(STATISTICS, statistics_of(*tb.buffers(pa.array(["", "ab ab AB 1!"])))[1]))
    assert s["repeat_share"] == 0.5 and s["distinct_share"] == 0.5 and abs(s["upper_share"] - 2 / 11) < 1e-12
    assert (statistics_of(*tb.buffers(pa.array(["", ""]))) == 0).all()
