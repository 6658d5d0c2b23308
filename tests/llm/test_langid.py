import numpy as np

from vela.llm.common import crc_mod
from vela.llm.langid import ByteCnn, fit_langid, identify, train_rows
from vela.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = QUERIES["op2_language_id"](spark, sf).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert len(held) and (held.lang == held.lang_pred).mean() > 0.95


def test_only_training_rows_teach(docs):
    assert train_rows(docs).where(crc_mod("doc_id", 4) == 2).count() == 0


def test_odd_rows(spark, docs, odd, empty):
    model = fit_langid(docs, max_docs=200, epochs=1)
    got = {r.doc_id: r for r in identify(odd, model, carry=["id", "part"]).collect()}
    assert [got[i].lang_pred for i in (1, 2, 3, 11, 12)] == ["und"] * 5 and got[11].score == 0
    assert got[4].lang_pred in model.langs and got[8].rest.id == "x"
    assert identify(empty, model).count() == 0
    assert fit_langid(empty) is None
    assert {r.lang_pred for r in identify(odd, None).collect()} == {"und"}


def test_pair_tables_equal_the_plain_convolution():
    m = ByteCnn(["a", "b"], length=32)
    x = np.random.default_rng(1).integers(0, 256, (5, 32)).astype(np.uint8)
    plain = np.concatenate([a.max(axis=1) for a in m.maps(x)], axis=1)
    assert np.allclose(m.pooled(x), plain, atol=1e-5)


def test_training_learns():
    rng = np.random.default_rng(3)
    x = np.stack([rng.choice(np.frombuffer(a, dtype=np.uint8), 64) for a in [b"abc "] * 150 + [b"bcd "] * 150])
    y = np.repeat([0, 1], 150)
    m = ByteCnn(["p", "q"], length=64).fit(x, y, epochs=4, batch=32)
    assert (m.softmax(m.pooled(x)).argmax(axis=1) == y).mean() > 0.97
