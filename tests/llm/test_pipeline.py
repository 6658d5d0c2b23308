import corpus_pipeline
from vela.llm.decontaminate import contaminated, decontaminate
from vela.llm.langid import UNDETERMINED


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


def test_stages_keep_the_columns(spark, sf, docs):
    now, columns = docs, docs.columns
    for name, f in corpus_pipeline.STAGES[:-1]:
        after = f(spark, now, sf).cache()
        assert after.columns == columns, name
        assert 0 < after.count() <= now.count()
        now = after
    packed = corpus_pipeline.STAGES[-1][1](spark, now, sf)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in now.collect()}
    assert corpus_pipeline.run(spark, sf).count() == packed.count()


def test_language_stage_rejects_texts_without_letters(spark, sf, docs):
    odd = spark.createDataFrame([(9001, None, None, "s", None), (9002, "%% 12", "en", "s", 5), (9003, "the and of this", None, "s", 15)], docs.schema)
    got = {r.doc_id: r for r in stage("language")(spark, docs.union(odd), sf).collect()}
    assert 9001 not in got and 9002 not in got and got[9003].lang not in (None, UNDETERMINED) and len(got) == docs.count() + 1


def test_near_duplicates_stage_keeps_one(spark, sf, docs):
    text = " ".join(f"w{i}" for i in range(100))
    rows = [(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, text + " more", "en", "s", 1), (4, "another text", "en", "s", 1), (1, text, "en", "s", 1), (5, None, None, None, None)]
    got = sorted(r.doc_id for r in stage("near_duplicates")(spark, spark.createDataFrame(rows, docs.schema), sf).collect())
    assert got == [1, 4, 5]


def test_near_duplicates_stage_with_null_and_repeated_ids(spark, sf, docs):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(100)) for x in "abcd")
    rows = [(None, a), (None, b), (None, b + " more"), (None, c), (None, None), (None, "%%"), (1, c), (2, d), (2, a + " x"), (2, "own words"), (3, d), (3, "other words"), (3, "other words"), (4, "alone"), (5, d)]
    got = stage("near_duplicates")(spark, spark.createDataFrame([(*r, "en", "s", 1) for r in rows], docs.schema), sf).collect()
    told = sorted(((r.doc_id, r.text) for r in got if not (r.text or "").startswith("b0 ")), key=str)
    assert told == sorted([(None, None), (None, "%%"), (1, c), (2, d), (2, a + " x"), (2, "own words"), (3, "other words"), (4, "alone")], key=str)
    assert len(got) == len(told) + 1


def test_language_stage_without_labels(spark, sf, docs):
    rows = [(1, "some words", None, "s", 1), (None, "mehr", None, "s", 1), (2, "%% 12", None, "s", 1), (3, None, None, "s", 1)]
    assert {r.text for r in stage("language")(spark, spark.createDataFrame(rows, docs.schema), sf).collect()} == {"some words", "mehr"}


def test_passage_stage_takes_effect(spark, sf, docs):
    passage = " ".join(f"p{i}" for i in range(60))
    lines = "Kept as it is.\n\n- one\n\tcode  block\r\n"
    rows = [(1, f"first {passage} end", "en", "s", 1), (2, f"second {passage} tail", "fr", "t", 1), (3, lines, "en", "s", 1), (4, f"{lines}{passage}\n\nfin\n", "en", "s", 1)]
    got = {r.doc_id: r for r in stage("repeated_passages")(spark, spark.createDataFrame(rows, docs.schema), sf).collect()}
    assert got[1].text == f"first {passage} end" and got[2].text == "second tail" and got[2].n_chars == 11 and got[2].lang == "fr"
    assert got[3].text == lines and got[4].text == "Kept as it is.\n\n- one\n\tcode  block\n\nfin\n"


def test_leak_stage_drops_contaminated(spark, sf, docs):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate(docs, benchmark).where(contaminated()).collect()}
    kept = {r.doc_id for r in stage("benchmark_leaks")(spark, docs, sf).collect()}
    assert bad and kept == {r.doc_id for r in docs.collect()} - bad


def test_empty_documents(spark, sf, empty):
    now = empty
    for _, f in corpus_pipeline.STAGES:
        now = f(spark, now, sf)
        assert now.count() == 0
