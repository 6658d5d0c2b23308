"""Training-corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep
the columns of ``documents``.  A stage works on whatever its predecessor kept.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vela.llm.common import cut, hinted, read
from vela.llm.decontaminate import contaminated, decontaminate
from vela.llm.langid import UNDETERMINED, fit_langid, identify, train_rows
from vela.llm.ngram_join import ngram_join, with_set_name
from vela.llm.packing import best_fit_pack
from vela.llm.suffix_tree_dedup import dedup_substrings


def _rest(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def _restored(found: DataFrame, docs: DataFrame, **new) -> DataFrame:
    """The columns of ``docs`` from an operator's doc_id, text and rest, with new values where given."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text") if "text" in found.columns else None} | new
    return found.select(*[(own[c] if c in own else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay (no text or no letter: rejected); a missing lang is filled in, if any lang is there to learn from."""
    model = fit_langid(train_rows(docs))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify(docs, model, carry=_rest(docs)).where(F.col("lang_pred") != UNDETERMINED)
    return _restored(found, docs, lang=F.coalesce("rest.lang", "lang_pred"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies stays, that with the smallest doc_id (null last); texts without a word are no copies."""
    found = ngram_join(docs, firsts=True).select(F.col("doc_id").alias("__id"), F.col("node").alias("__node"), "first")
    of_id = found.groupBy("__id").agg(F.count(F.lit(1)).alias("__rows"), F.count_if("first").alias("__stay"))
    marked = cut(of_id.where("__rows > 1 OR __stay = 0"))  # ids that go or that several rows share
    held = docs.join(hinted(marked), docs.doc_id.eqNullSafe(marked["__id"]), "left")
    sole = held.where("__rows IS NULL").select(*docs.columns)
    shared = marked.where("__rows > 1 AND __stay > 0")
    if shared.isEmpty():
        return sole
    # the id does not tell these rows apart; their texts' sets do
    named = with_set_name(held.where("__rows > 1 AND __stay > 0").select(*docs.columns), "__set")
    firsts = found.where("first AND __node IS NOT NULL").join(hinted(shared.select(F.col("__id").alias("__same"))), F.col("__id").eqNullSafe(F.col("__same")), "left_semi")
    firsts = cut(firsts.select("__id", "__node").distinct())
    first = named.join(hinted(firsts), named.doc_id.eqNullSafe(firsts["__id"]) & (named["__set"] == firsts["__node"]), "left_semi")
    one = first.groupBy("doc_id", "__set").agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), "text").alias("__row")).select("__row.*")
    return sole.unionByName(named.where("__set IS NULL").select(*docs.columns)).unionByName(one)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays, without the passages that start earlier elsewhere; the rest of its layout stays too, n_chars follows the text."""
    found = dedup_substrings(docs, layout=True)
    return _restored(found, docs, text=F.col("kept"), n_chars=F.length("kept").cast("long"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"), carry=_rest(docs))
    return _restored(found.where(~contaminated()), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of the packed sequences."""
    return best_fit_pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("benchmark_leaks", benchmark_leaks), ("packing", packing)]

#: Language identification and tokenization have no SQL form; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
