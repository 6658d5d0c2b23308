"""A word and its complement after the Thue-Morse pattern: equal sums modulo 2**64 for every multiplier."""
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from vela.llm import textbytes as tb
from vela.llm.ngram_join import ngram_join
from vela.llm.packing import best_fit_pack
from vela.llm.suffix_tree_dedup import dedup_substrings, without_words
from vela.llm.token_counts import count_tokens


def thue_morse(n, a, b):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


ONE, TWO = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")


def test_words_differ():
    data = np.frombuffer((ONE + TWO).encode(), dtype=np.uint8)
    starts, ends = np.array([0, 1024]), np.array([1024, 2048])
    assert len(set(tb.span_hashes(tb.prefix_sums(tb.byte_values(data)), starts, ends).tolist())) == 1
    assert len(set(tb.word_hashes(data, starts, ends, lower=True).tolist())) == 2


@pytest.fixture
def pair(spark):
    rest = " ".join(f"w{i}" for i in range(19))
    return spark.createDataFrame([(1, f"{ONE} {rest}"), (2, f"{TWO} {rest}")], "doc_id long, text string")


def test_substring_dedup(pair):
    assert [r.n_removed for r in dedup_substrings(pair).collect()] == [0, 0]


def test_join(spark):
    df = spark.createDataFrame([(1, ONE), (2, TWO)], "doc_id long, text string")
    assert sorted(r.class_id for r in ngram_join(df).collect()) == [1, 2]


def test_packing_and_counts(spark):
    df = spark.createDataFrame([(1, f"{ONE} {TWO}"), (2, TWO)], "doc_id long, text string").coalesce(1)
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    import zlib
    want = {i: zlib.crc32(np.array(tok.encode(t, add_special_tokens=False).ids + [0], dtype="<u4").tobytes()) for i, t in ((1, f"{ONE} {TWO}"), (2, TWO))}
    assert {r.doc_id: r.ids_crc32 for r in best_fit_pack(df, path).collect()} == want
    model = public_tokenizers.path("piece_bpe_32k.model")
    together = {r.doc_id: tuple(r)[1:] for r in count_tokens(df, model).collect()}
    alone = {r.doc_id: tuple(r)[1:] for r in count_tokens(df.where("doc_id = 2"), model).collect()}
    assert together[2] == alone[2]


def test_cut_passages_leave_the_layout():
    text = "First paragraph here.\n\n- item one\n- item two\n\tcode  block\n"
    words = text.split()
    gone = lambda *at: np.isin(np.arange(len(words)), at)
    assert without_words(text, None) == text
    assert without_words(text, gone(3, 4, 5)) == "First paragraph here.\n- item two\n\tcode  block\n"
    assert without_words(text, gone(0, 1, 2)) == "- item one\n- item two\n\tcode  block\n"
    assert without_words(text, gone(9, 10)) == "First paragraph here.\n\n- item one\n- item two\n"
    assert without_words("a b", np.array([True, True])) == ""
