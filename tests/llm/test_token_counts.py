import public_tokenizers
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from vela.llm.queries import QUERIES
from vela.llm.token_counts import SPACE, UnigramCounter, count_tokens, vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")


def exact():
    pieces = vocabulary(PATH)
    return Tokenizer(Unigram([("<unk>", 0.0), *pieces, *((f"<0x{b:02X}>", 0.0) for b in range(256))], unk_id=0, byte_fallback=True))


def written(text):
    return (SPACE + text.replace(" ", SPACE)) if text else ""


def test_counts_equal_the_tokenizer(spark, sf, docs):
    model = exact()
    got = {r.doc_id: r.n_pieces for r in QUERIES["op8_token_counts"](spark, sf).collect()}
    assert got == {r.doc_id: len(model.encode(written(r.text or "")).ids) for r in docs.collect()}


def test_odd_rows(odd, empty):
    model = exact()
    got = sorted((r.doc_id, r.n_pieces) for r in count_tokens(odd, PATH).collect())
    assert got == sorted((r.doc_id, len(model.encode(written(r.text or "")).ids)) for r in odd.collect())
    assert count_tokens(empty, PATH).count() == 0


def test_ties_take_the_longest_last_piece():
    c = UnigramCounter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("c", -1.0), ("bc", -2.0), ("abc", -3.0)])
    assert c.best("abc") == (-3.0, 1)
    assert c.best("ab") == (-2.0, 1)
    assert c.best("abx") == (-2.0 + c.unknown, 2)


def test_a_vocabulary_that_crosses_spaces_runs_over_whole_texts(spark):
    import numpy as np
    c = UnigramCounter([(SPACE, -1.5), ("a", -1.0), (f"a{SPACE}a", -0.25)])
    assert not c.by_segment
    raw = b" a a"
    score, n = c.count(np.frombuffer(raw, dtype=np.uint8), np.array([0, len(raw)]))
    assert (score[0], n[0]) == (-1.75, 2)
