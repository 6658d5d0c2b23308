import math
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vela.llm.packing import best_fit_decreasing, best_fit_pack, lower_bound, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_packed(rows, capacity=2048):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def check_pieces(rows, docs):
    model = Tokenizer.from_file(PATH)
    expected = []
    for r in docs:
        ids = model.encode(r.text or "", add_special_tokens=False).ids + [0]
        expected += [(r.doc_id, n, s, len(ids[s:s + 2048]), zlib.crc32(np.array(ids[s:s + 2048], dtype="<u4").tobytes())) for n, s in enumerate(range(0, len(ids), 2048))]
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(expected)
    return sum(x[3] for x in expected)


def test_documents(docs):
    rows = best_fit_pack(docs, PATH).collect()
    tokens = check_pieces(rows, docs.collect())
    assert check_packed(rows) <= math.ceil(tokens / 2048) * 1.01 + 1


def test_odd_rows(spark, odd, empty):
    special = odd.select("doc_id", "text").union(spark.createDataFrame([(20, "a <|endoftext|>b\x1cc　d\x85e É"), (21, "İI ǅ ﬁ")], "doc_id long, text string"))
    rows = best_fit_pack(special, PATH).collect()
    check_pieces(rows, special.collect())
    check_packed(rows)
    assert best_fit_pack(empty, PATH).count() == 0


def test_exchange_rounds_save_bins(spark):
    rng = np.random.default_rng(8)
    rows = [(i, 0, 0, int(x)) for i, x in enumerate(rng.integers(300, 1500, 600))]
    df = spark.createDataFrame(rows, "id long, piece int, start long, length long")
    many = pack(df, part_rows=60, rounds=0).collect()
    again = pack(df, part_rows=60).collect()
    assert len(again) == 600 and {(r.id, r.length) for r in again} == {(r[0], r[3]) for r in rows}
    assert check_packed(again) <= check_packed(many)
    with pytest.raises(ValueError):
        pack(spark.createDataFrame([(1, 0, 0, 3000)], df.schema))


def least_bins(sizes, capacity):
    """Fewest bins by search over placements."""
    best = len(sizes)

    def place(k, loads):
        nonlocal best
        if len(loads) >= best:
            return
        if k == len(sizes):
            best = len(loads)
            return
        tried = set()
        for b, load in enumerate(loads):
            if load + sizes[k] <= capacity and load not in tried:
                tried.add(load)
                place(k + 1, [*loads[:b], load + sizes[k], *loads[b + 1:]])
        place(k + 1, [*loads, sizes[k]])

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=8))
def test_bound_and_packing_bracket_the_optimum(sizes):
    x = np.array(sorted(sizes, reverse=True))
    bins, offsets, fill = best_fit_decreasing(x, 20)
    assert lower_bound(x, 20) <= least_bins(x.tolist(), 20) <= len(fill)
    for b in range(len(fill)):
        own = np.flatnonzero(bins == b)
        own = own[np.argsort(offsets[own])]
        assert list(offsets[own]) == list(np.r_[0, np.cumsum(x[own])][:-1]) and x[own].sum() == fill[b] <= 20
