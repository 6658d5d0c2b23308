import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vela.llm.bwt_dedup import Shard, dedup_bytes, merge
from vela.llm.suffix_tree_dedup import dedup_substrings, internal_nodes, subtree


def order(rows):
    return sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def brute_bytes(rows, k=50):
    first, out = {}, []
    for i, text in order(rows):
        t = text.encode()
        gone = bytearray(len(t))
        for p in range(len(t) - k + 1):
            if first.setdefault(t[p:p + k], i) != i:
                gone[p:p + k] = b"\1" * k
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_words(rows, k=20):
    seen, out = set(), []
    for i, text in order(rows):
        w = text.encode().split()
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            key = tuple(w[p:p + k])
            if key in seen:
                gone[p:p + k] = [True] * k
            seen.add(key)
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def got_bytes(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=str)


def got_words(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()), key=str)


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


@pytest.mark.parametrize("options", [{}, {"part_bytes": 40_000}, {"part_bytes": 40_000, "hot": 2}])
def test_bytes_against_brute_force(docs, rows, options):
    assert got_bytes(dedup_bytes(docs, **options)) == brute_bytes(rows)


@pytest.mark.parametrize("options", [{}, {"part_bytes": 40_000, "group_suffixes": 50}])
def test_words_against_brute_force(docs, rows, options):
    assert got_words(dedup_substrings(docs, **options)) == brute_words(rows)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    for options in ({}, {"part_bytes": 3_000}):
        assert got_bytes(dedup_bytes(odd, **options)) == brute_bytes(rows)
        got = got_words(dedup_substrings(odd, **options))
        assert got == brute_words(rows)
    assert dedup_bytes(empty).count() == 0 and dedup_substrings(empty).count() == 0
    kept = dedup_substrings(odd).select("rest.*")
    assert kept.columns == ["id", "part", "node", "rest"]


def test_null_ids_come_first(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(3, text), (None, text), (7, text)], "doc_id long, text string")
    assert {(r.doc_id, r.n_removed) for r in dedup_substrings(df).collect()} == {(None, 0), (3, 30), (7, 30)}
    assert {(r.doc_id, r.n_removed > 0) for r in dedup_bytes(df).collect()} == {(None, False), (3, True), (7, True)}


def test_one_passage_in_a_third_of_the_rows(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    hot = " ".join(word() for _ in range(40))
    rows = []
    for i in range(300):
        own = [word() for _ in range(30)]
        rows.append((i, " ".join(own[:15] + ([hot] if i % 3 == 0 else []) + own[15:])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got_words(dedup_substrings(df, part_bytes=2_000, group_suffixes=20)) == brute_words(rows)
    assert got_bytes(dedup_bytes(df, part_bytes=2_000, hot=10)) == brute_bytes(rows)


def test_merge_finds_the_runs_of_sorted_windows():
    rng = np.random.default_rng(0)
    text = rng.choice(np.frombuffer(b"ab", dtype=np.uint8), 400)
    starts = np.arange(0, 390)
    shards = [Shard(text, starts[:100], 8, 3), Shard(text, starts[100:], 8, 3)]
    runs, common = merge(shards)
    run = np.concatenate(runs)
    windows = [text[s:s + 8].tobytes() for s in starts]
    by = {}
    for w, r in zip(windows, run):
        assert by.setdefault(w, r) == r
    assert len(set(by.values())) == len(by)
    assert (common > 0).sum() == len(windows) - len(by)


def test_subtree_nodes():
    s = np.array([[1, 2, 3], [1, 2, 3], [1, 2, 4], [5, 0, 0]], dtype=np.uint32)
    order, lcp = subtree(s)
    assert list(lcp) == [0, 3, 2, 0]
    assert list(internal_nodes(lcp, 3)) == [0, 2, 3] and list(internal_nodes(lcp, 2)) == [0, 3]
