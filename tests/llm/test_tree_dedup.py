import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vela.llm.tree_dedup import _layout, exact_dedup, merge_runs


def brute(rows, largest=True):
    """Groups of equal texts as (text, ids); null ids rank lowest (highest for the smallest)."""
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for t, ids in groups.items():
        order = sorted(ids, key=lambda i: (i is not None, i if i is not None else 0) if largest else (i is None, i if i is not None else 0))
        keep = order[-1] if largest else order[0]
        out += [(i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def got(df):
    rows = df.select("id", "keep_id", "group_size", F.lower(F.hex("digest")).alias("h"), "kept").collect()
    stays = {}
    for r in rows:
        stays[r.h] = stays.get(r.h, 0) + r.kept
        assert not r.kept or r.id == r.keep_id
    assert all(n == 1 for n in stays.values())
    return sorted(((r.id, r.keep_id, r.group_size, r.h) for r in rows), key=str)


@pytest.mark.parametrize("options", [{}, {"run_rows": 7, "fan_in": 2}, {"run_rows": 3, "fan_in": 3}])
@pytest.mark.parametrize("largest", [True, False])
def test_against_brute_force(spark, docs, options, largest):
    want = brute([(r.doc_id, r.text) for r in docs.collect()], largest)
    assert got(exact_dedup(docs.repartition(7), largest=largest, **options)) == want


def test_odd_rows(spark, odd):
    assert got(exact_dedup(odd.repartition(3), run_rows=2, fan_in=2)) == brute([(r.doc_id, r.text) for r in odd.collect()])


def test_null_and_text_ids(spark):
    rows = [(None, "a"), (None, "a"), ("x", "a"), (None, "b"), ("y", "c"), ("z", "c"), ("z", "c"), ("10", None), ("9", "")]
    df = spark.createDataFrame(rows, "key string, body string").repartition(4)
    for largest in (True, False):
        found = got(exact_dedup(df, "key", "body", largest=largest, run_rows=1, fan_in=2))
        assert found == sorted(((i, k, n, h) for i, k, n, h in _text_brute(rows, largest)), key=str)


def _text_brute(rows, largest):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    for t, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = (known[-1] if largest else known[0]) if known else None
        yield from ((i, keep, len(ids), hashlib.sha256(t.encode()).hexdigest()) for i in ids)


def test_one_text_holds_a_third(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("text")).repartition(11)
    r = exact_dedup(df, run_rows=50).groupBy("group_size").agg(F.count("*").alias("n"), F.max("keep_id").alias("k")).orderBy("group_size").collect()
    assert [(x.group_size, x.n) for x in r] == [(1, 2000), (1000, 1000)] and r[1].k == 2997


def test_normal_and_carry(spark):
    df = spark.createDataFrame([(1, "A", "p"), (2, "a", "q")], "doc_id long, text string, rest string")
    r = exact_dedup(df, normal=F.lower, carry=("rest",)).orderBy("id").collect()
    assert [(x.id, x.keep_id, x.kept, x.rest.rest) for x in r] == [(1, 2, False, "p"), (2, 2, True, "q")]


def test_empty_table(spark, empty):
    assert exact_dedup(empty).count() == 0


def test_equal_short_keys_are_verified():
    """Digests that agree in 64 bits only stay apart."""
    digests = [b"\0" * 8 + bytes([i]) * 24 for i in (3, 1, 3, 2)]
    t = pa.table({"node": [0] * 4, "digest": pa.array(digests, pa.binary()), "bytes": [1] * 4, "keep_id": [5, 6, 7, 8], "keep_row": [0, 1, 2, 3], "rows": [1, 1, 1, 1]})
    out = merge_runs(t, True)
    assert sorted(zip(out["keep_id"].to_pylist(), out["rows"].to_pylist())) == [(6, 1), (7, 2), (8, 1)]


def test_layout_covers_all_runs():
    for p in (1, 2, 15, 16, 17, 211, 5000):
        fan, rounds = _layout(p, 3, 16)
        assert fan ** rounds >= 3 * p and fan <= 16
    assert np.prod(_layout(1, 1, 16)) >= 2
