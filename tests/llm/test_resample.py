import hashlib
import math
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from vela.llm.resample import importance_resample, ngram_buckets, pack, unpack

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    w = WORD.findall(low)
    return len(w), [zlib.crc32(b" ".join(w[i:i + n])) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def brute(docs, target):
    s, t = np.zeros(10000), np.zeros(10000)
    found = [features(x) for _, x in docs]
    for _, f in found:
        np.add.at(s, f, 1)
    for x in target:
        np.add.at(t, features(x)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + 10000) / ((a + 1) * (t.sum() + 10000)))) for a, b in zip(s, t)]
    out = []
    for (i, _), (n, f) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in f)
        out.append([i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0] or 0))
    drawn = 5 * len(able) // 100
    ranks = {}
    for k, r in enumerate(able[:drawn], 1):
        ranks.setdefault((r[0], r[4]), []).append(k)
    return sorted((r[0], r[2], r[3], r[4]) for r in out if r[0] is not None), sorted((r[0], k) for k, r in enumerate(able[:drawn], 1) if r[0] is not None)


def got(df):
    rows = df.collect()
    return sorted((r.id, r.n_features, r.weight, r.score) for r in rows if r.id is not None), sorted((r.id, r["rank"]) for r in rows if r["rank"] and r.id is not None), rows


def test_against_brute_force(spark, sf, docs):
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    found = got(importance_resample(docs, target, bucket_rows=20))
    assert found[0] == want[0] and found[1] == want[1]


def test_runs_of_a_text():
    for text in ("", "  ", "one", "One  two", "a b c", "Ünï-côdé 日本 x9", "a,b;c d!!e\nf", "x" * 5000 + " y"):
        n, f = features(text)
        words, found = ngram_buckets(text.encode(), 10000)
        assert words == n and sorted(found.tolist()) == sorted(f)


def test_pack_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 5000):
        b = rng.integers(0, 10000, n)
        assert unpack(np.frombuffer(pack(b), dtype=np.uint8)).tolist() == sorted(b.tolist())
    assert unpack(np.frombuffer(pack(np.array([255, 510, 255, 0, 9999])), dtype=np.uint8)).tolist() == [0, 255, 255, 510, 9999]


def test_odd_rows_and_empty_target(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = got(importance_resample(odd, empty))
    assert found[0] == brute(rows, [])[0]
    assert importance_resample(empty, odd).count() == 0


def test_repeated_rows_and_null_ids(spark, empty):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(text).alias("text"), F.lit(1).alias("score"))
    rows = importance_resample(df, empty, bucket_rows=10).collect()
    assert len(rows) == 300 and sorted(r["rank"] for r in rows if r["rank"]) == list(range(1, 16))
    cut = min(r.score for r in rows if r["rank"])
    assert all(r["rank"] for r in rows if r.score > cut)


def test_text_ids(spark, empty):
    df = spark.createDataFrame([("a", "x " * 30), ("b", "y " * 30)], "doc_id string, text string")
    assert {r.id for r in importance_resample(df, empty, percent=50).where("rank = 1").collect()} <= {"a", "b"}
