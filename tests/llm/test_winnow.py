import hashlib
import random

import xxhash
from pyspark.sql import functions as F

from vela.llm.queries import QUERIES
from vela.llm.winnow import add_fingerprint, fingerprint_and_edit, spelled, with_next


def brute(text, gram=5, window=8):
    words = (text or "").split()
    if not words:
        return []
    h = [xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words]
    grams = []
    for i in range(max(1, len(h) - gram + 1)):
        s = 42
        for x in h[i:i + gram]:
            s = xxhash.xxh64(x.to_bytes(8, "little"), seed=s).intdigest()
        grams.append((s >> 33, i))
    out = []
    for a in range(max(1, len(grams) - window + 1)):
        best = min(grams[a:a + window], key=lambda g: (g[0], -g[1]))
        if best not in out:
            out.append(best)
    return out


def jaccard(a, b):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0], r[1]))
    out = []
    for k, (i, t) in enumerate(rows):
        nxt = rows[(k + 1) % len(rows)][1]
        n = len(t) // 2
        e = t[:len(t) - n] + nxt[:n]
        f, g = brute(t), brute(e)
        say = lambda x: " ".join(f"{p}:{h:x}" for h, p in x)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), say(f), say(g), round(jaccard(f, g), 9), round(jaccard(f, brute(nxt)), 9)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark, sf, docs):
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                  for r in QUERIES["op9_fingerprints"](spark, sf).collect()), key=str)
    assert got == expected([(r.doc_id, r.text) for r in docs.collect()])


def test_ranges_do_not_change_the_next_row(spark, docs):
    from vela.llm.common import only
    rows = only(docs, id="doc_id", text="text")
    one = {r.id: r.next_text for r in with_next(rows, ["text"]).collect()}
    many = {r.id: r.next_text for r in with_next(rows, ["text"], range_bytes=20_000).collect()}
    assert one == many


def test_odd_rows(odd, empty):
    got = fingerprint_and_edit(odd).collect()
    assert len(got) == 13
    by = {r.doc_id: r for r in got}
    assert by[1].fingerprint == [] and by[3].fingerprint == []
    assert by[6].fingerprint == by[7].fingerprint and by[6].near_next == 1.0
    assert fingerprint_and_edit(empty).count() == 0


def test_match_guarantee(spark):
    shared = " ".join(f"s{i}" for i in range(12))  # window + gram - 1 words
    df = spark.createDataFrame([(1, "alpha beta " + shared + " gamma"), (2, "x y z " + shared + " q r")], "id long, text string")
    a, b = (set(x >> 32 for x in r.f) for r in add_fingerprint(df, "text", "f").orderBy("id").collect())
    assert a & b
    assert add_fingerprint(df, "text", "f").select(spelled("f").alias("s")).first().s.count(":") >= 1


def test_texts_without_spaces(spark):
    rng = random.Random(3)
    han, thai, far, run, kana = ("".join(chr(a + rng.randrange(n)) for _ in range(1200)) for a, n in ((0x4E00, 20000), (0x0E01, 46), (0x20000, 20000), (0x61, 26), (0x3041, 80)))
    texts = [han, thai, far, run, kana, "été " * 3 + "日本語"]
    got = fingerprint_and_edit(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert all(r.near_edited > 0.2 for r in got[:5])
    one = spark.createDataFrame([(0, han), (1, han[:600] + "x" + han[601:]), (2, run + "0" + run)], "id long, text string")
    a, b, c = (set(x >> 32 for x in r.f) for r in add_fingerprint(one, "text", "f").orderBy("id").collect())
    assert len(a & b) / len(a | b) > 0.9 and len(c) > 1
    words = spark.createDataFrame([(0, "été 日本 x𠀀y"), (1, "été 日 本 x 𠀀 y")], "id long, text string")
    assert len({tuple(r.f) for r in add_fingerprint(words, "text", "f").collect()}) == 1


def test_plan_is_native(docs):
    plan = fingerprint_and_edit(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
