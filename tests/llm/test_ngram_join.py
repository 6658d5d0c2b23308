import random

import numpy as np

from vela.llm.components import components
from vela.llm.ngram_join import bayes_survivors, least_matches, ngram_join, overlaps


def brute(rows, t=0.8, k=5):
    import re
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    sets = []
    for _, x in rows:
        w = word.findall((x or "").lower())
        sets.append(frozenset(tuple(w[s:s + k]) for s in range(max(1, len(w) - k + 1))) if w else frozenset())
    n = len(rows)
    root = list(range(n))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    links, copies = [0] * n, [1] * n
    for a in range(n):
        for b in range(a + 1, n):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                if sets[a] == sets[b]:
                    copies[a] += 1
                    copies[b] += 1
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    low = {}
    for a in range(n):
        low[find(a)] = min(low.get(find(a), rows[a][0]), rows[a][0])
    return sorted((rows[a][0], low[find(a)], links[a], copies[a]) for a in range(n))


def got(df):
    return sorted(tuple(r) for r in df.select("doc_id", "class_id", "n_links", "copies").collect())


def test_near_copies_against_brute_force(spark):
    rng = random.Random(9)
    rows = []
    for base in range(12):
        text = [f"b{base}w{i}" for i in range(120)]
        for _ in range(rng.choice([1, 1, 2, 6, 25])):
            own = list(text)
            for _ in range(rng.randrange(0, 5)):
                own[rng.randrange(120)] = f"x{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(own)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows)
    assert got(ngram_join(df)) == expected
    assert got(ngram_join(df, chunk_docs=4, chunk_grams=700)) == expected  # hot groups cut into chunk pairs


def test_odd_rows(odd, empty):
    lower = odd.where("doc_id <> 10")
    assert got(ngram_join(lower)) == brute([(r.doc_id, r.text) for r in lower.collect()])
    twice = ngram_join(odd).where("doc_id = 10").collect()
    assert [(r.class_id, r.n_links, r.copies) for r in twice] == [(10, 1, 2)] * 2
    assert ngram_join(empty).count() == 0


def test_no_link_is_lost_to_pruning():
    least = least_matches(0.8, 1e-6)
    rng = np.random.default_rng(2)
    kept = 0
    for _ in range(400):  # pairs exactly at the threshold
        a = rng.integers(0, 2 ** 32, (1, 63), dtype=np.uint32)
        b = np.where(rng.random((1, 63)) < 0.8, a, a + 1).astype(np.uint32)
        kept += len(bayes_survivors(a, b, False, least)[0])
    assert kept == 400
    far = rng.integers(0, 2 ** 32, (50, 63), dtype=np.uint32)
    assert len(bayes_survivors(far, far, True, least)[0]) == 0


def test_overlaps_both_ways():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 300, 60).astype(np.uint64)) for _ in range(30)]
    i, j = np.triu_indices(30, 1)
    expected = [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)]
    assert list(overlaps(sets, sets, i, j)) == expected and list(overlaps(sets, sets, i[:20], j[:20])) == expected[:20]


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{k: 100 for k in range(100, 140)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_of_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(100))
    df = spark.createDataFrame([(None, text), (None, text + " more"), (None, text + " more"), (7, "other")], "doc_id long, text string")
    assert sorted(((r.doc_id, r.class_id, r.n_links, r.copies) for r in ngram_join(df).collect()), key=str) == sorted([(None, None, 2, 1), (None, None, 2, 2), (None, None, 2, 2), (7, 7, 0, 1)], key=str)
