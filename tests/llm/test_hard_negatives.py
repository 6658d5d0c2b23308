import math

import numpy as np
import pytest

from vela.llm.hard_negatives import _strips, fit_centres, hard_negatives


def brute(rows, anchor, low=80, high=100, k=5):
    """rows: (id, label, vector) in table order; ties to the smaller id, then to the earlier row."""
    ok = [(i, n, c, [math.floor(256 * x) for x in v]) for n, (i, c, v) in enumerate(rows)
          if c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for i, n, c, v in ok:
        if i is None or not anchor(i):
            continue
        scored = sorted(((-dot(v, w), j is None, j or 0, m, j, d) for j, m, d, w in ok if m != n), key=lambda s: s[:4])
        for p in [s for s in scored if s[5] == c][:k]:
            ps = -p[0]
            neg = [s for s in scored if s[5] != c and low * ps <= -100 * s[0] <= high * ps][:k]
            out += [(i, p[4], r, s[4], ps, -s[0]) for r, s in enumerate(neg, 1)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()), key=str)


SCHEMA = "vec_id long, label int, embedding array<double>, row long, id long, vec int"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA).coalesce(1)


def test_against_brute_force(spark, sf):
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.label, r.embedding) for r in e.collect()]
    want = brute(rows, lambda i: i % 10 == 0)
    assert want and got(hard_negatives(e, "id % 10 = 0")) == want
    # many strips of both sides, clusters split over strips
    assert got(hard_negatives(e, "id % 10 = 0", strip_bytes=64 * 4 * 11, least_strip=50)) == want


def test_ties_nulls_and_short_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 3), [float(x) for x in rng.integers(-2, 3, 4) / 4]) for i in range(200)]
    rows += [(200, None, [1.0] * 4), (201, 1, None), (202, 1, [1.0, None, 1.0, 1.0]), (203, 1, [math.nan] * 4), (204, 1, [math.inf] * 4), (205, 2, []), (206, 0, [0.5]),
             (None, 1, [1.0] * 4), (None, 2, [1.0] * 4), (210, 0, [0.0] * 4), (220, 1, [-1.0] * 4), (221, 1, [1.0] * 4)]
    assert got(hard_negatives(table(spark, rows), "id % 10 = 0")) == brute(rows, lambda i: i % 10 == 0)


def test_one_vector_in_a_third_of_the_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 4, [0.5, 0.5, 0.1] if i % 3 == 0 else [float(x) for x in rng.normal(size=3)]) for i in range(600)]
    assert got(hard_negatives(table(spark, rows), "id % 50 = 0", least_strip=100)) == brute(rows, lambda i: i % 50 == 0)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(7)
    rows = [(i, i % 2, [float(x) for x in rng.normal(size=4) * 2e5]) for i in range(60)]
    assert got(hard_negatives(table(spark, rows), "id % 10 = 0")) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="32 bits"):
        hard_negatives(table(spark, [(0, 0, [1e300])]), "id % 10 = 0").count()


def test_repeated_rows(spark):
    rows = [(10, 1, [1.0, 0.0]), (10, 1, [1.0, 0.0]), (11, 2, [0.9, 0.1]), (12, 2, [0.95, 0.0])]
    assert got(hard_negatives(table(spark, rows), "id = 10")) == brute(rows, lambda i: i == 10)


def test_empty_tables_and_no_anchor(spark):
    none = table(spark, [(1, 1, [1.0])]).limit(0)
    assert hard_negatives(none, "id % 100 = 0").count() == 0
    assert hard_negatives(table(spark, [(1, 1, [1.0])]), "id % 100 = 0").count() == 0
    assert hard_negatives(table(spark, [(0, 1, [])]), "id % 100 = 0").count() == 0


def test_strips_hold_their_bound():
    plan, n = _strips([(0, 5), (1, 3), (2, 25), (3, 9), (4, 1)], 10)
    assert n == plan["strip"].max() + plan["splits"].iloc[plan["strip"].argmax()]
    load = {}
    for c, s, at in plan.itertuples(index=False):
        for k in range(s):
            load[at + k] = load.get(at + k, 0) + math.ceil({0: 5, 1: 3, 2: 25, 3: 9, 4: 1}[c] / s)
    assert max(load.values()) <= 10


def test_centres_are_unit_vectors():
    x = np.random.default_rng(0).normal(size=(50, 3))
    assert np.allclose(np.linalg.norm(fit_centres(x, 4), axis=1), 1)
