import os
import sys

import numpy as np
import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from vela.session import local_session
    s = local_session(4, 8, app="vela-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def blobs(spark):
    """3 Gaussian clouds in 3 features, 300 rows: key, x1..x3, cluster."""
    rng = np.random.default_rng(42)
    centers = np.array([[0, 0, 0], [6, 6, 0], [0, 6, 6]], dtype=float)
    rows = []
    for c in range(3):
        pts = rng.normal(size=(100, 3)) + centers[c]
        for p in pts:
            rows.append((len(rows), *map(float, p), f"c{c + 1}"))
    pdf = pd.DataFrame(rows, columns=["key", "x1", "x2", "x3", "cluster"])
    return spark.createDataFrame(pdf).repartition(3)


@pytest.fixture(scope="session")
def rings(spark):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        r = 1.0 if i % 2 == 0 else 3.0
        a = (i // 2) * 2 * np.pi / 120 + rng.normal(0, 0.01)
        rows.append((i, float(r * np.cos(a) + rng.normal(0, 0.05)), float(r * np.sin(a) + rng.normal(0, 0.05)),
                     "inner" if r == 1.0 else "outer"))
    return spark.createDataFrame(pd.DataFrame(rows, columns=["key", "x1", "x2", "ring"]))
