import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls, empty and very long texts, ties, repeated rows; the extra columns clash with names used inside.
@pytest.fixture(scope="session")
def odd(spark):
    long = " ".join(f"word{i % 977} other{i % 31}" for i in range(40_000))
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "a b c d"), (6, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
            (7, "a b c d e f g h i j k l m n o p q r s t u v w x y z"), (8, long), (9, long + " tail"), (10, "Ünïcödé été 日本語 ñ " * 12), (10, "Ünïcödé été 日本語 ñ " * 12),
            (11, "12345 !!! ### 999"), (12, "%%% ***")]
    return spark.createDataFrame([(i, t, "x", 1, "n", "k") for i, t in rows], "doc_id long, text string, id string, part int, node string, rest string")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
