import hashlib
import re

import pytest
from pyspark.sql import functions as F

from vela.llm.decontaminate import contaminated, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(rows, items, k=13):
    windows = {}
    for item, t in items:
        if item is None:
            continue
        w = words(t)
        for s in range(max(1, len(w) - k + 1)) if w else ():
            windows.setdefault(tuple(w[s:s + k]), set()).add(str(item))
    out = []
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for m in {len(x) for x in windows}:
            for s in range(len(w) - m + 1):
                own = windows.get(tuple(w[s:s + m]))
                if own:
                    hit.update(range(s, s + m))
                    found |= own
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", contaminated()).collect()), key=str)


@pytest.mark.parametrize("slice_bytes", [4 << 20, 1_500])
def test_against_brute_force(spark, sf, docs, slice_bytes):
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got(decontaminate(docs, items, slice_bytes=slice_bytes)) == expected
    assert any(r[5] for r in expected)


def test_odd_rows_and_items(spark, odd, empty):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (3, "one"), (None, "a b c d"), (4, "A B, c d!"), (5, "c d e f g h i j k l m n o p"), (6, "été 日本語 Ñ"), (6, "été 日本語 ñ"), (70, "x")],
                                  "item_id long, text string")
    assert got(decontaminate(odd, items)) == brute([(r.doc_id, r.text) for r in odd.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert decontaminate(empty, items).count() == 0
    nothing = decontaminate(odd, items.where("false"))
    assert nothing.where("n_hit > 0 OR n_items > 0").count() == 0 and nothing.count() == odd.count()
    assert decontaminate(odd, items, carry=["id", "rest"]).select(F.col("rest.id")).distinct().first().id == "x"
