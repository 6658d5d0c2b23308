"""Document fingerprints by winnowing, in DataFrame functions only.

Method.  A text's words (split at white space; characters of scripts without spaces, and of runs
longer than ``LONGEST``, count as words each) are hashed, ``gram`` neighbouring word hashes
are hashed together, and of each window of ``window`` consecutive grams the smallest
hash is kept, the rightmost on ties, with its position.  Any run of
window + gram - 1 words that two texts share therefore gives both the same
fingerprint.  A gram is packed into one long, 31 bits of hash above 32 bits of
reversed position, so a minimum picks hash and rightmost position at once; the window
minimum is a few element-wise minima at doubling distance.

Plan.  Fingerprints are a projection of the scan.  ``with_next`` sets each document beside
the next one: ids are cut into ranges at approximate quantiles, the first row of
each range also goes, marked, to the end of the range before, and ``lead`` runs
inside a range.  No window spans the table, and texts are shuffled once.
"""
from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vela.llm.common import only, partitions_for, text_bytes

_POSITIONS = (1 << 32) - 1
#: A longer run without white space (code points) is cut into its characters.
LONGEST = 64
#: Scripts written without spaces: Thai, Lao, Tibetan, Burmese, Khmer, Tai, Chinese, Japanese, Yi.
UNSPACED = r"[\u0E00-\u109F\u1780-\u17FF\u1950-\u1AAF\u2E80-\uA4CF\uA9E0-\uA9FF\uAA60-\uAADF\uF900-\uFAFF\uFF66-\uFF9F\x{20000}-\x{3FFFF}]"


def add_fingerprint(df: DataFrame, text: str, out: str, gram: int = 5, window: int = 8) -> DataFrame:
    """Adds ``out``: the selected grams as packed longs, in text order.

    Words are those of the method above.  A text of fewer than ``gram`` words is one gram; fewer grams than a window are
    one window; a null, empty or blank text has no fingerprint (an empty array).
    """
    # every step is a column of its own: an expression inside a lambda would run for each element
    w, h, g = (f"__{out}_{x}" for x in ("words", "hashes", "grams"))
    whole = F.coalesce(F.col(text), F.lit(""))
    cut = F.split(F.regexp_replace(whole, f"({UNSPACED})", " $1 "), r"\s+")
    cut = F.flatten(F.transform(cut, lambda x: F.when(F.length(x) > LONGEST, F.split(x, "")).otherwise(F.array(x))))
    has = whole.rlike(rf"{UNSPACED}|\S{{{LONGEST + 1}}}")
    df = df.withColumn(w, F.array_remove(F.when(has, cut).otherwise(F.split(whole, r"\s+")), ""))
    df = df.withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    n = F.size(h)

    def packed(i: Column) -> Column:
        mixed = F.xxhash64(*[F.get(F.col(h), i + F.lit(j)) for j in range(gram)])  # a missing word leaves the hash as it is
        return F.shiftleft(F.shiftrightunsigned(mixed, 33), 32).bitwiseOR(F.lit(_POSITIONS) - i.cast("long"))

    df = df.withColumn(g, F.slice(F.transform(F.sequence(F.lit(0), F.greatest(n - F.lit(gram), F.lit(0))), packed), F.lit(1), n))
    count, have, steps = F.greatest(F.size(g) - F.lit(window - 1), F.least(F.size(g), F.lit(1))), 1, []
    now = g
    while have < window:
        step = min(have, window - have)
        steps.append(f"__{out}_{len(steps)}")
        df = df.withColumn(steps[-1], F.zip_with(F.col(now), F.slice(F.col(now), F.lit(step + 1), F.size(now)), lambda a, b: F.least(a, b)))
        now, have = steps[-1], have + step
    return df.withColumn(out, F.array_distinct(F.slice(F.col(now), F.lit(1), count))).drop(w, h, g, *steps)


def hashes(fingerprint: str) -> Column:
    return F.array_distinct(F.transform(fingerprint, lambda x: F.shiftright(x, 32)))


def spelled(fingerprint: str) -> Column:
    """position:hash of each selected gram, joined by spaces."""
    one = lambda x: F.concat((F.lit(_POSITIONS) - x.bitwiseAND(F.lit(_POSITIONS))).cast("string"), F.lit(":"), F.lower(F.hex(F.shiftright(x, 32))))
    return F.array_join(F.transform(fingerprint, one), " ")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two arrays of hashes; two empty ones are alike (1.0), an empty and another are not."""
    shared, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(shared / F.greatest(either, F.lit(1)))


def with_next(docs: DataFrame, carry: list[str], range_bytes: int = 16 << 20, most_heads: int = 200_000) -> DataFrame:
    """Adds next_<column> for each carried column: that of the next row by id, then text; after the last row, the first.

    ``docs`` has id and text.  Null ids come first.
    """
    spark = docs.sparkSession
    ranges = partitions_for(text_bytes(docs, "text"), range_bytes)
    order = F.coalesce(F.col("id").cast("double"), F.lit(float("-inf")))
    inner = sorted(set(docs.select(F.col("id").cast("double").alias("x")).where("x IS NOT NULL").approxQuantile("x", [i / ranges for i in range(1, ranges)], 0.2 / ranges))) if ranges > 1 else []
    keyed = docs.withColumn("__order", order)
    if inner:
        cut = Bucketizer(splits=[float("-inf"), *inner, float("inf")], inputCol="__order", outputCol="__range", handleInvalid="keep")
        keyed = cut.transform(keyed).withColumn("__range", F.col("__range").cast("long"))
    else:
        keyed = keyed.withColumn("__range", F.lit(0).cast("long"))
    # one row a range: its first id
    heads = sorted(keyed.groupBy("__range").agg(F.min("__order").alias("head")).collect(), key=lambda r: r["__range"])
    before = [(r.head, heads[i - 1]["__range"]) for i, r in enumerate(heads)]
    table = spark.createDataFrame(before, "__order double, __to long")
    if len(before) <= most_heads:  # a few bytes each; more heads take a shuffled join
        table = F.broadcast(table)
    marked = keyed.join(table, "__order").withColumn("__range", F.col("__to")).drop("__to").withColumn("__mark", F.lit(1))
    rows = keyed.withColumn("__mark", F.lit(0)).unionByName(marked)
    along = Window.partitionBy("__range").orderBy("__mark", "__order", "id", "text")
    out = rows.select("*", *[F.lead(c).over(along).alias(f"next_{c}") for c in carry])
    return out.where("__mark = 0").drop("__order", "__range", "__mark")


def fingerprint_and_edit(docs: DataFrame, gram: int = 5, window: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, text, edited text, fingerprints of both (packed longs) and the likeness of the text to its edit and to the next text.

    The edit replaces the last half of a text's characters (rounded down) by the
    first as many of the next document's.  Null texts count as empty; repeated rows
    give a row each, in the order of id and text; equal texts have equal fingerprints;
    extra columns are left out; an empty table gives an empty table.
    """
    rows = only(docs, id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = with_next(add_fingerprint(rows, "text", "fingerprint", gram, window), ["text", "fingerprint"])
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = add_fingerprint(rows, "edited", "edited_fingerprint", gram, window)
    for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        rows = rows.withColumn(f"__{c}", hashes(c))
    return rows.select(F.col("id").alias(id_col), "text", "edited", "fingerprint", "edited_fingerprint",
                       likeness("__fingerprint", "__edited_fingerprint").alias("near_edited"), likeness("__fingerprint", "__next_fingerprint").alias("near_next"))
