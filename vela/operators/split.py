"""Splitting, folds, sampling and size guards.

R's random streams cannot be replayed, so the random choice is a seeded hash
of the key (``order_hash``): sizes per class are exact (``ceil(p * n_c)``)
and the same rows are chosen by any engine that evaluates the same hash.
Ranks inside classes use P1 (bucketed), so a class holding a third of the
table never lands in one task.
"""
from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.functions.columns import order_hash
from vela.operators.patterns import auto_buckets, bucket_rank, top_m_flag


def class_counts(df: DataFrame, target: str, limit: int = 100_000) -> dict:
    """Rows per class (a bounded table: classes, not rows)."""
    from vela.operators.patterns import bounded_collect
    rows = bounded_collect(df.groupBy(target).count(), limit)
    if rows is None:
        raise ValueError(f"{target} has more than {limit} classes")
    return {r[0]: r[1] for r in rows}


def stratified_split(df: DataFrame, target: str, key: str, p: float = 0.8, seed: int = 1995,
                     hash_method: str = "portable", flag_col: str = "is_train"):
    """Exactly ``ceil(p * n_class)`` training rows per class.

    Returns (flagged df, train, test).  Errors if a class ends up on one
    side only, or if p is not in (0, 1)."""
    if not 0 < p < 1:
        raise ValueError("p must be in (0, 1)")
    counts = class_counts(df, target)
    if any(k is None for k in counts):
        raise ValueError("target contains NULL")
    m = {k: math.ceil(p * n) for k, n in counts.items()}
    bad = [k for k, n in counts.items() if m[k] >= n or m[k] < 1]
    if bad:
        raise ValueError(f"classes {bad} would be missing from train or test")
    spark = df.sparkSession
    mdf = spark.createDataFrame([(k, v) for k, v in m.items()],
                                f"{target} {df.schema[target].dataType.simpleString()}, __m long")
    x = df.withColumn("__h", order_hash(key, seed, hash_method))
    nb = auto_buckets(max(counts.values()))
    flagged = top_m_flag(x, [target], "__h", key, mdf, "__m", flag_col, n_buckets=nb).drop("__h")
    return flagged, flagged.filter(F.col(flag_col)).drop(flag_col), \
        flagged.filter(~F.col(flag_col)).drop(flag_col)


def safe_folds(df: DataFrame, target: str, max_folds: int = 5) -> int:
    """min(max_folds, smallest class); fewer than 2 is an error."""
    k = min(max_folds, min(class_counts(df, target).values()))
    if k < 2:
        raise ValueError("not enough rows per class for cross-validation")
    return k


def stratified_folds(df: DataFrame, target: str, key: str, k: int = 5, repeats: int = 1,
                     seed: int = 1995, hash_method: str = "portable") -> DataFrame:
    """D3: (key, repeat, fold): inside each class and repeat, rows in a
    seeded hash order of their own (the repeat is part of the hash) are dealt to folds 1..k in turn, so fold sizes per class
    differ by at most one."""
    reps = df.select(key, target).withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    x = reps.withColumn("__h", order_hash(key, seed, hash_method, F.col("repeat")))
    nb = auto_buckets(max(class_counts(df, target).values()))
    r = bucket_rank(x, [target, "repeat"], "__h", key, "__rank", n_buckets=nb)
    return r.select(key, "repeat", (F.pmod(F.col("__rank") - 1, F.lit(k)) + 1).cast("int").alias("fold"))


def sample_n(df: DataFrame, n: int, seed: int, key: str, hash_method: str = "portable") -> DataFrame:
    """The ``n`` rows first in seeded hash order (exact size)."""
    spark = df.sparkSession
    x = df.withColumn("__g", F.lit(1)).withColumn("__h", order_hash(key, seed, hash_method))
    mdf = spark.createDataFrame([(1, n)], "__g int, __m long")
    return top_m_flag(x, ["__g"], "__h", key, mdf, "__m", "__in", n_buckets=auto_buckets(df.count())) \
        .filter(F.col("__in")).drop("__g", "__h", "__in")


# Guard rails on sizes (pure functions on counts).

def clamp_k(k: int, n: int, n_distinct: int) -> int:
    """k-means k clamped to [2, min(n - 1, distinct points)]."""
    return max(2, min(k, n - 1, n_distinct))


def neighbours_for(n: int, share: float = 0.15) -> int:
    """Neighbour count clamp(round(share * n), 2, n - 1)."""
    return int(max(2, min(round(share * n), n - 1)))


def max_perplexity(n: int) -> int:
    """Largest t-SNE perplexity for n rows: floor((n - 1) / 3) - 1."""
    return (n - 1) // 3 - 1


def min_pts_for(d: int, n: int) -> int:
    """DBSCAN minPts = max(4, 2d), capped at n - 1."""
    return min(max(4, 2 * d), n - 1)
