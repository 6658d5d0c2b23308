"""Shared distributed patterns.

P1  ``bucket_rank`` / ``top_m_flag``: exact row numbers inside groups without a
    single-task window: bucket the order value, count per (group, bucket),
    turn the small count table into offsets, and number rows only inside
    buckets.
Q   ``exact_quantiles``: exact type-7 quantiles per group in two passes, from
    sketch brackets and counts per value inside them.
P2  ``map_block_pairs``: rows packed into blocks of bounded size, blocks dealt to
    a square grid of tasks that each read two strips; numpy works on one block
    pair per call and returns only reduced results.
P5  ``grouped_moments``: (n, sum x, sum x x^T) per group from numpy partials,
    summed by Spark, collected at size groups x d x d.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vela.functions.columns import MOD31

# Rows a small side may have before we stop broadcasting it.
BROADCAST_ROW_LIMIT = 200_000


def bounded_collect(df: DataFrame, limit: int):
    """Collect ``df`` only if it has at most ``limit`` rows, else ``None``."""
    rows = df.limit(limit + 1).collect()
    return None if len(rows) > limit else rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               limit: int = BROADCAST_ROW_LIMIT) -> DataFrame:
    """Join, broadcasting ``small`` only after its size is checked.

    The small side (typically an aggregate of the big one) is computed once:
    if it has at most ``limit`` rows it is collected and broadcast as a local
    table, so the big input is not scanned again to rebuild it; otherwise it
    is joined as is (sort-merge, or AQE's runtime choice)."""
    rows = bounded_collect(small, limit)
    if rows is None:
        return big.join(small, on=on, how=how)
    local = small.sparkSession.createDataFrame(rows, small.schema)
    return big.join(F.broadcast(local), on=on, how=how)


# ---------------------------------------------------------------------------
# Exact ranks in groups through buckets
# ---------------------------------------------------------------------------

def auto_buckets(n: int, per_bucket: int = 1_000_000, minimum: int = 1024) -> int:
    """Bucket count so that one (group, bucket) window holds about
    ``per_bucket`` rows at most, whatever the table size."""
    return int(max(minimum, math.ceil(n / per_bucket)))


def _bucket_col(order: Column, n_buckets: int, lo: float, hi: float) -> Column:
    width = (hi - lo) / n_buckets if hi > lo else 1.0
    b = F.floor((order.cast("double") - F.lit(lo)) / F.lit(width)).cast("int")
    return F.least(F.greatest(b, F.lit(0)), F.lit(n_buckets - 1))


def balanced_buckets(df: DataFrame, order_col: str, out: str, n_buckets: int) -> DataFrame:
    """Adds an ascending bucket number cut at approximate quantiles of a raw
    numeric order value, so one far outlier does not put all rows in a bucket."""
    from pyspark.ml.feature import Bucketizer
    n = max(1, min(n_buckets, 4096))
    x = df.withColumn("__ord", F.coalesce(F.col(order_col).cast("double"), F.lit(float("-inf"))))
    probs = [i / n for i in range(1, n)]
    cuts = sorted(set(df.select(F.col(order_col).cast("double").alias("o")).filter("o IS NOT NULL")
                      .approxQuantile("o", probs, 0.25 / n))) if probs else []
    if not cuts:
        return x.withColumn(out, F.lit(0)).drop("__ord")
    cutter = Bucketizer(splits=[float("-inf"), *cuts, float("inf")], inputCol="__ord", outputCol=out,
                        handleInvalid="keep")
    return cutter.transform(x).withColumn(out, F.col(out).cast("int")).drop("__ord")


def bucket_rank(df: DataFrame, group_cols: list[str], order_col: str,
                tie_col: str, rank_col: str = "rank", n_buckets: int = 1024,
                lo: float | None = 0.0, hi: float | None = float(MOD31)) -> DataFrame:
    """Exact 1-based row number inside ``group_cols`` by (order, tie).

    The order value must lie in [lo, hi] and be spread over it (a hash); for a
    raw value pass ``lo=None`` and the buckets are cut at its quantiles.  The
    window runs per (group, bucket) so no task sees a whole group.  One
    shuffle of the rows plus a count table of groups x buckets.
    """
    b = "__bkt"
    if lo is None:
        x = balanced_buckets(df, order_col, b, n_buckets)
    else:
        x = df.withColumn(b, _bucket_col(F.col(order_col), n_buckets, lo, hi))
    counts = x.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*group_cols).orderBy(b) if group_cols else Window.orderBy(b)
    offsets = counts.withColumn(
        "__off", F.sum("__cnt").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ).select(*group_cols, b, F.coalesce(F.col("__off"), F.lit(0)).alias("__off"))
    x = join_small(x, offsets, on=[*group_cols, b])
    wr = Window.partitionBy(*group_cols, b).orderBy(order_col, tie_col)
    return x.withColumn(rank_col, (F.col("__off") + F.row_number().over(wr)).cast("long")) \
        .drop(b, "__off")


def top_m_flag(df: DataFrame, group_cols: list[str], order_col: str, tie_col: str,
               m: DataFrame, m_col: str, flag_col: str, n_buckets: int = 1024,
               lo: float = 0.0, hi: float = float(MOD31)) -> DataFrame:
    """Flag the first ``m`` rows of every group by (order, tie), exactly.

    ``m`` is a small table (group_cols, m_col).  Rows in buckets wholly below
    the cut are in, wholly above are out; only rows of the one boundary bucket
    per group are numbered, so the window touches ~n/n_buckets rows.
    """
    b = "__bkt"
    x = df.withColumn(b, _bucket_col(F.col(order_col), n_buckets, lo, hi))
    counts = x.groupBy(*group_cols, b).agg(F.count(F.lit(1)).alias("__cnt"))
    w = Window.partitionBy(*group_cols).orderBy(b) if group_cols else Window.orderBy(b)
    offsets = (counts
               .withColumn("__off", F.coalesce(
                   F.sum("__cnt").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
               .join(m, on=group_cols, how="inner")
               .select(*group_cols, b, "__off", "__cnt", F.col(m_col).alias("__m")))
    x = join_small(x, offsets, on=[*group_cols, b])
    inside = F.col("__off") + F.col("__cnt") <= F.col("__m")
    outside = F.col("__off") >= F.col("__m")
    decided = x.filter(inside | outside).withColumn(flag_col, inside)
    wr = Window.partitionBy(*group_cols, b).orderBy(order_col, tie_col)
    boundary = (x.filter(~(inside | outside))
                .withColumn(flag_col, F.col("__off") + F.row_number().over(wr) <= F.col("__m")))
    cols = [c for c in df.columns] + [flag_col]
    return decided.select(*cols).unionByName(boundary.select(*cols))


# ---------------------------------------------------------------------------
# Exact quantiles per group, from sketch brackets
# ---------------------------------------------------------------------------

def exact_quantiles(long_df: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                    accuracy: int = 10_000) -> DataFrame:
    """Exact type-7 quantiles (R default, Spark ``percentile``, DuckDB
    ``quantile_cont``) per group, one column per probability named ``q_<p>``.

    Two passes, none of them persisted: a mergeable sketch per group brackets
    the wanted ranks (a small group is its own bracket), then one grouped count
    says how many rows lie below a bracket and which values inside, as counts
    per distinct value.  A bracket holds about 4 n / ``accuracy`` rows.
    """
    keys = list(group_cols) or ["__all"]
    x = long_df.select(*(group_cols or [F.lit(0).alias("__all")]), F.col(value_col).cast("double").alias("__v")).filter("__v IS NOT NULL")
    marks = [min(1.0, max(0.0, p + s * 2 / accuracy)) for p in probs for s in (-1, 1)]
    sketch = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"),
                                  F.percentile_approx("__v", marks, accuracy).alias("__s"))
    small = F.col("__n") <= 4 * accuracy
    sides = [F.struct(F.lit(i).alias("t"), F.when(small, F.col("__lo")).otherwise(F.col("__s")[2 * i]).alias("lo"),
                      F.when(small, F.col("__hi")).otherwise(F.col("__s")[2 * i + 1]).alias("hi")) for i in range(len(probs))]
    brackets = sketch.select(*keys, "__n", F.array(*sides).alias("__t"))
    near = F.explode(F.filter("__t", lambda t: F.col("__v") <= t["hi"])).alias("__b")
    met = join_small(x, brackets, on=keys).select(*keys, "__n", "__v", near)
    inside = F.when(F.col("__v") >= F.col("__b.lo"), F.col("__v"))  # null stands for every row below
    counts = met.groupBy(*keys, "__n", F.col("__b.t").alias("__t"), inside.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    upto = Window.partitionBy(*keys, "__t").orderBy(F.asc_nulls_first("__v")).rowsBetween(Window.unboundedPreceding, 0)
    p = F.element_at(F.array(*[F.lit(float(v)) for v in probs]), F.col("__t") + 1)
    h = (F.col("__n") - 1) * p
    first = F.floor(h) + 1
    at = lambda rank: F.min(F.when(F.col("__v").isNotNull() & (F.col("__upto") >= rank), F.col("__v")))
    found = counts.withColumn("__upto", F.sum("__c").over(upto)).withColumn("__f", h - F.floor(h)) \
        .groupBy(*keys, "__t").agg(at(first).alias("__a"), at(F.least(first + 1, F.col("__n"))).alias("__b"), F.first("__f").alias("__f"))
    value = F.col("__a") + F.col("__f") * (F.col("__b") - F.col("__a"))
    out = found.groupBy(*keys).agg(*[F.max(F.when(F.col("__t") == i, value)).alias(quantile_name(q)) for i, q in enumerate(probs)])
    return out.select(*group_cols, *[quantile_name(q) for q in probs])


@dataclass
class ColumnStats:
    n: int
    mean: float | None
    sd: float | None
    min: float | None
    max: float | None
    quantiles: dict      # probability -> exact type-7 value (None without values)


def column_stats(df: DataFrame, cols: list[str], probs: list[float], accuracy: int = 10_000,
                 limit: int = 200_000) -> dict[str, ColumnStats]:
    """Moments and exact type-7 quantiles of whole columns, without unpivoting the table.

    One wide aggregate gives n, mean, sd, min, max and a mergeable sketch per
    column; the sketch brackets every wanted rank.  A second counts the rows
    below and inside each bracket (a bracket that misses its rank is widened
    to the column's range), and only rows inside a bracket are listed, as
    counts per value.  Brackets with more than ``limit`` values in all are
    narrowed by sketches of their own, so what is collected is bounded.
    """
    x = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    m = 3.0 / accuracy
    around = [min(1.0, max(0.0, q)) for p in probs for q in (p - m, p + m)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.avg(c).alias(f"a{i}"), F.stddev_samp(c).alias(f"s{i}"),
                 F.min(c).alias(f"l{i}"), F.max(c).alias(f"h{i}")]
        if probs:
            aggs.append(F.percentile_approx(c, around, accuracy).alias(f"q{i}"))
    row = x.agg(*aggs).first()
    out = {c: ColumnStats(row[f"n{i}"], row[f"a{i}"], row[f"s{i}"], row[f"l{i}"], row[f"h{i}"],
                          {p: None for p in probs}) for i, c in enumerate(cols)}
    todo = []        # [column, probability, first rank, second rank, lo, hi, last bracket that held, margin]
    for i, c in enumerate(cols):
        n = out[c].n
        for j, p in enumerate(probs if n else []):
            r = int(math.floor((n - 1) * p)) + 1
            todo.append([c, p, r, min(r + 1, n), row[f"q{i}"][2 * j], row[f"q{i}"][2 * j + 1], (out[c].min, out[c].max), m])
    limit = max(limit, 16 * len(todo))
    while todo:
        inside = [F.col(t[0]).between(F.lit(t[4]), F.lit(t[5])) for t in todo]
        counts = x.agg(*[F.count_if(F.col(t[0]) < F.lit(t[4])).alias(f"b{i}") for i, t in enumerate(todo)],
                       *[F.count_if(e).alias(f"i{i}") for i, e in enumerate(inside)]).first()
        missed = [i for i, t in enumerate(todo)
                  if not counts[f"b{i}"] < t[2] or not t[3] <= counts[f"b{i}"] + counts[f"i{i}"]]
        if missed:
            for i in missed:
                todo[i][4:6], todo[i][7] = todo[i][6], 2 * todo[i][7]
            continue
        if any(t[7] > 0.5 for t in todo):
            raise ValueError("quantile brackets do not narrow; raise accuracy or limit")
        held = F.filter(F.array(*[F.when(e, F.struct(F.lit(i).alias("t"), F.col(t[0]).alias("v")))
                                  for i, (e, t) in enumerate(zip(inside, todo))]), lambda s: s.isNotNull())
        got = bounded_collect(x.select(F.explode(held).alias("s")).groupBy("s.t", "s.v")
                              .agg(F.count(F.lit(1)).alias("c")), limit)
        if got is None:      # narrower brackets from sketches of what is inside
            narrow = []
            for i, t in enumerate(todo):
                at = [(r - counts[f"b{i}"]) / max(1, counts[f"i{i}"]) for r in t[2:4]]
                narrow.append(F.percentile_approx(F.when(inside[i], F.col(t[0])),
                                                  [max(0.0, at[0] - t[7]), min(1.0, at[1] + t[7])], accuracy).alias(f"q{i}"))
            bounds = x.agg(*narrow).first()
            for i, t in enumerate(todo):
                if [t[4], t[5]] == bounds[f"q{i}"]:
                    t[7] = t[7] / 2      # a sketch of few values is exact: ask for less
                t[6], t[4:6] = (t[4], t[5]), bounds[f"q{i}"]
            continue
        by: dict[int, list] = {}
        for r in got:
            by.setdefault(r["t"], []).append((r["v"], r["c"]))
        for i, (c, p, r1, r2, *_) in enumerate(todo):
            pairs = sorted(by[i])
            ends = counts[f"b{i}"] + np.cumsum([k for _, k in pairs])
            a, b = (pairs[int(np.searchsorted(ends, r))][0] for r in (r1, r2))
            h = (out[c].n - 1) * p
            out[c].quantiles[p] = a + (h - math.floor(h)) * (b - a)
        break
    return out


def quantile_name(p: float) -> str:
    return "q_" + f"{p:g}".replace(".", "_")


# ---------------------------------------------------------------------------
# Block pairs
# ---------------------------------------------------------------------------

def block_count(n: int, block_rows: int) -> int:
    return max(1, math.ceil(n / block_rows))


def via_long_key(df: DataFrame, key: str, run, id_cols: list[str], *more: DataFrame) -> DataFrame:
    """``run(df, *more)`` on long keys, whatever the key's type.

    Integer keys go through as they are.  Any other key is numbered in key order
    (a distributed sort), ``run`` sees the numbers under the same column
    name, and ``id_cols`` of its result are turned back.
    """
    from vela.session import cut_lineage
    if isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return run(df, *more)
    keys = df.select(key)
    for m in more:
        keys = keys.unionByName(m.select(key))
    ids = cut_lineage(keys.distinct().orderBy(key).withColumn("__kid", F.monotonically_increasing_id()))
    swap = [t.join(ids, key).drop(key).withColumnRenamed("__kid", key) for t in (df, *more)]
    out = run(*swap)
    cols = out.columns
    for c in id_cols:
        out = out.join(ids.select(F.col("__kid").alias(c), F.col(key).alias("__text")), c, "left") \
            .drop(c).withColumnRenamed("__text", c)
    return out.select(*cols)


def pack_blocks(df: DataFrame, key: str, vec: Column, n_blocks: int,
                tag: Column | None = None, together: list[Column] | None = None) -> DataFrame:
    """Pack rows into ``n_blocks`` blocks: (blk, keys array<long>, vecs flat
    array<double>, tags array<long>).  Blocks are hash-spread by key, or by ``together``."""
    x = df.select(F.col(key).cast("long").alias("k"), vec.alias("v"),
                  (tag if tag is not None else F.lit(0)).cast("long").alias("t"),
                  F.pmod(F.xxhash64(*(together or [F.col(key)])), F.lit(n_blocks)).cast("long").alias("blk"))
    return (x.groupBy("blk")
            .agg(F.collect_list(F.struct("k", "v", "t")).alias("rows"))
            .select("blk",
                    F.transform("rows", lambda r: r["k"]).alias("keys"),
                    F.flatten(F.transform("rows", lambda r: r["v"])).alias("vecs"),
                    F.transform("rows", lambda r: r["t"]).alias("tags")))


#: Bytes of vectors one strip of the grid holds; a task keeps one strip and a block of the other.
STRIP_BYTES = 64 << 20


def grid_side(n_blocks: int, total_bytes: int, cores: int) -> int:
    """Strips per side: as few as keep every core busy and a strip within ``STRIP_BYTES``."""
    return max(1, min(n_blocks, max(math.ceil(total_bytes / STRIP_BYTES), math.ceil(math.sqrt(2 * cores)))))


def map_block_pairs(blocks: DataFrame, n_blocks: int, total_bytes: int, fn, schema: str,
                    other: DataFrame | None = None, n_other: int | None = None, other_bytes: int = 0, fold=None) -> DataFrame:
    """``fn`` over every pair of blocks, on a square grid of tasks.

    Blocks are dealt to strips; the task of cell (i, j) reads strip i and strip j
    and meets all their block pairs.  A block therefore travels once per strip of
    the other side (about the square root of the tasks), not once per pair.
    Without ``other`` only cells i <= j exist and every unordered pair of blocks is
    met once.  A task holds strip i and streams strip j block by block; ``fn``
    takes and yields frames (one row: a, b, ka, va, ta, kb, vb, tb) and its output
    is passed on pair by pair.  ``fold`` instead makes an object for each cell that
    takes the same rows by ``pair``; ``streamed``, after a block of strip j has met
    strip i, and ``end`` yield the frames.
    """
    cores = max(1, blocks.sparkSession.sparkContext.defaultParallelism)
    own = other is None
    g = grid_side(n_blocks, total_bytes, cores)
    h = g if own else grid_side(n_other, other_bytes, cores)
    cols = ["blk", "keys", "vecs", "tags"]
    strip = lambda k: F.pmod("blk", F.lit(k)).cast("int")
    every = lambda lo, hi: F.explode(F.sequence(lo, hi))
    # the cells of the upper triangle (or the rectangle) in one row of numbers, each a partition of its own
    number = (lambda i, j: (j * (j + 1) / 2 + i).cast("int")) if own else (lambda i, j: (i * h + j).cast("int"))
    cells = g * (g + 1) // 2 if own else g * h
    left = blocks.select(*cols, strip(g).alias("i")).withColumn("j", every(F.col("i") if own else F.lit(0), F.lit(h - 1)))
    right = (blocks if own else other).select(*cols, strip(h).alias("j")).withColumn("i", every(F.lit(0), F.col("j") if own else F.lit(g - 1)))
    sent = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    sent = sent.select(number(F.col("i"), F.col("j")).alias("cell"), (F.col("i") == F.col("j")).alias("diagonal"), "side", *cols)

    def meet(frames):
        import pandas as pd
        cell, held, kept = None, [], None
        for frame in frames:
            for r in frame.itertuples(index=False):
                if r.cell != cell:
                    if kept is not None:
                        yield from kept.end()
                    cell, held, kept = r.cell, [], fold() if fold else None
                if r.side == 0:
                    held.append(r)
                    continue
                for x in held:
                    if not own or not r.diagonal or x.blk <= r.blk:
                        row = {"a": x.blk, "b": r.blk if own else -1 - r.blk, "ka": x.keys, "va": x.vecs, "ta": x.tags, "kb": r.keys, "vb": r.vecs, "tb": r.tags}
                        if kept is not None:
                            kept.pair(row)
                        else:
                            yield from fn(iter([pd.DataFrame({c: [v] for c, v in row.items()})]))
                if kept is not None:
                    yield from kept.streamed()
        if kept is not None:
            yield from kept.end()

    return sent.repartitionById(cells, "cell").sortWithinPartitions("cell", "side", "blk").mapInPandas(meet, schema)


def block_arrays(row, side: str, d: int):
    keys = np.asarray(row["k" + side], dtype=np.int64)
    vecs = np.asarray(row["v" + side], dtype=np.float64).reshape(len(keys), d) if len(keys) else \
        np.zeros((0, d))
    tags = np.asarray(row["t" + side], dtype=np.int64)
    return keys, vecs, tags


def sq_dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances, exact enough for ties (diff form)."""
    # (a-b)^2 expanded loses precision for near points; use the direct form
    # in chunks to bound memory.
    out = np.empty((a.shape[0], b.shape[0]))
    step = max(1, 2_000_000 // max(1, b.shape[0] * max(1, a.shape[1])))
    for s in range(0, a.shape[0], step):
        diff = a[s:s + step, None, :] - b[None, :, :]
        out[s:s + step] = np.einsum("ijk,ijk->ij", diff, diff)
    return out


def pair_sq_dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``sq_dists`` of row i of a and row i of b, by the same sums."""
    out = np.empty(len(a))
    step = max(1, 2_000_000 // max(1, a.shape[1]))
    for s in range(0, len(a), step):
        diff = (a[s:s + step] - b[s:s + step])[:, None, :]
        out[s:s + step] = np.einsum("ijk,ijk->ij", diff, diff)[:, 0]
    return out


def rough_sq_dists(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """(D, slack): squared distances by one matrix product, each within ``slack`` of ``sq_dists``.

    Of few features, or with values that are not finite, they are ``sq_dists`` itself."""
    d = a.shape[1]
    if d >= 16 and len(a) and len(b):
        na, nb = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
        slack = 8 * (d + 4) * np.finfo(float).eps * float(na.max() + nb.max())
        if np.isfinite(slack):
            D = a @ b.T
            D *= -2
            D += na[:, None]
            D += nb[None, :]
            return D, slack
    return sq_dists(a, b), 0.0


def near_sq_dists(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances for sums: by one matrix product, the small ones (where it loses digits) directly."""
    return near_and_slack(a, b)[0]


def near_and_slack(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """``near_sq_dists``, and by how much their roots may be off."""
    D, slack = rough_sq_dists(a, b)
    if slack:
        i, j = np.nonzero(D < 2.0 ** 30 * slack)
        if 4 * len(i) > D.size:
            return sq_dists(a, b), 0.0
        D[i, j] = pair_sq_dists(a[i], b[j])
    return D, math.sqrt(slack) * 2.0 ** -15


# ---------------------------------------------------------------------------
# P5: grouped moments
# ---------------------------------------------------------------------------

@dataclass
class Moments:
    groups: list          # group values
    n: np.ndarray         # (g,)
    mean: np.ndarray      # (g, d)
    scatter: np.ndarray   # (g, d, d) sum of (x-mean)(x-mean)^T

    def total(self):
        n = self.n.sum()
        mean = (self.n[:, None] * self.mean).sum(0) / n
        sc = self.scatter.sum(0)
        for g in range(len(self.n)):
            dm = self.mean[g] - mean
            sc = sc + self.n[g] * np.outer(dm, dm)
        return n, mean, sc


def grouped_moments(df: DataFrame, vec: Column, group: str | None = None,
                    shift: np.ndarray | None = None) -> Moments:
    """(n, mean, scatter) per group.  Partials per Arrow batch in numpy,
    summed by Spark over (group, position); the collected result has
    groups x (1 + d + d^2) numbers.  ``shift`` (e.g. a first-pass mean) is
    subtracted before squaring for accuracy."""
    gcol = F.col(group).cast("string") if group else F.lit("")
    x = df.select(gcol.alias("g"), vec.alias("v"))
    first = x.select(F.size("v").alias("d")).head(1)
    if not first:
        raise ValueError("no rows")
    d = int(first[0]["d"])
    if shift is None:
        shift = np.zeros(d)
    shift = np.asarray(shift, dtype=np.float64)
    if d <= SQL_MOMENTS_MAX_D:
        return _sql_moments(x, d, shift)

    def partial(it):
        import pandas as pd
        acc: dict = {}
        for pdf in it:
            if len(pdf) == 0:
                continue
            for g, sub in pdf.groupby("g", sort=False):
                m = np.stack(sub["v"].to_numpy()).astype(np.float64) - shift
                n0, s0, q0 = acc.get(g, (0, np.zeros(d), np.zeros((d, d))))
                acc[g] = (n0 + len(m), s0 + m.sum(0), q0 + m.T @ m)
        if acc:
            yield pd.DataFrame({
                "g": list(acc.keys()),
                "n": [a[0] for a in acc.values()],
                "s": [a[1] for a in acc.values()],
                "q": [a[2].ravel() for a in acc.values()],
            })

    parts = x.mapInPandas(partial, "g string, n long, s array<double>, q array<double>")
    flat = parts.select("g", F.posexplode(F.concat(F.array(F.col("n").cast("double")), "s", "q"))
                        .alias("p", "x"))
    sums = flat.groupBy("g", "p").agg(F.sum("x").alias("x")).collect()
    gs = sorted({r["g"] for r in sums})
    idx = {g: i for i, g in enumerate(gs)}
    A = np.zeros((len(gs), 1 + d + d * d))
    for r in sums:
        A[idx[r["g"]], r["p"]] = r["x"]
    ns = {g: A[idx[g], 0] for g in gs}
    S = A[:, 1:1 + d]
    Q = A[:, 1 + d:]
    n = np.array([ns[g] for g in gs], dtype=np.float64)
    mean_shifted = S / n[:, None]
    scatter = Q.reshape(len(gs), d, d) - n[:, None, None] * \
        np.einsum("gi,gj->gij", mean_shifted, mean_shifted)
    return Moments(gs, n, mean_shifted + shift, scatter)


# Up to this many features the moments are plain SQL sums (JVM, codegen);
# above it numpy partials avoid d^2 aggregate expressions.
SQL_MOMENTS_MAX_D = 24


def _sql_moments(x: DataFrame, d: int, shift: np.ndarray) -> Moments:
    c = [(F.col("v")[i] - F.lit(float(shift[i]))) for i in range(d)]
    aggs = [F.count(F.lit(1)).alias("n")] + [F.sum(c[i]).alias(f"s{i}") for i in range(d)] + \
        [F.sum(c[i] * c[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]
    rows = x.groupBy("g").agg(*aggs).collect()
    gs = sorted(r["g"] for r in rows)
    by = {r["g"]: r for r in rows}
    n = np.array([by[g]["n"] for g in gs], dtype=np.float64)
    S = np.array([[by[g][f"s{i}"] for i in range(d)] for g in gs], dtype=np.float64)
    Q = np.zeros((len(gs), d, d))
    for k, g in enumerate(gs):
        for i in range(d):
            for j in range(i, d):
                Q[k, i, j] = Q[k, j, i] = by[g][f"q{i}_{j}"]
    m = S / n[:, None]
    scatter = Q - n[:, None, None] * np.einsum("gi,gj->gij", m, m)
    return Moments(gs, n, m + shift, scatter)


def column_means(df: DataFrame, vec: Column, d: int) -> np.ndarray:
    """First-pass means of an array column (one aggregate)."""
    x = df.select(vec.alias("v"))
    row = x.agg(*[F.avg(F.col("v")[i]).alias(f"m{i}") for i in range(d)]).collect()[0]
    return np.array([row[f"m{i}"] for i in range(d)], dtype=np.float64)


# ---------------------------------------------------------------------------
# Connected components
# ---------------------------------------------------------------------------

def connected_components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 100,
                         checkpoint_every: int = 4) -> DataFrame:
    """(v, comp): the smallest vertex id of each component.

    ``vertices`` has a long column ``v``; ``edges`` has long ``i``, ``j``
    (undirected).  Each round: min label over neighbours, then pointer
    jumping (label of the label), until no label changes.  Lineage is cut
    with reliable checkpoints into the shared folder."""
    from vela.session import cut_lineage
    e = edges.select("i", "j").unionByName(edges.select(F.col("j").alias("i"), F.col("i").alias("j"))) \
        .filter(F.col("i") != F.col("j")).distinct()
    e = cut_lineage(e)
    lab = cut_lineage(vertices.select("v", F.col("v").alias("l")))
    for r in range(max_rounds):
        nb = e.join(lab.withColumnRenamed("v", "j"), "j").groupBy(F.col("i").alias("v")) \
            .agg(F.min("l").alias("nl"))
        step = lab.join(nb, "v", "left").select("v", F.least("l", F.coalesce("nl", "l")).alias("l"))
        jump = step.join(step.select(F.col("v").alias("l"), F.col("l").alias("ll")), "l", "left") \
            .select("v", F.least("l", F.coalesce("ll", "l")).alias("l"))
        jump = cut_lineage(jump)
        changed = jump.join(lab.withColumnRenamed("l", "old"), "v").filter(F.col("l") != F.col("old")) \
            .limit(1).count()
        lab = jump
        if changed == 0:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return lab.withColumnRenamed("l", "comp")
