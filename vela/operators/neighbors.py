"""Distances and neighbours (theta joins) through block pairs.

All-pairs work is O(n^2 d) compute by nature; these operators keep the
*shuffle* small by reducing inside each block pair (top-k, within-eps pairs,
per-cluster sums) and never build a per-pair row unless the pair itself is
the output (``pairwise_distance``).
"""
from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vela.functions.columns import feature_array
from vela.operators.patterns import (block_arrays, block_count, column_stats, join_small, map_block_pairs,
                                     pack_blocks, pair_sq_dists, rough_sq_dists, sq_dists, via_long_key)
from vela.session import cut_lineage

# Exact all-pairs output is refused above this many rows unless forced.
PAIRWISE_ROW_LIMIT = 200_000


def _setup(df: DataFrame, key: str, features, block_rows: int | None, tag=None):
    spark = df.sparkSession
    n = df.count()
    par = max(1, spark.sparkContext.defaultParallelism)
    br = block_rows or int(min(2048, max(16, math.ceil(n / max(1, int(math.sqrt(8 * par)))))))
    nb = block_count(n, br)
    vec = feature_array(df, features)
    d = df.select(F.size(vec).alias("d")).head(1)[0]["d"]
    blocks = pack_blocks(df, key, vec, nb, tag)
    return n, nb, d, blocks


def pairwise_distance(df: DataFrame, key: str, features, block_rows: int | None = None,
                      force: bool = False) -> DataFrame:
    """Euclidean distance of every pair (i < j by key): (key_i, key_j, dist)."""
    return via_long_key(df, key, lambda x: _pairwise(x, key, features, block_rows, force), [f"{key}_i", f"{key}_j"])


def _pairwise(df, key, features, block_rows, force):
    n, nb, d, blocks = _setup(df, key, features, block_rows)
    if n > PAIRWISE_ROW_LIMIT and not force:
        raise ValueError(f"{n} rows make {n * (n - 1) // 2} pairs; pass force=True")

    def emit(it):
        import pandas as pd
        for pdf in it:
            for _, row in pdf.iterrows():
                ka, va, _ = block_arrays(row, "a", d)
                kb, vb, _ = block_arrays(row, "b", d)
                if not len(ka) or not len(kb):
                    continue
                D = np.sqrt(sq_dists(va, vb))
                I, J = np.meshgrid(np.arange(len(ka)), np.arange(len(kb)), indexing="ij")
                a, b = ka[I.ravel()], kb[J.ravel()]
                keep = a < b if row["a"] == row["b"] else np.ones(len(a), bool)
                lo, hi = np.minimum(a, b)[keep], np.maximum(a, b)[keep]
                yield pd.DataFrame({"i": lo, "j": hi, "dist": D.ravel()[keep]})

    out = map_block_pairs(blocks, nb, 8 * n * d, emit, "i long, j long, dist double")
    return out.select(F.col("i").alias(f"{key}_i"), F.col("j").alias(f"{key}_j"), "dist")


def knn(df: DataFrame, key: str, features, k: int, reference: DataFrame | None = None,
        block_rows: int | None = None, exclude_self: bool = True) -> DataFrame:
    """The ``k`` nearest reference rows of every query row, exact; ties
    in distance go to the lower key.  (key, neighbor, dist, rank).

    Each cell of the grid keeps only its k best candidates per row, both ways, so
    at most k x strips candidates per row are shuffled, however many blocks there
    are; a row_number per key (bounded group) picks the final k.  Without
    ``reference`` the table is its own reference (self excluded).  A cell breaks
    ties itself, so a point held by many rows gives k candidates a cell, not all
    of them."""
    if reference is None:
        return via_long_key(df, key, lambda x: _knn(x, key, features, k, None, block_rows, exclude_self),
                            [key, "neighbor"])
    return via_long_key(df, key, lambda x, r: _knn(x, key, features, k, r, block_rows, exclude_self),
                        [key, "neighbor"], reference)


class _Nearest:
    """The k first reference rows by (distance, key) of the rows that a cell has seen.

    A pair of blocks only looks at distances up to the k-th best so far of a row.
    Rows of strip i stay until the cell ends, those of strip j until their block does."""

    def __init__(self, k: int, d: int, both: bool, exclude: bool):
        self.k, self.d, self.both, self.exclude = k, d, both, exclude
        self.held, self.stream = {}, {}

    def pair(self, row) -> None:
        ka, va, _ = block_arrays(row, "a", self.d)
        kb, vb, _ = block_arrays(row, "b", self.d)
        if not len(ka) or not len(kb):
            return
        D, slack = rough_sq_dists(va, vb)
        if self.exclude and np.isin(ka, kb).any():
            D[ka[:, None] == kb[None, :]] = np.inf
        self._add(self.held, row["a"], ka, kb, D, va, vb, slack)
        if self.both and row["a"] != row["b"]:
            self._add(self.stream, row["b"], kb, ka, D.T, vb, va, slack)

    def _add(self, kept, blk, qk, rk, M, qv, rv, slack) -> None:
        if blk not in kept:
            kept[blk] = (qk, np.full((len(qk), self.k), np.inf), np.zeros((len(qk), self.k), dtype=np.int64))
        _, best, names = kept[blk]
        # all that may be among the k first: up to the k-th distance so far, or up to the k-th here
        limit = best[:, -1] + slack
        if not np.isfinite(limit).all() and self.k < M.shape[1]:
            here = np.partition(M, self.k - 1, axis=1)[:, self.k - 1] + 2 * slack
            limit = np.fmin(limit, here)
        R, C = np.nonzero((M <= limit[:, None]) & np.isfinite(M))
        if not len(R):
            return
        d2 = pair_sq_dists(qv[R], rv[C]) if slack else M[R, C]
        rows = np.unique(R)
        old_r, old_d, old_n = np.repeat(rows, self.k), best[rows].ravel(), names[rows].ravel()
        full = np.isfinite(old_d)
        R, d2, nb = np.concatenate((R, old_r[full])), np.concatenate((d2, old_d[full])), np.concatenate((rk[C], old_n[full]))
        by = np.lexsort((nb, d2, R))
        R, d2, nb = R[by], d2[by], nb[by]
        at = np.arange(len(R)) - np.searchsorted(R, R)
        first = at < self.k
        best[R[first], at[first]], names[R[first], at[first]] = d2[first], nb[first]

    def _frames(self, kept):
        import pandas as pd
        for qk, best, names in kept.values():
            R, C = np.nonzero(np.isfinite(best))
            yield pd.DataFrame({"q": qk[R], "nb": names[R, C], "d2": best[R, C]})
        kept.clear()

    def streamed(self):
        return self._frames(self.stream)

    def end(self):
        return self._frames(self.held)


def _knn(df, key, features, k, reference, block_rows, exclude_self):
    if reference is None:
        n, nb, d, blocks = _setup(df, key, features, block_rows)
        other = ()
        same = True
    else:
        n, nb, d, blocks = _setup(df, key, features, block_rows)
        m, mb, _, rblocks = _setup(reference, key, features, block_rows)
        other = (rblocks, mb, 8 * m * d)
        same = False

    own = exclude_self and same
    cand = map_block_pairs(blocks, nb, 8 * n * d, None, "q long, nb long, d2 double", *other, fold=lambda: _Nearest(k, d, same, own))
    w = Window.partitionBy("q").orderBy("d2", "nb")
    return (cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select(F.col("q").alias(key), F.col("nb").alias("neighbor"),
                    F.sqrt("d2").alias("dist"), F.col("rank").cast("int").alias("rank")))


def kth_neighbor_distance(df: DataFrame, key: str, features, k: int) -> DataFrame:
    """Distance from every row to its k-th nearest other row."""
    nn = knn(df, key, features, k)
    return nn.filter(F.col("rank") == k).select(key, F.col("dist").alias("kdist"))


def knn_distance_quantile(df: DataFrame, key: str, features, k: int, p: float = 0.9) -> DataFrame:
    """The ``p`` quantile (exact, type 7) of the k-th neighbour distance:
    the usual DBSCAN radius estimate."""
    kd = cut_lineage(kth_neighbor_distance(df, key, features, k))
    q = column_stats(kd, ["kdist"], [p])["kdist"].quantiles[p]
    return df.sparkSession.createDataFrame([(q,)], "eps double")


def within_eps(df: DataFrame, key: str, features, eps: float, block_rows: int | None = None) -> DataFrame:
    """Pairs (i < j) closer than ``eps`` (the DBSCAN neighbourhood edges).

    Every pair of rows lies in one block pair, so the pairs are distinct."""
    return via_long_key(df, key, lambda x: _within_eps(x, key, features, eps, block_rows), ["i", "j"])


def _within_eps(df, key, features, eps, block_rows):
    def pairs(row, d):
        import pandas as pd
        ka, kb, I, J, _, _ = _near(row, d, eps * eps)
        a, b = ka[I], kb[J]
        keep = a < b if row["a"] == row["b"] else a != b
        return pd.DataFrame({"i": np.minimum(a, b)[keep], "j": np.maximum(a, b)[keep]})

    return _eps_pairs(df, key, features, eps, block_rows, lambda d: lambda: _Each(lambda row: pairs(row, d)), "i long, j long")


def cells_help(df: DataFrame, key: str, features, eps: float) -> bool:
    """Whether ``EpsCells`` leave less than half of the pairs."""
    n = df.count()
    return bool(eps > 0 and n > 1 and 2 * EpsCells(df, key, features, eps).pairs < n * (n - 1) / 2)


def _eps_pairs(df, key, features, eps, block_rows, fold, schema, tag=None, in_cells=None):
    """What ``fold(width)`` makes of all block pairs that may hold rows within ``eps``."""
    n, nb, d, blocks = _setup(df, key, features, block_rows, tag)
    if cells_help(df, key, features, eps) if in_cells is None else in_cells:
        make = fold(d)

        def each(frames):
            for pdf in frames:
                for _, row in pdf.iterrows():
                    kept = make()
                    kept.pair(row)
                    yield from kept.streamed()
                    yield from kept.end()

        return EpsCells(df, key, features, eps, tag=tag).map_pairs(each, schema)
    return map_block_pairs(blocks, nb, 8 * n * d, None, schema, fold=fold(d))


def _near(row, d: int, e2: float):
    """(keys a, keys b, I, J, tags a, tags b): the pairs (I, J) within; a key is not its own neighbour."""
    ka, va, ta = block_arrays(row, "a", d)
    kb, vb, tb = block_arrays(row, "b", d)
    if not len(ka) or not len(kb):
        none = np.zeros(0, dtype=np.int64)
        return ka, kb, none, none, ta, tb
    na, nb = np.einsum("ij,ij->i", va, va), np.einsum("ij,ij->i", vb, vb)
    slack = 8 * (d + 4) * np.finfo(float).eps * float(na.max() + nb.max())
    if d >= 16 and np.isfinite(slack):  # as rough_sq_dists, with -D / 2 from the one product
        G = np.column_stack((va, -na / 2, np.ones(len(va)))) @ np.column_stack((vb, np.ones(len(vb)), -nb / 2)).T
        I, J = np.nonzero(G >= -(e2 + slack) / 2)
        unsure = np.flatnonzero(G[I, J] <= -(e2 - slack) / 2)
        far = pair_sq_dists(va[I[unsure]], vb[J[unsure]]) > e2
        I, J = np.delete(I, unsure[far]), np.delete(J, unsure[far])
    else:
        I, J = np.nonzero(sq_dists(va, vb) <= e2)
    if np.isin(ka, kb).any():
        other = ka[I] != kb[J]
        I, J = I[other], J[other]
    return ka, kb, I, J, ta, tb


class _Each:
    """A fold without memory: what ``make`` yields for a pair of blocks goes on with its block."""

    def __init__(self, make):
        self.make, self.found = make, []

    def pair(self, row) -> None:
        self.found.append(self.make(row))

    def streamed(self):
        yield from self.found
        self.found = []

    def end(self):
        return iter(())


class _Counts:
    """Neighbours of every row among those that a cell has met."""

    def __init__(self, d: int, e2: float):
        self.d, self.e2, self.held, self.stream = d, e2, {}, {}

    def pair(self, row) -> None:
        ka, kb, I, J, _, _ = _near(row, self.d, self.e2)
        self._add(self.held, row["a"], ka, np.bincount(I, minlength=len(ka)))
        if row["a"] != row["b"]:
            self._add(self.stream, row["b"], kb, np.bincount(J, minlength=len(kb)))

    @staticmethod
    def _add(kept, block, keys, found) -> None:
        if block in kept:
            kept[block][1][:] += found
        else:
            kept[block] = (keys, found.astype(np.int64))

    def _frames(self, kept):
        import pandas as pd
        for keys, found in kept.values():
            yield pd.DataFrame({"v": keys[found > 0], "nb": found[found > 0]})
        kept.clear()

    def streamed(self):
        return self._frames(self.stream)

    def end(self):
        return self._frames(self.held)


class _Links:
    """Links that join what the pairs within eps join, at most one a row of the cell.

    Rows with tag 1 (all, or the core rows) are put in components by their pairs, and a
    component leaves as links of its rows to one of them (kind 0).  A row with tag 0
    leaves each of its pairs with a row of tag 1 (kind 1); such rows have few."""

    def __init__(self, d: int, e2: float):
        self.d, self.e2, self.at, self.keys, self.up, self.other = d, e2, {}, [], np.zeros(0, dtype=np.int64), []

    def _place(self, block, keys) -> int:
        if block not in self.at:
            self.at[block] = len(self.up)
            self.keys.append(keys)
            self.up = np.concatenate((self.up, np.arange(len(self.up), len(self.up) + len(keys))))
        return self.at[block]

    def pair(self, row) -> None:
        ka, kb, I, J, ta, tb = _near(row, self.d, self.e2)
        a, b = self._place(row["a"], ka), self._place(row["b"], kb)
        if not (ta.all() and tb.all()):
            x, y = ta[I] != 0, tb[J] != 0
            for one, i, j in ((~x & y, ka[I], kb[J]), (x & ~y, kb[J], ka[I])):
                if one.any():
                    self.other.append((i[one], j[one]))
            I, J = I[x & y], J[x & y]
        self._join(a + I, b + J)

    def _join(self, p, q) -> None:
        up = self.up
        while True:
            x, y = up[p], up[q]
            apart = x != y
            if not apart.any():
                return
            p, q, x, y = p[apart], q[apart], x[apart], y[apart]
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while True:
                above = up[up]
                if (above == up).all():
                    break
                up[:] = above

    def streamed(self):
        import pandas as pd
        for i, j in self.other:
            yield pd.DataFrame({"i": i, "j": j, "kind": 1})
        self.other = []

    def end(self):
        import pandas as pd
        if self.keys:
            keys = np.concatenate(self.keys)
            i, j = keys, keys[self.up]
            yield pd.DataFrame({"i": i[i != j], "j": j[i != j], "kind": 0})


def eps_counts(df: DataFrame, key: str, features, eps: float, block_rows: int | None = None, in_cells: bool | None = None) -> DataFrame:
    """(v, nb): how many other rows lie within ``eps``, of rows that have any (integer keys).

    Counts are summed in the cells of the grid, so no pair leaves a task."""
    found = _eps_pairs(df, key, features, eps, block_rows, lambda d: lambda: _Counts(d, eps * eps), "v long, nb long", None, in_cells)
    return found.groupBy("v").agg(F.sum("nb").alias("nb"))


def eps_links(df: DataFrame, key: str, features, eps: float, block_rows: int | None = None, tag=None, in_cells: bool | None = None) -> DataFrame:
    """(i, j, kind): links with the components of the pairs within ``eps`` (integer keys).

    Without ``tag`` (1 or 0) all rows link.  Else kind 0 joins rows of tag 1, and kind 1
    are all pairs of a row i of tag 0 with a row j of tag 1."""
    tag = F.lit(1) if tag is None else tag
    return _eps_pairs(df, key, features, eps, block_rows, lambda d: lambda: _Links(d, eps * eps), "i long, j long, kind int", tag, in_cells)


class EpsCells:
    """Rows in square cells of width eps on the leading principal axes.

    A projection never lengthens a distance, so two rows within eps lie in the
    same or in neighbouring cells; only those cells' blocks meet, and exact
    distances decide inside.  ``pairs`` is the number of row pairs that meet.
    """

    def __init__(self, df: DataFrame, key: str, features, eps: float, axes: int = 3, block_rows: int = 2048, tag=None):
        from vela.operators.reduce import pca_fit
        vec = feature_array(df, features)
        model = pca_fit(df, features)
        axes = min(axes, model.loadings.shape[1])
        at = []
        for k in range(axes):
            w = model.loadings[:, k]
            place = F.lit(0.0)
            for i, x in enumerate(w):
                place = place + vec[i] * F.lit(float(x))
            at.append(F.floor(place / F.lit(eps * (1 + 1e-9))).cast("long"))
        rows = df.select(F.col(key).cast("long").alias("k"), vec.alias("v"), (F.lit(0) if tag is None else tag).cast("long").alias("t"), F.array(*at).alias("cell"))
        self.rows, self.axes, self.block_rows = rows, axes, block_rows
        counts = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        self.cells = cut_lineage(counts.withColumn("subs", F.ceil(F.col("n") / block_rows).cast("int")))
        near = self._near()
        self.pairs = int(near.agg(F.sum(F.when(F.col("own"), F.col("n") * (F.col("n") - 1) / 2).otherwise(F.col("n") * F.col("m")))).first()[0] or 0)

    def _near(self) -> DataFrame:
        """(cell, n, subs, to, m, to_subs, own): every cell with itself and each later neighbour."""
        steps = [[]]
        for _ in range(self.axes):
            steps = [[*s, o] for s in steps for o in (-1, 0, 1)]
        later = [s for s in steps if s >= [0] * self.axes]
        offset = F.explode(F.array(*[F.array(*[F.lit(o).cast("long") for o in s]) for s in later])).alias("o")
        left = self.cells.select("cell", "n", "subs", offset).select("cell", "n", "subs", F.zip_with("cell", "o", lambda a, b: a + b).alias("to"))
        right = self.cells.select(F.col("cell").alias("to"), F.col("n").alias("m"), F.col("subs").alias("to_subs"))
        return left.join(right, "to").withColumn("own", F.col("cell") == F.col("to"))

    def map_pairs(self, fn, schema: str) -> DataFrame:
        """``fn`` over the pairs of blocks of neighbouring cells (rows as in ``map_block_pairs``)."""
        sub = F.pmod(F.xxhash64("k"), F.col("subs")).cast("int")
        placed = join_small(self.rows, self.cells.select("cell", "subs"), ["cell"]).select("k", "v", "t", "cell", sub.alias("sub"))
        packed = placed.groupBy("cell", "sub").agg(F.collect_list(F.struct("k", "v", "t")).alias("r"))
        packed = packed.select("cell", "sub", F.transform("r", lambda r: r["k"]).alias("keys"), F.flatten(F.transform("r", lambda r: r["v"])).alias("vecs"), F.transform("r", lambda r: r["t"]).alias("tags"))
        packed = cut_lineage(packed)
        upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        pairs = self._near().withColumn("sub", upto("subs")).withColumn("to_sub", upto("to_subs")).where("NOT own OR sub <= to_sub").select("cell", "sub", "to", "to_sub")
        left = packed.select("cell", "sub", F.col("keys").alias("ka"), F.col("vecs").alias("va"), F.col("tags").alias("ta"))
        right = packed.select(F.col("cell").alias("to"), F.col("sub").alias("to_sub"), F.col("keys").alias("kb"), F.col("vecs").alias("vb"), F.col("tags").alias("tb"))
        met = pairs.join(left, ["cell", "sub"]).join(right, ["to", "to_sub"])
        other = ((F.col("cell") != F.col("to")) | (F.col("sub") != F.col("to_sub"))).cast("long")
        return met.select(F.lit(0).cast("long").alias("a"), other.alias("b"), "ka", "va", "ta", "kb", "vb", "tb").mapInPandas(fn, schema)
