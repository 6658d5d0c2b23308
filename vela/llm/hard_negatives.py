"""Hard negatives by exact inner-product search over anchor clusters with shared candidate lists.

Anchors are clustered by direction.  For an anchor u of a cluster with centre c
whose members lie within angle s of c, a candidate v at angle t to c scores at
most |u| |v| cos(max(0, t - s)).  Each cluster therefore sorts its candidates
once by |v| cos(max(0, t - s)), and every member walks that one list, block by
block, until the bound of the rest certifies that nothing better can follow.

Spark deals the work as a grid: anchors in strips of whole clusters (a cluster
too large for a strip is split), candidates in strips of bounded bytes; a task
walks one strip against the other and returns at most k rows per anchor (and
positive), of which a ranked window keeps the best k overall.  One walk finds
the positives, a second one the negatives inside each positive's score band.

Defined results: rows with a null label, a null vector or any null or
non-finite component take no part; a missing component of a shorter vector is 0.
Repeated rows are rows of their own (a copy of an anchor can be its positive).
Ties in score go to the smaller id, a null id last.  Empty tables, or tables
without an anchor, give no rows.  Ids are integers.  Quantised components must
fit 32 bits; a larger one is an error.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vela.llm.common import cut, partitions_for
from vela.llm.textbytes import buffers, release

_NONE = np.iinfo(np.int64).min
_FOUND = "anchor long, slot int, score long, id long, row long"


def quantised(vectors: DataFrame, scale: float) -> DataFrame:
    """(id, label, vec) of the rows that take part; vec holds floor(scale * x) as 32-bit integers."""

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec")
            flat = lists.flatten()
            values = np.floor(flat.cast(pa.float64()).to_numpy(zero_copy_only=False) * scale)
            bad = ~np.isfinite(values)
            sizes = lists.value_lengths().to_numpy()
            ends = np.cumsum(sizes)
            wrong = np.concatenate(([0], np.cumsum(bad)))
            ok = wrong[ends] == wrong[ends - sizes]
            if (np.abs(values[~bad]) >= 2.0 ** 31).any():
                raise ValueError("a quantised vector component needs more than 32 bits")
            ints = np.where(bad, 0, values).astype("<i4")
            packed = [ints[b - n:b].tobytes() for b, n in zip(ends.tolist(), sizes.tolist())]
            out = pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array(packed, pa.binary())], names=["id", "label", "vec"])
            yield out.filter(pa.array(ok))
            release()

    taking = vectors.where("label IS NOT NULL AND vec IS NOT NULL")
    return taking.select("id", "label", "vec").mapInArrow(floor, "id long, label string, vec binary")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    data, offsets = buffers(column)
    sizes = np.diff(offsets) // 4
    flat = np.frombuffer(data.tobytes(), dtype="<i4").astype(float)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _unit(vectors: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(vectors, axis=1, keepdims=True)
    return vectors / np.where(norms == 0, 1, norms)


def fit_centres(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means over a bounded sample of anchors (unit centres)."""
    x = _unit(sample)
    centres = x[np.linspace(0, len(x) - 1, clusters).astype(int)]
    for _ in range(rounds):
        near = (x @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        held = np.linalg.norm(sums, axis=1) > 0
        centres = np.where(held[:, None], _unit(sums), centres)
    return centres


class _Candidates:
    """A strip of candidates in id order, so that a place in it breaks ties."""

    def __init__(self, table: pa.Table, width: int):
        ids = table["id"]
        rank = np.lexsort((table["row"].to_numpy(), ids.fill_null(0).to_numpy(), ids.is_null().to_numpy()))
        table = table.take(pa.array(rank))
        self.ids, self.rows, self.labels = table["id"], table["row"].to_numpy(), table["label"]
        self.vec = _matrix(table["vec"].combine_chunks(), width)
        self.norms = np.linalg.norm(self.vec, axis=1)
        self.n = len(self.rows)
        if self.n and 2 * width * max(1.0, self.norms.max()) ** 2 >= 2.0 ** 53:
            self.exact = self.vec.astype(np.int64)  # products beyond the exact range of doubles
        else:
            self.exact = self.vec

    def bounds(self, centre: np.ndarray, spread: float) -> tuple[np.ndarray, np.ndarray]:
        """(candidates by falling bound, their bounds for an anchor of length 1)."""
        cosine = self.vec @ centre / np.where(self.norms == 0, 1, self.norms)
        angle = np.arccos(np.clip(cosine, -1, 1))
        bound = self.norms * np.cos(np.maximum(0, angle - spread))
        order = np.argsort(-bound, kind="stable")
        return order, bound[order]


def _walk(near: _Candidates, codes: np.ndarray, order: np.ndarray, bound: np.ndarray, members: np.ndarray, own_codes: np.ndarray, own_rows: np.ndarray,
          low: np.ndarray | None, high: np.ndarray | None, k: int) -> tuple[np.ndarray, int]:
    """Best k keys (score * n + place) per member and slot, and the scores computed.

    Without bands (``low`` None) a member seeks other rows of its label, else rows
    of other labels with a score inside each slot's band.
    """
    n, slots = near.n, 1 if low is None else low.shape[1]
    best = np.full((len(members), slots, k), _NONE, dtype=np.int64)
    lengths = np.linalg.norm(members, axis=1)
    exact = members.astype(near.exact.dtype)
    active = np.arange(len(members))
    at, step, scored = 0, 512, 0
    while at < n and len(active):
        span = order[at:at + step]
        scores = (exact[active] @ near.exact[span].T).astype(np.int64)
        scored += scores.size
        same = own_codes[active][:, None] == codes[span]
        key = scores * n + (n - 1 - span)
        for j in range(slots):
            if low is None:
                fits = same & (own_rows[active][:, None] != near.rows[span])
            else:
                fits = ~same & (scores >= low[active, j][:, None]) & (scores <= high[active, j][:, None])
            met = np.concatenate([best[active, j], np.where(fits, key, _NONE)], axis=1)
            best[active, j] = np.partition(met, met.shape[1] - k, axis=1)[:, -k:]
        at, step = at + step, min(2 * step, 4096)
        if at < n:
            rest = lengths[active] * bound[at]
            rest = rest + 1e-6 * (1 + lengths[active] * bound[0]) if bound[0] > 0 else rest + 1e-6 * (1 + lengths[active] * near.norms.max())
            least = best[active].min(axis=2)
            sure = (least != _NONE) & (np.floor_divide(least, n) > rest[:, None])  # full, and the rest scores less
            if low is not None:
                sure |= (low[active] > rest[:, None]) | (low[active] > high[active])  # the band lies above the rest, or is empty
            active = active[~sure.all(axis=1)]
    return best, scored


def _grid_walk(width: int, centres: np.ndarray, k: int, banded: bool, members_at_once: int = 256):
    def task(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        out = {"anchor": [], "slot": [], "score": [], "id": [], "row": []}
        if anchors.num_rows and candidates.num_rows:
            near = _Candidates(candidates, width)
            both = pa.chunked_array([*anchors["label"].chunks, *near.labels.chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
            own, codes = both[:anchors.num_rows], both[anchors.num_rows:]
            cluster, rows = anchors["cluster"].to_numpy(), anchors["row"].to_numpy()
            vec = _matrix(anchors["vec"].combine_chunks(), width)
            if banded:
                low, high = (np.array(anchors[c].to_pylist(), dtype=np.int64) for c in ("low", "high"))
            for c in np.unique(cluster):
                here = np.flatnonzero(cluster == c)
                cosine = np.clip(_unit(vec[here]) @ centres[c], -1, 1)
                angles = np.where(np.linalg.norm(vec[here], axis=1) == 0, 0, np.arccos(cosine))
                order, bound = near.bounds(centres[c], float(angles.max()))
                for lo in range(0, len(here), members_at_once):
                    m = here[lo:lo + members_at_once]
                    best, _ = _walk(near, codes, order, bound, vec[m], own[m], rows[m], low[m] if banded else None, high[m] if banded else None, k)
                    who, slot, place = np.nonzero(best != _NONE)
                    keys = best[who, slot, place]
                    at = near.n - 1 - keys % near.n
                    out["anchor"].append(rows[m][who])
                    out["slot"].append(slot)
                    out["score"].append(np.floor_divide(keys, near.n))
                    out["id"].append(near.ids.take(pa.array(at)).combine_chunks())
                    out["row"].append(near.rows[at])
        kinds = {"anchor": pa.int64(), "slot": pa.int32(), "score": pa.int64(), "id": pa.int64(), "row": pa.int64()}
        return pa.table({c: pa.chunked_array([pa.array(x, type=kinds[c]) for x in v], type=kinds[c]) for c, v in out.items()})
    return task


def _strips(weights: list[tuple[int, int]], per_strip: int) -> tuple[pd.DataFrame, int]:
    """(cluster, splits, first piece) and the strips: clusters in order, one over ``per_strip`` split over several."""
    rows, strip, filled = [], 0, 0
    for cluster, n in weights:
        splits = -(-n // per_strip)
        if splits > 1 or filled + n > per_strip:
            strip, filled = strip + (filled > 0), 0
        rows.append((cluster, splits, strip))
        if splits > 1:
            strip += splits
        else:
            filled += n
    return pd.DataFrame(rows, columns=["cluster", "splits", "strip"]), strip + (filled > 0)


def hard_negatives(vectors: DataFrame, anchor: str, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", positives: int = 5, negatives: int = 5,
                   low: int = 80, high: int = 100, scale: float = 256.0, sample: int = 4096, strip_bytes: int = 32 << 20, least_strip: int = 1000) -> DataFrame:
    """Per anchor and positive, the highest scoring rows of other labels inside the positive's score band.

    ``anchor`` is a SQL predicate on ``id`` (and ``label``).  Positives are the
    best ``positives`` other rows of the anchor's label; negatives satisfy
    low * positive_score <= 100 * negative_score <= high * positive_score.
    Returns anchor_id, positive_id, positive_rank, rank, negative_id,
    positive_score, negative_score, label (the anchor's).  The clustering is
    fitted on at most ``sample`` anchors (it only steers the order of the walk,
    every row is searched); ``strip_bytes`` bounds the vectors of a task's strip.
    """
    spark = vectors.sparkSession
    own = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{label_column}`").cast("string").alias("label"), F.col(f"`{vector_column}`").alias("vec"))
    rows = cut(quantised(own, scale)).withColumn("row", F.monotonically_increasing_id())
    n, width, total = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("vec")) / 4, F.sum(F.octet_length("vec"))).first()
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long, positive_score long, negative_score long, label string")
    width = int(width or 0)
    anchors = rows.where(anchor)
    held = anchors.count()
    if not held or not width:
        return empty
    taken = anchors.orderBy(F.xxhash64("row"), "row").limit(sample).select("vec").toArrow()["vec"].combine_chunks()
    centres = fit_centres(_matrix(taken, width), min(256, len(taken), max(1, round(held ** 0.5))))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = (_matrix(batch.column("vec"), width) @ centres.T).argmax(axis=1) if batch.num_rows else np.zeros(0)
            yield batch.append_column("cluster", pa.array(near.astype(np.int32)))

    anchors = cut(anchors.mapInArrow(nearest, "id long, label string, vec binary, row long, cluster int"))
    per_strip = max(1, strip_bytes // (4 * width))
    counts = sorted((r.cluster, r.n) for r in anchors.groupBy("cluster").agg(F.count(F.lit(1)).alias("n")).collect())  # at most 256 rows
    plan, anchor_strips = _strips(counts, per_strip)
    strips = max(partitions_for(total, strip_bytes), min(spark.sparkContext.defaultParallelism, -(-n // least_strip)))
    placed = anchors.join(F.broadcast(spark.createDataFrame(plan)), "cluster").withColumn("a", (F.col("strip") + F.pmod(F.xxhash64("row"), F.col("splits"))).cast("int"))
    dealt = rows.select("id", "label", "vec", "row", F.pmod(F.xxhash64("row", F.lit(7)), F.lit(strips)).cast("int").alias("c"), F.explode(F.sequence(F.lit(0), F.lit(anchor_strips - 1))).alias("a"))

    def search(seekers: DataFrame, k: int, banded: bool) -> DataFrame:
        sent = seekers.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
        found = sent.groupBy("a", "c").cogroup(dealt.groupBy("a", "c")).applyInArrow(_grid_walk(width, centres, k, banded), _FOUND)
        best = Window.partitionBy("anchor", "slot").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    seekers = placed.select("a", "cluster", "row", "label", "vec")
    near = cut(search(seekers, positives, False).select(F.col("anchor").alias("row"), (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")))
    in_order = F.array_sort(F.collect_list(F.struct("slot", "positive_score")))  # at most `positives` entries
    bands = near.groupBy("row").agg(in_order.alias("p"))
    pad = lambda c, empty: F.expr(f"transform(sequence(0, {positives - 1}), i -> coalesce(get(transform(p, q -> {c}), i), {empty}))").alias
    bands = bands.select("row", pad(f"CAST(ceil(CAST({low} AS DECIMAL(38, 0)) * q.positive_score / 100) AS LONG)", "1L")("low"),
                         pad(f"CAST(floor(CAST({high} AS DECIMAL(38, 0)) * q.positive_score / 100) AS LONG)", "0L")("high"))
    mined = search(seekers.join(bands, "row"), negatives, True).select(F.col("anchor").alias("row"), "slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = near.join(placed.select("row", F.col("id").alias("anchor_id"), "label"), "row")
    return named.join(mined, ["row", "slot"]).select("anchor_id", "positive_id", (F.col("slot") + 1).cast("int").alias("positive_rank"), F.col("rank").cast("int").alias("rank"),
                                                     "negative_id", "positive_score", "negative_score", "label")
