"""Anchors: a sampled position for every window, so that equal windows can meet.

Every window of ``window`` units (bytes or words) is owned by one of its
``gram``-unit grams: the one with the smallest hash, the rightmost on ties.  Equal
windows own equal grams at equal offsets, so a window can only be repeated if its
anchor's gram is.  About 2 in ``window - gram`` positions are anchors.

Plan.  Documents lie in parts (hash of the id, bounded bytes).  A part asks about
each distinct anchor key once, whatever number of its documents hold it, so a key
of a third of all rows costs one entry a part.  Asks meet in buckets by key range;
a bucket answers each part, with a bit for each key, which of them other parts hold too.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm import textbytes as tb
from vela.llm.common import partitions_for, text_bytes

_LOW32 = np.uint64(0xFFFFFFFF)
_HIGH32 = np.uint64(0xFFFFFFFF00000000)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)
KEYS = "part long, bucket long, blob binary"


def sliding_min(values: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of w values, by minima over doubling lengths."""
    have = 1
    while have < w:
        step = min(have, w - have)
        values = np.minimum(values[:-step], values[step:])
        have += step
    return values


def anchor_runs(cum: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window start, windows) for each run of windows with the same anchor.

    ``cum`` are the prefix sums of the units (``textbytes.prefix_sums``).
    """
    z = np.zeros(0, dtype=np.int64)
    first_of, last_of = offsets[:-1], offsets[1:] - window
    some = last_of >= first_of
    if not some.any():
        return z.astype(np.uint64), z, z
    n = len(cum) - gram
    _, inv = tb.powers(len(cum))
    packed = cum[gram:] - cum[:n]
    packed *= inv[:n]
    packed *= _SPREAD
    packed &= _HIGH32
    packed |= _LOW32 - np.arange(n, dtype=np.uint64)
    low = sliding_min(packed, window - gram + 1).astype(np.uint32)  # what is left of the position picks the anchor
    cuts = np.unique(np.concatenate([np.flatnonzero(low[1:] != low[:-1]) + 1, first_of[some], last_of[some] + 1]))
    doc = np.searchsorted(offsets, cuts, side="right") - 1
    inside = np.flatnonzero((doc >= 0) & (doc < len(last_of)) & (cuts <= last_of[np.minimum(doc, len(last_of) - 1)]))
    start = cuts[inside]
    at = (_LOW32 - low[start].astype(np.uint64)).astype(np.int64)
    return tb.span_hashes(cum, at, at + gram), start, cuts[inside + 1] - start


def expand(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenated ranges first .. first + count - 1."""
    total = np.cumsum(count)
    return np.arange(int(total[-1]) if len(total) else 0) + np.repeat(first - (total - count), count)


def in_parts(docs: DataFrame, id_col: str, text_col: str, part_bytes: int) -> tuple[DataFrame, int]:
    """id, text, rest (every other column) and part; the number of parts follows the bytes of text."""
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    packed = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.lit(None).cast("struct<none:int>")
    parts = partitions_for(text_bytes(docs, f"`{text_col}`"), part_bytes)
    out = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), packed.alias("rest"))
    return out.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(parts)).cast("long")), parts


def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The rows of a part by id, then text (the same order in every pass), and the ids (null: smallest)."""
    table = table.set_column(table.schema.get_field_index("text"), "text", table.column("text").cast(pa.large_string()))
    by = pa.table({"id": table.column("id").fill_null(-2 ** 63), "text": table.column("text").fill_null("")})
    take = pa.compute.sort_indices(by, sort_keys=[("id", "ascending"), ("text", "ascending")])
    return table.take(take), by.column("id").take(take).to_numpy().astype(np.int64)


def _cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, first key) of each bucket that sorted keys fall into, by key range; the end closes the second."""
    bucket = (((keys >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return bucket[first], np.r_[first, len(keys)]


def key_pieces(part: int, keys: np.ndarray, buckets: int) -> pa.Table:
    """Distinct keys of a part, cut by key range: one row for each bucket that gets any.

    A blob holds the low 40 bits of the keys (the bucket tells the high ones apart) and, in a
    byte each, the logarithm of how often the part has them.
    """
    keys, n = np.unique(keys, return_counts=True)
    log = np.ceil(np.log2(n)).astype(np.uint8)
    low = np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5])
    bucket, at = _cuts(keys, buckets)
    return pa.table({"part": pa.array([part] * len(bucket), pa.int64()), "bucket": pa.array(bucket),
                     "blob": pa.array([low[a:b].tobytes() + log[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], pa.binary())})


def _answer(hot: int):
    def run(table):
        blobs = table.column("blob").to_pylist()
        n = [len(b) // 6 for b in blobs]
        at = np.r_[0, np.cumsum(n)]
        wide = np.zeros((at[-1], 8), dtype=np.uint8)
        log = np.empty(at[-1], dtype=np.uint8)
        for b, i, j in zip(blobs, at[:-1], at[1:]):
            wide[i:j, :5] = np.frombuffer(b, dtype=np.uint8, count=5 * (j - i)).reshape(-1, 5)
            log[i:j] = np.frombuffer(b, dtype=np.uint8, offset=5 * (j - i))
        keys = wide.view(np.uint64).ravel()
        by = np.argsort(keys, kind="stable")
        new = np.flatnonzero(np.r_[True, keys[by][1:] != keys[by][:-1]])
        size = np.diff(np.r_[new, len(by)])
        shared, often = np.empty(len(by), dtype=bool), np.empty(len(by), dtype=bool)
        shared[by] = np.repeat(size > 1, size)
        often[by] = np.repeat(np.add.reduceat(np.exp2(log[by].astype(np.float64)), new) > hot, size)
        some = [i for i in range(len(blobs)) if shared[at[i]:at[i + 1]].any()]
        flags = [np.packbits(shared[at[i]:at[i + 1]]).tobytes() + np.packbits(often[at[i]:at[i + 1]]).tobytes() for i in some]
        return pa.table({"part": table.column("part").take(pa.array(some, pa.int64())), "bucket": pa.array([-1 - table.column("bucket")[i].as_py() for i in some], pa.int64()),
                         "blob": pa.array(flags, pa.binary())})
    return run


def shared_keys(asks: DataFrame, hot: int) -> DataFrame:
    """Answers, a row for each row of asks (bucket b as -1 - b): two bits a key, in the order asked.

    The first tells that another part asks about the key too, the second that about ``hot``
    runs or more have it in all.
    """
    return asks.groupBy("bucket").applyInArrow(_answer(hot), KEYS)


def told(keys: np.ndarray, buckets: int, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of a part that other parts hold too, and whether each is hot."""
    keys = np.unique(keys)
    shared, often = np.zeros(len(keys), dtype=bool), np.zeros(len(keys), dtype=bool)
    bucket, at = _cuts(keys, buckets)
    where = {b: (i, j) for b, i, j in zip(bucket.tolist(), at[:-1].tolist(), at[1:].tolist())}
    for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist()):
        if b < 0:
            i, j = where[-1 - b]
            bits = np.unpackbits(np.frombuffer(blob, dtype=np.uint8)).astype(bool)
            half = len(bits) // 2
            shared[i:j], often[i:j] = bits[:j - i], bits[half:half + j - i]
    return keys[shared], often[shared]


def member(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in the sorted array."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return known[at] == keys


def byte_blocks(table: pa.Table, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, offsets) of the texts of a part, a bounded block at a time."""
    data, offs = tb.buffers(table.column("text"))
    for lo, hi in tb.blocks(offs, limit):
        yield lo, hi, data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
