"""Target-distribution importance resampling: documents drawn by how much their n-grams look like the target's.

Texts are lower-cased, runs of separators collapse to one space, and an
overlapped regex scan whose lookbehind holds it to word starts emits at every
word the spans of its one-, two- and three-word runs; their CRC-32 picks the
bucket.  A document's buckets are kept once (sorted, one byte a gap) in the
shared folder, then counted over the whole table, turned into gains against the
target's counts and summed per document.  A Gumbel key seeded by the document
id makes the highest scores a draw without replacement.  Ranks come from bucket
offsets, never from one sorted task; rows alike in id and score are counted
first, so a repeated row cannot make a hot bucket.

Defined results: null text has no words (weight 0, no rank); a null id is
hashed as the empty text and ranks last among ties; repeated rows are rows of
their own and take neighbouring ranks.  Empty tables give no rows; an empty
target gives gains against a count of zero.  Ids of any orderable type.
"""
from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain
from operator import methodcaller
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vela.llm.common import cut, only
from vela.llm.textbytes import buffers, release
from vela.operators.patterns import balanced_buckets, join_small

_SEPARATORS = re.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
#: At a word start: group 1 holds up to three words, group 2 up to two, group 3 one.
_RUNS = regex.compile(rb"(?<![^ ])((([^ ]++)(?: [^ ]++)?+)(?: [^ ]++)?+)")
_GROUPS = methodcaller("group", 3, 2, 1)


def ngram_buckets(text: bytes, n_buckets: int) -> tuple[int, np.ndarray]:
    """(words, bucket of every run of one to three words) of a whole text."""
    plain = _SEPARATORS.sub(b" ", text.translate(_LOWER)).strip(b" ")
    if not plain:
        return 0, np.zeros(0, dtype=np.int64)
    found = np.fromiter(map(crc32, chain.from_iterable(map(_GROUPS, _RUNS.finditer(plain, overlapped=True)))), dtype=np.uint32)
    words = len(found) // 3
    runs = found.reshape(words, 3)
    # the last word starts no run of two, the last two none of three
    return words, np.concatenate([runs[:max(0, words - n), n] for n in range(3)]).astype(np.int64) % n_buckets


def pack(buckets: np.ndarray) -> bytes:
    """Sorted buckets as one byte a gap; 255 adds 255 and stands for no bucket."""
    gaps = np.diff(np.sort(buckets), prepend=0)
    steps = gaps // 255
    out = np.full(len(gaps) + int(steps.sum()), 255, dtype=np.uint8)
    out[np.cumsum(steps + 1) - 1] = gaps % 255
    return out.tobytes()


def unpack(data: np.ndarray) -> np.ndarray:
    return np.cumsum(data, dtype=np.int64)[data != 255]


def ngram_features(texts: DataFrame, n_buckets: int) -> DataFrame:
    """id, n_words, n_features and packed buckets of every row of (id, text)."""
    kind = texts.schema["id"].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            words, counts, packed = [], [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                n, found = ngram_buckets(data[a:b].tobytes(), n_buckets)
                words.append(n)
                counts.append(len(found))
                packed.append(pack(found))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(words, pa.int64()), pa.array(counts, pa.int64()), pa.array(packed, pa.binary())],
                                             names=["id", "n_words", "n_features", "packed"])
            release()

    return texts.select("id", "text").mapInArrow(scan, f"id {kind}, n_words long, n_features long, packed binary")


def bucket_counts(features: DataFrame, n_buckets: int) -> np.ndarray:
    """Features per bucket over the whole table: a partial count per task, summed by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, dtype=np.int64)
        for batch in batches:
            data, offsets = buffers(batch.column("packed"))
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                total += np.bincount(unpack(data[a:b]), minlength=n_buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(total[held])], names=["bucket", "n"])

    out = np.zeros(n_buckets, dtype=np.int64)
    for bucket, n in features.select("packed").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        out[bucket] = n  # at most n_buckets rows
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the smoothed ratio) of target to corpus shares, per bucket."""
    b, s, t = len(corpus), corpus.astype(float), target.astype(float)
    ratio = (t + 1) * (s.sum() + b) / ((s + 1) * (t.sum() + b))
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], dtype=np.int64)


def _weights(features: DataFrame, gains: np.ndarray) -> DataFrame:
    kind = features.schema["id"].dataType.simpleString()

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("packed"))
            found = [int(gains[unpack(data[a:b])].sum()) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("n_words"), batch.column("n_features"), pa.array(found, pa.int64())],
                                             names=["id", "n_words", "n_features", "weight"])

    return features.mapInArrow(weigh, f"id {kind}, n_words long, n_features long, weight long")


def _ranked(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """Every row with its place by (score descending, id ascending, null last), from 1."""
    own = rows.columns
    alike = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("__rows")).withColumn("__down", -F.col("score"))
    n = alike.count()
    held = balanced_buckets(alike, "__down", "__bucket", max(64, -(-n // bucket_rows)))
    sizes = held.groupBy("__bucket").agg(F.sum("__rows").alias("__in"))  # at most 4,096 rows
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__in").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__bucket").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), *[F.col(c) for c in own if c not in ("id", "score")]).rowsBetween(Window.unboundedPreceding, 0)
    upto = join_small(held, offsets, on=["__bucket"]).withColumn("__upto", F.col("__before") + F.sum("__rows").over(inside))
    return upto.select(*own, F.explode(F.expr("sequence(__upto - __rows + 1, __upto)")).alias("rank"))


def importance_resample(docs: DataFrame, target: DataFrame, id_column: str = "doc_id", text_column: str = "text", target_text: str = "text", n_buckets: int = 10_000,
                        least_words: int = 20, percent: int = 5, seed: int = 42, bucket_rows: int = 1_000_000) -> DataFrame:
    """Draws ``percent`` of the documents of at least ``least_words`` words by the target's n-gram distribution.

    Returns per document: id, n_words, n_features, weight, score, rank (1, 2, ... of
    the drawn ones by falling score, ties to the smaller id; null if not drawn).
    ``bucket_rows`` bounds the rows that one task puts in order.
    """
    features = cut(ngram_features(only(docs, id=id_column, text=text_column), n_buckets))
    wanted = ngram_features(target.select(F.lit(0).alias("id"), F.col(f"`{target_text}`").alias("text")), n_buckets)
    gains = bucket_gains(bucket_counts(features, n_buckets), bucket_counts(wanted, n_buckets))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    uniform = (F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)
    scored = cut(_weights(features, gains).withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log(uniform))).cast("long")))
    long_enough = scored.where(F.col("n_words") >= least_words)
    drawn = percent * long_enough.count() // 100
    ranked = _ranked(long_enough, bucket_rows).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")).cast("long"))
    return ranked.unionByName(scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long")))
