"""N-gram Jaccard join with Bayesian candidate pruning.

Method.  A document is the set of its ``k``-word shingles (64-bit hashes; a text
of fewer words is one shingle).  Documents with equal sets are one node.  MinHash
values in bands of ``rows`` find candidates: nodes that share a band key are
linked to the bucket's smallest node only (a star, never all pairs of the bucket),
and the components of those stars are the candidate clusters.  With 21 bands of 3
a pair at similarity 0.8 misses every bucket with probability 3e-7.  Inside a
cluster all pairs compare their MinHash values eight at a time; a pair goes
as soon as the posterior probability (uniform prior, binomial likelihood) that
its similarity reaches the threshold falls below ``tolerance``.  Survivors are
verified exactly on their shingle sets.

Scale.  A cluster is cut into chunks of bounded weight, and each pair of chunks is
one unit of work, so no task holds a whole cluster; what leaves a unit is one
row per document (its links and a spanning star), never the pairs.  Equal
documents are aggregated map-side before anything else.
"""
from __future__ import annotations

from fractions import Fraction
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vela.llm import textbytes as tb
from vela.llm.common import cut, hinted, only
from vela.llm.components import components

BANDS, ROWS = 21, 3
HASHES = BANDS * ROWS
_MULT = tb.mix(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_XOR = tb.mix(np.arange(1001, HASHES + 1001, dtype=np.uint64))
_STEP = 8


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes, offsets per document)."""
    starts, ends, wo = tb.word_spans(data, offsets, tb.ALNUM[tb.LOWER])
    words = tb.word_hashes(data, starts, ends, lower=True)
    grams = tb.window_hashes(words, k)
    out, sizes = [], np.zeros(len(offsets) - 1, dtype=np.int64)
    for i in range(len(sizes)):
        a, b = int(wo[i]), int(wo[i + 1])
        if b - a >= k:
            s = np.sort(grams[a:b - k + 1])
            s = s[np.r_[True, s[1:] != s[:-1]]]
        elif b > a:
            s = tb.window_hashes(words[a:b], b - a)
        else:
            continue
        out.append(s)
        sizes[i] = len(s)
    return (np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)), np.r_[0, np.cumsum(sizes)]


def node_names(sets: np.ndarray, offs: np.ndarray) -> list[str | None]:
    """128-bit name of each set; None for an empty one."""
    full = np.flatnonzero(np.diff(offs))
    names: list[str | None] = [None] * (len(offs) - 1)
    if len(full):
        hi = np.add.reduceat(tb.mix(sets ^ np.uint64(0x5851F42D4C957F2D)), offs[full])
        lo = np.add.reduceat(tb.mix(sets + np.uint64(0x14057B7EF767814F)), offs[full])
        for i, a, b in zip(full.tolist(), hi.tolist(), lo.tolist()):
            names[i] = f"{a:016x}{b:016x}"
    return names


def signatures(sets: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """MinHash values (uint32) of the non-empty sets, one row each."""
    at = offs[:-1][np.diff(offs) > 0]
    out = np.empty((len(at), HASHES), dtype=np.uint32)
    for h in range(HASHES if len(at) else 0):
        out[:, h] = (np.minimum.reduceat((sets ^ _XOR[h]) * _MULT[h], at) >> np.uint64(32)).astype(np.uint32)
    return out


def _sets(k: int):
    def run(batches):
        for batch in batches:
            data, offs = tb.buffers(batch.column("text"))
            names, sizes, sigs = [], [], []
            for lo, hi in tb.blocks(offs):
                sets, so = shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                sig = iter(signatures(sets, so))
                for name, n in zip(node_names(sets, so), np.diff(so).tolist()):
                    names.append(name)
                    sizes.append(n)
                    sigs.append(next(sig).tobytes() if n else None)
            yield pa.record_batch([batch.column("id"), pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary())], names=["id", "node", "n", "sig"])
            tb.release()
    return run


def with_set_name(docs: DataFrame, name: str, k: int = 5, text_col: str = "text") -> DataFrame:
    """Adds the name of the text's shingle set (null without a word)."""
    def run(batches):
        for batch in batches:
            data, offs = tb.buffers(batch.column(text_col))
            names = []
            for lo, hi in tb.blocks(offs):
                names += node_names(*shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k))
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string())], names=[*batch.schema.names, name])
            tb.release()
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, StringType())]))


def _member_sets(k: int):
    """Shingles of the representatives' texts; rows of another text under the same id go."""
    def run(batches):
        for batch in batches:
            data, offs = tb.buffers(batch.column("text"))
            want = batch.column("node").to_pylist()
            keep, blobs = [], []
            for lo, hi in tb.blocks(offs):
                sets, so = shingle_sets(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], k)
                for i, name in enumerate(node_names(sets, so)):
                    if name is not None and name == want[lo + i]:
                        keep.append(lo + i)
                        blobs.append(sets[so[i]:so[i + 1]].tobytes())
            rest = batch.drop_columns(["text"]).take(pa.array(keep, pa.int64()))
            yield pa.record_batch([*rest.columns, pa.array(blobs, pa.binary())], names=[*rest.schema.names, "grams"])
            tb.release()
    return run


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """For n compared values, the fewest matches at which a pair is kept.

    P(similarity >= t | m of n match) with a uniform prior is P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in [*range(_STEP, HASHES, _STEP), HASHES]:
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def bayes_survivors(a: np.ndarray, b: np.ndarray, same: bool, least: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i of a, j of b) whose posterior stays above the tolerance to the end."""
    stops = sorted(least)
    match = np.zeros((len(a), len(b)), dtype=np.uint8)
    for h in range(stops[0]):
        match += a[:, h, None] == b[None, :, h]
    ok = match >= least[stops[0]]
    if same:
        ok = np.triu(ok, 1)
    i, j = np.nonzero(ok)
    got, before = match[i, j].astype(np.int32), stops[0]
    for n in stops[1:]:
        got += (a[i, before:n] == b[j, before:n]).sum(axis=1)
        keep = got >= least[n]
        i, j, got, before = i[keep], j[keep], got[keep], n
    return i, j


def overlaps(left: list[np.ndarray], right: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Exact |left[i] & right[j]| for the listed pairs."""
    if len(i) <= 48:
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(i, j)], dtype=np.int64)
    ui, i = np.unique(i, return_inverse=True)
    uj, j = np.unique(j, return_inverse=True)
    left, right = [left[x] for x in ui], [right[y] for y in uj]
    every, code = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    by = np.argsort(code, kind="stable")
    code, rows = code[by], rows[by]
    total, block = np.zeros((len(left), len(right)), dtype=np.float32), 16384
    for c in range(0, len(every), block):
        lo, hi = np.searchsorted(code, [c, c + block])
        m = np.zeros((len(left) + len(right), min(block, len(every) - c)), dtype=np.float32)
        m[rows[lo:hi], code[lo:hi] - c] = 1
        total += m[:len(left)] @ m[len(left):].T
    return total[i, j].astype(np.int64)


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each vertex's component over the pairs."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        after = root.copy()
        np.minimum.at(after, i, low)
        np.minimum.at(after, j, low)
        np.minimum.at(after, root[i], low)
        np.minimum.at(after, root[j], low)
        after = after[after]
        if np.array_equal(after, root):
            break
        root = after
    return root


def _verify(threshold: float, least: dict[int, int]):
    t = Fraction(threshold).limit_denominator(10_000)

    def unit(rows: list[tuple]) -> list[tuple[str, str, int]]:
        """rows: (side, node, copies, sig, grams); side 0, 1 or 2 (both)."""
        seen, kept = set(), []
        for r in sorted(rows, key=lambda r: r[1]):
            if r[1] not in seen:
                seen.add(r[1])
                kept.append(r)
        sides = np.array([r[0] for r in kept])
        sig = np.array([np.frombuffer(r[3], dtype=np.uint32) for r in kept])
        sets = [np.frombuffer(r[4], dtype=np.uint64) for r in kept]
        a, b = (np.arange(len(kept)),) * 2 if (sides == 2).any() else (np.flatnonzero(sides == 0), np.flatnonzero(sides == 1))
        links = np.zeros(len(kept), dtype=np.int64)
        root = np.arange(len(kept))
        if len(a) and len(b):
            i, j = bayes_survivors(sig[a], sig[b], bool((sides == 2).any()), least)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            ni, nj = sizes[a[i]], sizes[b[j]]
            near = np.minimum(ni, nj) * t.denominator >= np.maximum(ni, nj) * t.numerator
            i, j, ni, nj = i[near], j[near], ni[near], nj[near]
            both = overlaps([sets[x] for x in a], [sets[x] for x in b], i, j)
            linked = both * t.denominator >= (ni + nj - both) * t.numerator
            i, j = a[i[linked]], b[j[linked]]
            copies = np.array([r[2] for r in kept], dtype=np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            root = _roots(len(kept), i, j)
        return [(kept[x][1], kept[r][1], int(n)) for x, (r, n) in enumerate(zip(root.tolist(), links.tolist()))]

    def run(batches):
        key, rows = None, []

        def flush():
            out = unit(rows) if rows else []
            return pa.record_batch([pa.array([x[c] for x in out], k) for c, k in enumerate((pa.string(), pa.string(), pa.int64()))], names=["node", "root", "links"])

        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("unit", "side", "node", "copies", "sig", "grams")]
            for u, *row in zip(*cols):
                if u != key:
                    if rows:
                        yield flush()
                    key, rows = u, []
                rows.append(tuple(row))
        if rows:
            yield flush()
    return run


def ngram_join(docs: DataFrame, threshold: float = 0.8, k: int = 5, tolerance: float = 1e-6, chunk_grams: int = 400_000,
               chunk_docs: int = 512, id_col: str = "doc_id", text_col: str = "text", firsts: bool = False) -> DataFrame:
    """One row per document row: id, class_id, n_links, copies, n_shingles.

    Words are lower-cased runs of digits, letters a-z and non-ASCII characters.
    ``class_id`` is the smallest id of the document's component of links (Jaccard
    of shingle sets >= threshold); ``n_links`` counts the other documents it links
    to, equal ones included; ``copies`` the documents with the same set.  A
    null, empty or wordless text links to nothing and is its own class.  Repeated
    rows count as copies.  Extra columns are left out.  A null id counts as larger than
    any other.  With ``firsts`` there are also node (the name of the text's set, null without a word)
    and first: does the row hold the smallest id, then node, of its class?
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    work = only(docs, id=id_col, text=text_col)
    sets = cut(work.mapInArrow(_sets(k), f"id {kind}, node string, n long, sig binary"))
    nodes = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    nodes = cut(nodes)
    width = 4 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring(F.col("sig"), b * width + 1, F.lit(width))))
    buckets = nodes.select("node", F.explode(keys).alias("key"))
    leads = buckets.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("key", "lead")
    stars = buckets.join(leads, "key").where("node <> lead").select(F.col("node").alias("a"), F.col("lead").alias("b"))
    clusters = components(stars)
    members = cut(clusters.join(nodes, "node").select("node", F.col("root").alias("cluster"), "rep", "copies", "n", "sig"))
    weight = members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / chunk_grams), F.ceil(F.count(F.lit(1)) / chunk_docs)).cast("int").alias("chunks"))
    placed = members.join(weight, "cluster").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
    some = work.join(hinted(members.select(F.col("rep").alias("id"))), "id", "left_semi")  # only members' texts are shuffled
    loaded = some.join(placed.hint("shuffle_hash"), F.col("id") == F.col("rep")).select("text", "node", "cluster", "copies", "sig", "chunks", "chunk") \
        .mapInArrow(_member_sets(k), "node string, cluster string, copies long, sig binary, chunks int, chunk int, grams binary")
    # sets that stand under null ids only are found by their names, a text each
    nameless = with_set_name(work.where("id IS NULL").select("text"), "node", k).where("node IS NOT NULL").groupBy("node").agg(F.first("text").alias("text"))
    loaded = loaded.unionByName(nameless.join(placed.where("rep IS NULL"), "node").select("text", "node", "cluster", "copies", "sig", "chunks", "chunk")
                                .mapInArrow(_member_sets(k), loaded.schema))
    units = loaded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .select(F.concat_ws("/", "cluster", F.least("chunk", "other"), F.greatest("chunk", "other")).alias("unit"),
                F.when(F.col("chunk") == F.col("other"), 2).when(F.col("chunk") < F.col("other"), 0).otherwise(1).alias("side"), "node", "copies", "sig", "grams")
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    checked = cut(units.repartition(parts, "unit").sortWithinPartitions("unit")
                  .mapInArrow(_verify(threshold, least_matches(threshold, tolerance)), "node string, root string, links long"))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = nodes.select("node", "rep", "copies").join(roots, "node", "left").join(links, "node", "left") \
        .select("node", "rep", "copies", F.coalesce("root", "node").alias("root"), F.coalesce("links", F.lit(0)).alias("links"))
    lowest = named.groupBy("root").agg(F.min("rep").alias("class_id"), F.min(F.struct(F.col("rep").isNull(), "rep", "node"))["node"].alias("low"))
    named = named.join(lowest, "root").select("node", "copies", "links", "class_id", F.when(F.col("node") == F.col("low"), F.struct("rep")).alias("keeps"))
    more = [F.col("node"), (F.col("keeps").isNotNull() & F.col("id").eqNullSafe(F.col("keeps.rep"))).alias("first")] if firsts else []
    linked = sets.where("node IS NOT NULL").select("id", "node", "n").join(named, "node") \
        .select("id", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "copies", F.col("n").alias("n_shingles"), *more)
    more = [F.lit(None).cast("string").alias("node"), F.lit(True).alias("first")] if firsts else []
    alone = sets.where("node IS NULL").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("copies"), F.lit(0).cast("long").alias("n_shingles"), *more)
    return linked.unionByName(alone).withColumnRenamed("id", id_col)
