"""Substring dedup over prefix-partitioned suffix trees.

Method.  Repeats of ``window`` words are the internal nodes at depth >= ``window`` of
the suffix tree of all documents.  The tree is built in pieces: suffixes are
split by prefix into groups that fit in memory.  A prefix is one symbol (``symbol``
words) unless too many suffixes share it, then it is as many symbols longer as its
count asks for.  In a group the suffixes are sorted and neighbours' common prefixes
give the subtree; a node at depth ``window`` or more is a repeated passage, and its
occurrence in the smallest document (earliest start) stays.

Only suffixes that can reach such a node enter a tree: those whose anchor
(``anchors``) also occurs elsewhere.  Equal windows of one part enter once, by their
earliest occurrence, so a passage held by a third of all documents gives one suffix
a part.  A suffix is carried as its next five 32-bit symbols (160 bits).

Passes: count first symbols (map-only); ask for anchors; send suffixes; remove words.  The last
three read the documents in parts of bounded bytes; the parts are one shuffle, reused.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm import anchors as an
from vela.llm import textbytes as tb

_BITS = 12
_CLASSES = 1 << _BITS


class _Words:
    """Word hashes of a part, its candidate windows and the distinct ones among them."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        tb.release()
        self.table, self.ids = an.ordered(table)
        hashes, offs, base = [], [np.zeros(1, dtype=np.int64)], 0
        keys, first, count = [], [], []
        for _, _, data, o in an.byte_blocks(self.table):
            starts, ends, wo = tb.word_spans(data, o, tb.NONSPACE)
            h = tb.word_hashes(data, starts, ends, lower=False)
            k, f, c = an.anchor_runs(tb.prefix_sums(h), wo, window, gram)
            hashes.append(h)
            offs.append(wo[1:] + base)
            keys.append(k)
            first.append(f + base)
            count.append(c)
            base += len(h)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
        self.offsets = np.concatenate(offs)
        self.keys = np.concatenate(keys) if keys else np.zeros(0, dtype=np.uint64)
        self.first = np.concatenate(first) if first else np.zeros(0, dtype=np.int64)
        self.count = np.concatenate(count) if count else np.zeros(0, dtype=np.int64)
        self.window = window

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def candidates(self, elsewhere: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(window starts, code of the distinct window, earliest start of each code, code asks other parts)."""
        outside = an.member(self.keys, elsewhere)
        code, _ = pd.factorize(self.keys)
        run = outside | (np.bincount(code, minlength=1)[code] > 1) if len(code) else outside
        at = an.expand(self.first[run], self.count[run])
        out = np.repeat(outside[run], self.count[run])
        code, distinct = pd.factorize(tb.window_hashes(self.hashes, self.window)[at])
        earliest = np.full(len(distinct), -1, dtype=np.int64)
        earliest[code[::-1]] = at[::-1]
        asks = np.zeros(len(distinct), dtype=bool)
        asks[code] = out
        return at, code, earliest, asks

    def symbols(self, at: np.ndarray, symbol: int) -> np.ndarray:
        grams = (tb.window_hashes(self.hashes, symbol) >> np.uint64(32)).astype(np.uint32)
        return np.stack([grams[at + j] for j in range(0, self.window, symbol)], axis=1) if len(at) else np.zeros((0, self.window // symbol), dtype=np.uint32)


def _buckets(symbols: np.ndarray, levels: np.ndarray, buckets: int) -> np.ndarray:
    """Group of each suffix: the hash of its prefix, whose length its first symbol decides."""
    length = levels[symbols[:, 0] >> np.uint32(32 - _BITS)]
    h = np.zeros(len(symbols), dtype=np.uint64)
    for j in range(symbols.shape[1]):
        h = np.where(length >= j, tb.mix(h + symbols[:, j].astype(np.uint64) + np.uint64(1)), h)
    return (((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _ask(window: int, gram: int, buckets: int):
    def run(key, table):
        return an.key_pieces(key[0].as_py(), _Words(table, window, gram).keys, buckets)
    return run


def _class_counts(window: int, symbol: int):
    """Windows of a batch by class of their first symbol."""
    def run(batches):
        for batch in batches:
            n = np.zeros(_CLASSES, dtype=np.int64)
            for _, _, data, o in an.byte_blocks(batch):
                starts, ends, wo = tb.word_spans(data, o, tb.NONSPACE)
                grams = tb.window_hashes(tb.word_hashes(data, starts, ends, lower=False), symbol)
                n += np.bincount((grams[tb.inside_windows(wo, window)] >> np.uint64(64 - _BITS)).astype(np.int64), minlength=_CLASSES)
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array(some, pa.int64()), pa.array(n[some], pa.int64())], names=["class", "n"])
    return run


def _send(window: int, gram: int, symbol: int, buckets: int, levels_bc):
    def run(key, docs, answers):
        part, rows = key[0].as_py(), []
        if docs.num_rows and answers.num_rows:
            words = _Words(docs, window, gram)
            _, _, earliest, asks = words.candidates(an.told(words.keys, buckets, answers)[0])
            at = np.sort(earliest[asks])
            symbols = words.symbols(at, symbol)
            bucket = _buckets(symbols, levels_bc.value, buckets)
            by = np.argsort(bucket, kind="stable")
            ids = words.ids[words.doc_of(at)]
            bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                own = by[bounds[b]:bounds[b + 1]]
                doc = ids[own]
                new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                rows.append((b, symbols[own].tobytes(), doc[new].tobytes(), np.diff(np.r_[new, len(doc)]).astype(np.int32).tobytes()))
        return pa.table({"part": pa.array([part] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()),
                         **{n: pa.array([r[i + 1] for r in rows], pa.binary()) for i, n in enumerate(("symbols", "docs", "runs"))}})
    return run


def subtree(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the suffixes, common prefix in symbols of each with the one before)."""
    order = np.lexsort(symbols.T[::-1])
    s = symbols[order]
    same = np.ones(len(s) - 1, dtype=bool)
    lcp = np.zeros(len(s), dtype=np.int64)
    for j in range(symbols.shape[1]):
        same &= s[1:, j] == s[:-1, j]
        lcp[1:] += same
    return order, lcp


def internal_nodes(lcp: np.ndarray, depth: int) -> np.ndarray:
    """First leaf of each interval of leaves that share ``depth`` symbols (a single leaf is its own)."""
    return np.flatnonzero(lcp < depth)


def _resolve(width: int):
    def run(table):
        tb.release()
        symbols = np.concatenate([np.frombuffer(b, dtype=np.uint32) for b in table.column("symbols").to_pylist()]).reshape(-1, width)
        docs, sizes = [], []
        for d, r in zip(table.column("docs").to_pylist(), table.column("runs").to_pylist()):
            docs.append(np.repeat(np.frombuffer(d, dtype=np.int64), np.frombuffer(r, dtype=np.int32)))
            sizes.append(len(docs[-1]))
        doc = np.concatenate(docs)
        order, lcp = subtree(symbols)
        nodes = internal_nodes(lcp, width)
        lowest = np.repeat(np.minimum.reduceat(doc[order], nodes), np.diff(np.r_[nodes, len(doc)]))
        seen = np.zeros(len(doc), dtype=bool)
        seen[order] = doc[order] != lowest
        at = np.r_[0, np.cumsum(sizes)]
        keep = [i for i in range(len(sizes)) if seen[at[i]:at[i + 1]].any()]
        return pa.table({"part": table.column("part").take(pa.array(keep, pa.int64())), "bucket": table.column("bucket").take(pa.array(keep, pa.int64())),
                         "blob": pa.array([np.packbits(seen[at[i]:at[i + 1]]).tobytes() for i in keep], pa.binary())})
    return run


def kept_words(text: str, removed: np.ndarray | None) -> str:
    """The words that stay, joined by one space."""
    tokens = text.encode().split()
    if removed is not None:
        tokens = [w for w, r in zip(tokens, removed.tolist()) if not r]
    return b" ".join(tokens).decode()


def without_words(text: str, removed: np.ndarray | None) -> str:
    """The text with each run of removed words cut out, along with the white space before it; every other byte as it was.

    Where words on both sides stay, the white space after the run keeps them apart.
    """
    if removed is None:
        return text
    raw = text.encode()
    data = np.frombuffer(raw, dtype=np.uint8)
    starts, ends, _ = tb.word_spans(data, np.array([0, len(data)]), tb.NONSPACE)
    edges = np.diff(np.r_[0, removed.astype(np.int8), 0])
    first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1
    out, at = [], 0
    for a, b in zip(first.tolist(), last.tolist()):
        out.append(raw[at:ends[a - 1] if a else 0])
        at = ends[b] if a else starts[b + 1] if b + 1 < len(starts) else len(raw)  # nothing before the run: what follows it begins the text
    out.append(raw[at:])
    return b"".join(out).decode()


def _remove(window: int, gram: int, symbol: int, buckets: int, levels_bc, layout: bool):
    def run(docs, answers):
        if not docs.num_rows:
            return pa.table({"id": docs.column("id"), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.string()), "rest": docs.column("rest")})
        words = _Words(docs, window, gram)
        at, code, earliest, asks = words.candidates(an.told(words.keys, buckets, answers)[0])
        seen = np.zeros(len(earliest), dtype=bool)  # a smaller document of another part holds it
        asking = np.flatnonzero(asks)
        asking = asking[np.argsort(earliest[asking], kind="stable")]
        bucket = _buckets(words.symbols(earliest[asking], symbol), levels_bc.value, buckets) if len(asking) else asking
        by = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[by], np.arange(buckets + 1))
        for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("blob").to_pylist()):
            if b < 0:
                continue
            own = asking[by[bounds[b]:bounds[b + 1]]]
            seen[own] = np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=len(own)).astype(bool)
        gone = at[(at != earliest[code]) | seen[code]]
        n = len(words.hashes)
        delta = np.bincount(gone, minlength=n + 1)[:n + 1] - np.bincount(gone + window, minlength=n + 1)[:n + 1]
        removed = np.cumsum(delta)[:n] > 0
        o = words.offsets
        total = np.r_[0, np.cumsum(removed)]
        n_removed = total[o[1:]] - total[o[:-1]]
        kept = []
        for i, text in enumerate(words.table.column("text").to_pylist()):
            gone_here = removed[o[i]:o[i + 1]] if n_removed[i] else None
            kept.append(without_words(text or "", gone_here) if layout else kept_words(text or "", gone_here))
        return pa.table({"id": words.table.column("id"), "n_words": pa.array(np.diff(o), pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
                         "kept": pa.array(kept, pa.string()), "rest": words.table.column("rest")})
    return run


def dedup_substrings(docs: DataFrame, window: int = 20, gram: int = 5, symbol: int = 4, part_bytes: int = 6 << 20, group_suffixes: int = 1_000_000,
                     id_col: str = "doc_id", text_col: str = "text", layout: bool = False) -> DataFrame:
    """id, n_words, n_removed, kept (the kept words joined by one space) and rest (the other columns).

    With ``layout`` kept is the text with the removed passages cut out by offset: line
    breaks, tabs and blank lines of the rest stay, and a text that loses nothing is unchanged.

    Words are runs of anything but ASCII white space.  A word goes if a window of
    ``window`` words covers it whose words also start earlier: in a smaller integer
    id, or earlier in the same document.  Null, empty or short texts lose nothing
    (null: no words).  Rows that share an id count as one document, in the order of
    their texts, though no window crosses rows.  An empty table gives an empty table.
    """
    if window % symbol or gram > window:
        raise ValueError("window must be a multiple of symbol and at least gram")
    spark = docs.sparkSession
    rows, parts = an.in_parts(docs, id_col, text_col, part_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    rest = rows.schema["rest"].dataType.simpleString()
    # at most 4,096 classes of first symbols, whatever the input
    counts = rows.select("text").mapInArrow(_class_counts(window, symbol), "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).where(F.col("n") > group_suffixes).collect()
    levels = np.zeros(_CLASSES, dtype=np.int8)
    for r in counts:
        levels[r["class"]] = min(window // symbol - 1, 1 + int(np.log2(r.n / group_suffixes) / 3))
    levels_bc = spark.sparkContext.broadcast(levels)
    asks = rows.groupBy("part").applyInArrow(_ask(window, gram, parts), an.KEYS)
    answers = an.shared_keys(asks, group_suffixes)
    sent = rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_send(window, gram, symbol, parts, levels_bc), "part long, bucket long, symbols binary, docs binary, runs binary")
    flags = sent.groupBy("bucket").applyInArrow(_resolve(window // symbol), an.KEYS)
    out = rows.groupBy("part").cogroup(answers.unionByName(flags).groupBy("part")) \
        .applyInArrow(_remove(window, gram, symbol, parts, levels_bc, layout), f"id {kind}, n_words long, n_removed long, kept string, rest {rest}")
    return out.withColumnRenamed("id", id_col)
