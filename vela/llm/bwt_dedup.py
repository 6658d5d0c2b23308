"""Suffix-array dedup: shard Burrows-Wheeler transforms merged by interleave refinement.

Method.  Bytes covered by a ``window``-byte string that also starts in a smaller
document are removed.  The alphabet is ``symbol``-byte grams (hashed), so a step of the
last-to-first mapping goes back about ``symbol`` bytes and ``rounds`` refinements see
whole windows (a window is covered by ``rounds`` grams, which may overlap).  A shard sorts its suffixes and keeps, for each level, the
symbol before each suffix in sorted order (its transform).  Merging shards never sorts suffixes
again: the interleave starts as the shards one after another, each refinement reads
the transforms in step with it and deals its entries stably by symbol; an entry that parts from
its neighbour in round r shares r - 1 symbols with it.  After the last round the
runs that never parted are the repeated intervals; their smallest document keeps the bytes.

Only suffixes that can repeat are indexed.  The text around each anchor (``anchors``)
whose key occurs in another document, a context of the window starts that it owns,
goes to the bucket of that key; equal contexts of a part go once.  A key with more
than ``hot`` contexts sends its windows one by one, dealt by their hash, so no bucket
grows with one passage.
"""
from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

from vela.llm import anchors as an
from vela.llm import textbytes as tb


def stable_order(codes: np.ndarray) -> np.ndarray:
    """Stable argsort of 32-bit codes, by two 16-bit radix passes if there are many."""
    if len(codes) < 4096:
        return np.argsort(codes, kind="stable")
    low = np.argsort((codes & np.uint32(0xFFFF)).astype(np.uint16), kind="stable")
    return low[np.argsort((codes >> np.uint32(16)).astype(np.uint16)[low], kind="stable")]


class Shard:
    """Sorted window starts of some contexts, and the transform of each level.

    ``transforms[0]`` holds the last symbol of each window in context order,
    ``transforms[r]`` the symbol before the last r, in the order of those r symbols;
    ``steps[r]`` leads from an entry's place at level r to its place at level r + 1 (the
    last-to-first mapping).  ``places`` are the windows' final places.
    """

    def __init__(self, text: np.ndarray, starts: np.ndarray, window: int, rounds: int):
        symbol = -(-window // rounds)
        codes = (tb.window_hashes(tb.byte_values(text), symbol) >> np.uint64(32)).astype(np.uint32)
        order = starts.astype(np.int32)
        entry = np.arange(len(starts), dtype=np.int32)
        self.transforms, self.steps = [], []
        for back in ((window - symbol) * r // max(1, rounds - 1) for r in range(rounds - 1, -1, -1)):
            here = codes[order + np.int32(back)]
            deal = stable_order(here)
            step = np.empty(len(deal), dtype=np.int32)
            step[deal] = np.arange(len(deal), dtype=np.int32)
            self.transforms.append(here)
            self.steps.append(step)
            order, entry = order[deal], entry[deal]
        self.places = np.empty(len(entry), dtype=np.int32)
        self.places[entry] = np.arange(len(entry), dtype=np.int32)


def merge(shards: list[Shard]) -> tuple[list[np.ndarray], np.ndarray]:
    """For each shard, the run of each of its window starts (equal windows share a run); common prefixes in symbols."""
    sizes = np.array([len(s.places) for s in shards], dtype=np.int64)
    base = np.cumsum(sizes) - sizes
    total, rounds = int(sizes.sum()), len(shards[0].transforms)
    at = np.arange(total, dtype=np.int32)  # the interleave: which entry of which shard comes next
    run = np.zeros(total, dtype=np.int32)
    parted = np.zeros(total, dtype=bool)
    for r in range(rounds):
        transform = np.concatenate([s.transforms[r] for s in shards])
        step = np.concatenate([s.steps[r] + np.int32(b) for s, b in zip(shards, base.tolist())])
        here = transform[at]
        deal = stable_order(here)
        here, at, before = here[deal], step[at[deal]], run[deal]
        np.logical_or(here[1:] != here[:-1], before[1:] != before[:-1], out=parted[1:])
        run = np.cumsum(parted, dtype=np.int32)
    common = np.where(parted, 0, rounds)
    common[:1] = 0
    final = np.empty(total, dtype=np.int32)
    final[at] = run
    return [final[b:b + n][s.places] for s, b, n in zip(shards, base.tolist(), sizes.tolist())], common


def seen_before(texts: list[bytes], counts: list[np.ndarray], docs: list[np.ndarray], window: int, rounds: int) -> list[np.ndarray]:
    """For each shard (contexts one after another, with their window counts and documents): which windows start in a smaller document too."""
    shards, owner = [], []
    for text, count, doc in zip(texts, counts, docs):
        length = count + (window - 1)
        starts = an.expand(np.cumsum(length) - length, count)
        shards.append(Shard(np.frombuffer(text, dtype=np.uint8), starts, window, rounds))
        owner.append(np.repeat(doc, count))
    runs, _ = merge(shards)
    run, doc = np.concatenate(runs), np.concatenate(owner)
    order = stable_order(run.astype(np.uint32))
    lowest = np.minimum.reduceat(doc[order], np.r_[0, np.cumsum(np.bincount(run))[:-1]])
    return np.split(doc > lowest[run], np.cumsum([len(o) for o in owner])[:-1])


class _Bytes:
    """Anchor runs of a part, and the contexts to look up."""

    def __init__(self, table: pa.Table, window: int, gram: int):
        tb.release()
        self.table, self.ids = an.ordered(table)
        self.data, self.offsets = tb.buffers(self.table.column("text"))
        self.window = window
        keys, first, count, ident = [], [], [], []
        for lo, _, data, o in an.byte_blocks(self.table):
            cum = tb.prefix_sums(tb.byte_values(data))
            k, f, c = an.anchor_runs(cum, o, window, gram)
            keys.append(k)
            first.append(f + self.offsets[lo])
            count.append(c)
            ident.append(tb.span_hashes(cum, f, f + c + window - 1))
        cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)
        self.keys, self.ident = cat(keys, np.uint64), cat(ident, np.uint64)
        self.first, self.count = cat(first, np.int64), cat(count, np.int64)

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, at, side="right") - 1

    def contexts(self, shared: np.ndarray, hot: np.ndarray) -> dict[str, np.ndarray]:
        """Contexts that may hold repeats: start, count, ident, deal (by key or by window), outside, id."""
        at = np.minimum(np.searchsorted(shared, self.keys), max(0, len(shared) - 1))
        outside = shared[at] == self.keys if len(shared) else np.zeros(len(self.keys), dtype=bool)
        often = outside & hot[at] if len(shared) else outside
        id_of = self.ids[self.doc_of(self.first)]
        code, distinct = pd.factorize(self.keys)
        some = np.zeros(len(distinct), dtype=np.int64)
        some[code] = id_of
        inside = np.zeros(len(distinct), dtype=bool)
        inside[code[id_of != some[code]]] = True
        run = np.flatnonzero((outside | inside[code]) & ~often) if len(code) else np.zeros(0, dtype=np.int64)
        single = an.expand(self.first[often], self.count[often])
        one = np.zeros(len(single), dtype=np.uint64)
        p, _ = tb.powers(self.window)
        for j in range(self.window):  # the hash of span_hashes, for few positions
            one += tb.byte_values(self.data[single + j]) * p[j]
        one = tb.mix(one)
        start = np.r_[self.first[run], single]
        by = np.argsort(start, kind="stable")
        out = {"start": start, "count": np.r_[self.count[run], np.ones(len(single), dtype=np.int64)], "ident": np.r_[self.ident[run], one],
               "deal": np.r_[self.keys[run], one], "outside": np.r_[outside[run], np.ones(len(single), dtype=bool)]}
        out = {k: v[by] for k, v in out.items()}
        out["id"] = self.ids[self.doc_of(out["start"])]
        return out

    def distinct(self, c: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """(code of each context, first context of each code)."""
        code, distinct = pd.factorize(c["ident"])
        lead = np.full(len(distinct), -1, dtype=np.int64)
        lead[code[::-1]] = np.arange(len(code))[::-1]
        return code, lead

    def text_of(self, start: np.ndarray, count: np.ndarray) -> bytes:
        return self.data[an.expand(start, count + self.window - 1)].tobytes()


def _by_bucket(c: dict[str, np.ndarray], lead: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Leading contexts that other parts must see, in bucket order, and where each bucket starts."""
    asking = lead[c["outside"][lead]]
    bucket = (((c["deal"][asking] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
    by = np.argsort(bucket, kind="stable")
    return asking[by], np.searchsorted(bucket[by], np.arange(buckets + 1))


def _ask(window: int, gram: int, buckets: int):
    def run(key, table):
        return an.key_pieces(key[0].as_py(), _Bytes(table, window, gram).keys, buckets)
    return run


def _send(window: int, gram: int, buckets: int):
    def run(key, docs, answers):
        part, rows = key[0].as_py(), []
        if docs.num_rows and answers.num_rows:
            text = _Bytes(docs, window, gram)
            c = text.contexts(*an.told(text.keys, buckets, answers))
            asking, bounds = _by_bucket(c, text.distinct(c)[1], buckets)
            for b in np.flatnonzero(np.diff(bounds)).tolist():
                own = asking[bounds[b]:bounds[b + 1]]
                doc = c["id"][own]
                new = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
                rows.append((b, text.text_of(c["start"][own], c["count"][own]), c["count"][own].astype(np.uint8).tobytes(),
                             doc[new].tobytes(), np.diff(np.r_[new, len(doc)]).astype(np.int32).tobytes()))
        return pa.table({"part": pa.array([part] * len(rows), pa.int64()), "bucket": pa.array([r[0] for r in rows], pa.int64()),
                         **{n: pa.array([r[i + 1] for r in rows], pa.binary()) for i, n in enumerate(("contexts", "counts", "docs", "runs"))}})
    return run


def _resolve(window: int, rounds: int):
    def run(table):
        tb.release()
        cols = {n: table.column(n).to_pylist() for n in ("contexts", "counts", "docs", "runs")}
        docs = [np.repeat(np.frombuffer(d, dtype=np.int64), np.frombuffer(r, dtype=np.int32)) for d, r in zip(cols["docs"], cols["runs"])]
        seen = seen_before(cols["contexts"], [np.frombuffer(b, dtype=np.uint8).astype(np.int64) for b in cols["counts"]], docs, window, rounds)
        keep = [i for i, s in enumerate(seen) if s.any()]
        return pa.table({"part": table.column("part").take(pa.array(keep, pa.int64())), "bucket": table.column("bucket").take(pa.array(keep, pa.int64())),
                         "blob": pa.array([np.packbits(seen[i]).tobytes() for i in keep], pa.binary())})
    return run


def _remove(window: int, gram: int, rounds: int, buckets: int):
    def run(docs, answers):
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept", "rest"]
        if not docs.num_rows:
            none = pa.array([], pa.int64())
            return pa.table([docs.column("id"), none, none, none, pa.array([], pa.binary()), docs.column("rest")], names=names)
        text = _Bytes(docs, window, gram)
        groups = answers.column("bucket").to_pylist()
        blobs = answers.column("blob").to_pylist()
        c = text.contexts(*an.told(text.keys, buckets, answers))
        code, lead = text.distinct(c)
        width = int(c["count"].max(initial=1))
        seen = np.zeros((len(lead), width), dtype=bool)
        spot = np.full(len(c["start"]), -1, dtype=np.int64)
        spot[lead] = np.arange(len(lead))

        def put(own, flags):
            n = c["count"][own]
            row = np.repeat(spot[own], n)
            seen[row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)] = flags

        asking, bounds = _by_bucket(c, lead, buckets)
        for b, blob in zip(groups, blobs):
            if b >= 0:
                own = asking[bounds[b]:bounds[b + 1]]
                put(own, np.unpackbits(np.frombuffer(blob, dtype=np.uint8), count=int(c["count"][own].sum())).astype(bool))
        own = lead[~c["outside"][lead]]  # repeated in this part alone
        if len(own):
            put(own, seen_before([text.text_of(c["start"][own], c["count"][own])], [c["count"][own]], [c["id"][own]], window, rounds)[0])
        flags = seen[code] | (c["id"] > c["id"][lead[code]])[:, None] if len(code) else seen
        gone = flags & (np.arange(width)[None, :] < c["count"][:, None]) if len(code) else flags
        e, w = np.nonzero(gone)
        at, n, o = c["start"][e] + w, len(text.data), text.offsets
        doc = text.doc_of(at)
        new = np.flatnonzero(np.r_[True, (at[1:] > at[:-1] + window) | (doc[1:] != doc[:-1])]) if len(at) else at
        edge = np.zeros(n + 1, dtype=np.int8)  # runs that touch at a document's end cancel out
        np.add.at(edge, at[new], 1)
        np.add.at(edge, at[np.r_[new[1:], len(at)] - 1] + window if len(at) else at, -1)
        removed = np.cumsum(edge[:n], dtype=np.int8).astype(bool)
        total = np.r_[np.int32(0), np.cumsum(removed, dtype=np.int32)]
        spans = np.bincount(doc[new], minlength=len(o) - 1)
        kept = text.data[~removed].tobytes()
        ko = o - total[o]
        return pa.table([text.table.column("id"), pa.array(np.diff(o)), pa.array(np.diff(total[o]).astype(np.int64)), pa.array(spans.astype(np.int64)),
                         pa.array([kept[a:b] for a, b in zip(ko[:-1].tolist(), ko[1:].tolist())], pa.binary()), text.table.column("rest")], names=names)
    return run


def dedup_bytes(docs: DataFrame, window: int = 50, gram: int = 16, rounds: int = 3, part_bytes: int = 3 << 20, hot: int = 200_000,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_removed, n_spans (maximal removed runs), kept (remaining bytes), rest (the other columns).

    Texts are UTF-8 bytes, matches stay inside a document and are judged on the
    input.  Null and empty texts have no bytes; texts under ``window`` bytes lose
    nothing.  Ids are integers (null: the smallest); rows of one id never remove
    each other's bytes.  An empty table gives an empty table.
    """
    if gram > window or window - gram >= 255:
        raise ValueError("window must be gram to gram + 254")
    rows, parts = an.in_parts(docs, id_col, text_col, part_bytes)
    kind = docs.schema[id_col].dataType.simpleString()
    rest = rows.schema["rest"].dataType.simpleString()
    buckets = parts  # a bucket's sort takes about 50 bytes for each byte of its contexts
    asks = rows.groupBy("part").applyInArrow(_ask(window, gram, buckets), an.KEYS)
    answers = an.shared_keys(asks, hot)
    sent = rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_send(window, gram, buckets), "part long, bucket long, contexts binary, counts binary, docs binary, runs binary")
    flags = sent.groupBy("bucket").applyInArrow(_resolve(window, rounds), an.KEYS)
    out = rows.groupBy("part").cogroup(answers.unionByName(flags).groupBy("part")) \
        .applyInArrow(_remove(window, gram, rounds, buckets), f"id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, rest {rest}")
    return out.withColumnRenamed("id", id_col)
