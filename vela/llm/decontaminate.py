"""Benchmark decontamination: prefix-filtered containment join over item-sized windows.

Method.  Every run of ``window`` consecutive item words is one set element
group to look for (an item with fewer words is one window as a whole).  The
word shingles of a window are ordered by rarity (documents of the corpus that
hold them).  A document that contains the window contains all its shingles, so
one necessary prefix token, the rarest shingle, is enough to find every
candidate (prefix length |w| - ceil(1.0 * |w|) + 1 = 1).  A match of the
token at document position p and window offset o is dropped unless the window
fits between the document's first and last word (positional and length bound).
What is left is verified: the 64-bit hash of the whole window, then word by word.

Scale.  Two passes over the documents, both map-only apart from the small count of
shingle frequencies.  The window index is broadcast in slices of at most
``slice_bytes`` of item text; a larger benchmark gives more slices, applied one
after the other, so no broadcast grows with the data.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm import textbytes as tb
from vela.llm.common import only

#: Words of a shingle, the tokens of the prefix filter.
SHINGLE = 4
_BITS = 20


class _Index:
    """Windows of one slice of items, by prefix token."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = pa.array([t for _, t in items], type=pa.string())
        data, offs = tb.buffers(texts)
        starts, ends, wo = tb.word_spans(data, offs, _lower_class())
        low = tb.LOWER[data].tobytes()
        hashes = tb.word_hashes(data, starts, ends, lower=True)
        words = [low[a:b] for a, b in zip(starts, ends)]
        owners: dict[tuple[bytes, ...], set[str]] = {}
        place: dict[tuple[bytes, ...], int] = {}
        for i, (item, _) in enumerate(items):
            a, b = int(wo[i]), int(wo[i + 1])
            if a == b:
                continue
            for s in range(a, max(a, b - window) + 1):
                key = tuple(words[s:min(s + window, b)])
                owners.setdefault(key, set()).add(item)
                place.setdefault(key, s)
        self.windows = list(owners)
        self.owners = [sorted(owners[k]) for k in self.windows]
        self.lengths = np.array([len(k) for k in self.windows], dtype=np.int64)
        at = np.array([place[k] for k in self.windows], dtype=np.int64)
        self.hashes = np.array([tb.window_hashes(hashes[s:s + m], m)[0] for s, m in zip(at, self.lengths)], dtype=np.uint64)
        grams = {k: tb.window_hashes(hashes, k) for k in range(1, SHINGLE + 1)}
        self.sizes = np.minimum(self.lengths, SHINGLE)
        # all shingles of each window, as (window, offset, token)
        count = self.lengths - self.sizes + 1
        self.w = np.repeat(np.arange(len(at)), count)
        self.off = np.arange(len(self.w)) - np.repeat(np.cumsum(count) - count, count)
        self.tok = np.array([grams[k][p] for k, p in zip(self.sizes[self.w].tolist(), (at[self.w] + self.off).tolist())], dtype=np.uint64)
        self.tok_size = self.sizes[self.w]

    def keep_prefix(self, frequency: dict[int, int]) -> None:
        """Only the rarest shingle of each window stays (ties: smaller hash)."""
        f = np.array([frequency.get(int(t), 0) for t in self.tok], dtype=np.int64)
        order = np.lexsort((self.off, self.tok, f, self.w))
        first = order[np.flatnonzero(np.r_[True, np.diff(self.w[order]) > 0])] if len(order) else order
        first = first[np.argsort(self.tok[first], kind="stable")]
        self.w, self.off, self.tok, self.tok_size = self.w[first], self.off[first], self.tok[first], self.tok_size[first]


def _lower_class() -> np.ndarray:
    return tb.ALNUM[tb.LOWER]


def _filter(tokens: np.ndarray) -> np.ndarray:
    bitmap = np.zeros(1 << _BITS, dtype=bool)
    bitmap[(tokens & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
    return bitmap


def _found(grams: np.ndarray, tokens: np.ndarray, bitmap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose shingle is one of the sorted tokens, and the first index of that token."""
    p = np.flatnonzero(bitmap[(grams & np.uint64((1 << _BITS) - 1)).astype(np.int64)])
    at = np.searchsorted(tokens, grams[p])
    ok = at < len(tokens)
    ok[ok] = tokens[at[ok]] == grams[p[ok]]
    return p[ok], at[ok]


def _parts(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, word starts, ends, word offsets) for blocks of documents of one batch."""
    data, offs = tb.buffers(column)
    for lo, hi in tb.blocks(offs):
        part, o = data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        yield lo, hi, part, *tb.word_spans(part, o, _lower_class())


def _count(index_bc):
    def run(batches):
        index = index_bc.value
        by_size = {k: np.unique(index.tok[index.tok_size == k]) for k in np.unique(index.tok_size).tolist()}
        bitmaps = {k: _filter(t) for k, t in by_size.items()}
        for batch in batches:
            seen: dict[int, int] = {}
            for lo, hi, part, starts, ends, wo in _parts(batch.column(0)):
                hashes = tb.word_hashes(part, starts, ends, lower=True)
                for k, tokens in by_size.items():
                    p, at = _found(tb.window_hashes(hashes, k), tokens, bitmaps[k])
                    doc = np.searchsorted(wo, p, side="right") - 1
                    inside = p + k <= wo[doc + 1]
                    pairs = np.unique(np.stack([at[inside], doc[inside]]), axis=1)
                    ids, n = np.unique(pairs[0], return_counts=True)
                    for t, c in zip(tokens[ids].tolist(), n.tolist()):
                        seen[t] = seen.get(t, 0) + c
            yield pa.record_batch([pa.array(np.array(list(seen), dtype=np.uint64).view(np.int64), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["token", "n"])
    return run


def _scan(index_bc, final: bool):
    def run(batches):
        index = index_bc.value
        by_size = {}
        for k in np.unique(index.tok_size).tolist():
            sel = np.flatnonzero(index.tok_size == k)
            by_size[k] = (index.tok[sel], sel, _filter(index.tok[sel]))
        for batch in batches:
            n = batch.num_rows
            words = np.zeros(n, dtype=np.int64)
            hit: dict[int, list] = {}
            for lo, hi, part, starts, ends, wo in _parts(batch.column("text")):
                words[lo:hi] = np.diff(wo)
                hashes = tb.word_hashes(part, starts, ends, lower=True)
                low = None
                for k, (tokens, sel, bitmap) in by_size.items():
                    p, at = _found(tb.window_hashes(hashes, k), tokens, bitmap)
                    last = np.searchsorted(tokens, tokens[at], side="right") if len(at) else at
                    many = last - at  # windows that share this prefix token
                    pos = np.repeat(p, many)
                    row = sel[np.repeat(at, many) + np.arange(len(pos)) - np.repeat(np.cumsum(many) - many, many)]
                    win = index.w[row]
                    start = pos - index.off[row]
                    doc = np.searchsorted(wo, pos, side="right") - 1
                    ok = (start >= wo[doc]) & (start + index.lengths[win] <= wo[doc + 1])
                    start, win, doc = start[ok], win[ok], doc[ok]
                    for m in np.unique(index.lengths[win]).tolist():
                        of = index.lengths[win] == m
                        s, w, d = start[of], win[of], doc[of]
                        same = tb.window_hashes(hashes, m)[s] == index.hashes[w]
                        for a, x, i in zip(s[same].tolist(), w[same].tolist(), d[same].tolist()):
                            low = tb.LOWER[part].tobytes() if low is None else low
                            if all(low[starts[a + j]:ends[a + j]] == v for j, v in enumerate(index.windows[x])):
                                hit.setdefault(lo + i, []).append((a - int(wo[i]), m, x))
            spans, items = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            for i, found in hit.items():
                spans[i] = spans[i] + [v for a, m, _ in found for v in (a, a + m)]
                items[i] = sorted(set(items[i]).union(*[index.owners[x] for _, _, x in found]))
            kept = [batch.column(c) for c in ("id", "text", "rest")]
            if final:
                yield _finish(kept, words, spans, items)
            else:
                yield pa.record_batch([*kept, pa.array(spans, pa.list_(pa.int64())), pa.array(items, pa.list_(pa.string()))], names=["id", "text", "rest", "spans", "items"])
            tb.release()
    return run


def _finish(kept: list[pa.Array], words: np.ndarray, spans: list[list[int]], items: list[list[str]]) -> pa.RecordBatch:
    n_hit, digest = [], []
    for own, names in zip(spans, items):
        covered, reach = 0, 0
        for a, b in sorted(zip(own[::2], own[1::2])):
            covered += max(0, b - max(a, reach))
            reach = max(reach, b)
        n_hit.append(covered)
        digest.append(hashlib.sha256(",".join(names).encode()).hexdigest())
    return pa.record_batch([*kept, pa.array(words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array([len(x) for x in items], pa.int64()), pa.array(digest, pa.string()), pa.array(items, pa.list_(pa.string()))],
                           names=["id", "text", "rest", "n_words", "n_hit", "n_items", "items_sha256", "items"])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, slice_bytes: int = 4 << 20,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  carry: list[str] | None = None) -> DataFrame:
    """One row per document row: id, n_words, n_hit, n_items, items_sha256, items (array), and with
    ``carry`` also text and rest (a struct of those columns).

    Null or wordless texts have no words and no hits; null or wordless items and
    items without an id have no window; repeated item rows count once per item_id;
    repeated document rows give a row each; an empty benchmark hits nothing.
    Item ids are compared and sorted as strings.  Extra columns are left out.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    work = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), rest.alias("rest"))
    rest_type = work.schema["rest"].dataType.simpleString()
    items = only(benchmark, item=item_col, text=item_text_col).where("item IS NOT NULL AND text IS NOT NULL") \
        .select(F.col("item").cast("string").alias("item"), "text")
    size = int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0)
    slices = max(1, -(-size // slice_bytes))
    out = work.select("id", "text", "rest", F.array().cast("array<bigint>").alias("spans"), F.array().cast("array<string>").alias("items"))
    between = f"id {id_type}, text string, rest {rest_type}, spans array<long>, items array<string>"
    final = f"id {id_type}, text string, rest {rest_type}, n_words long, n_hit long, n_items long, items_sha256 string, items array<string>"
    for s in range(slices):
        rows = items.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == s).collect()
        index = _Index([(r.item, r.text) for r in rows], window)
        counting = spark.sparkContext.broadcast(index)
        counts = work.select("text").mapInArrow(_count(counting), "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
        # at most one row for each shingle of this slice
        index.keep_prefix({r.token & 0xFFFFFFFFFFFFFFFF: r.n for r in counts.collect()})
        last = s == slices - 1
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(index), last), final if last else between)
    return (out if carry else out.drop("text", "rest")).withColumnRenamed("id", id_col)


def contaminated(n_hit: str = "n_hit", n_words: str = "n_words"):
    """A document is contaminated if a twentieth of its words or more is hit."""
    return (F.col(n_hit) > 0) & (F.lit(20) * F.col(n_hit) >= F.col(n_words))
