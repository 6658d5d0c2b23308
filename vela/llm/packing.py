"""Best-fit packing with bound-certified repacking.

Method.  Texts become token ids (plus an end id) and pieces of at most
``capacity`` tokens.  Pieces are dealt to partitions of bounded row count, and each
partition is packed by best-fit decreasing.  Dual-feasible functions over the
partition's length histogram give a lower bound on its bins; a partition that meets
its bound is certified and final.  Partitions with a gap keep their full bins and
exchange all other pieces: these are re-dealt to fewer partitions and packed
again.  A round counts only if it saves bins; the rounds end when every partition is
certified, nothing is saved, or ``rounds`` is reached.

Tokens.  The tokenizer splits at white space before anything else, so a text's ids
are the concatenation of its space-free words' ids.  Each distinct word of a
block of texts is encoded once and looked up after that.  (The tokenizer's own normalizer and
pre-tokenizer cost more than its merges; plain words skip them, see ``WordEncoder``.)
"""
from __future__ import annotations

import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm import textbytes as tb
from vela.llm.common import cut, only


_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿŒœ]+")
#: The tokenizer's split pattern for lower-cased text of _SIMPLE characters.
_SPLIT = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿœ]+|[0-9]|[!-/:-@\\[-`{-~]+")
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
#: Byte-level alphabet: a visible byte is itself, the others follow from U+0100 in order.
_BYTE_LEVEL = {b: chr(b) if b in _VISIBLE else chr(256 + b - sum(v < b for v in _VISIBLE)) for b in range(256)}


class WordEncoder:
    """Token ids of texts by words.

    Words of ASCII and Latin-1 letters (composed already, so normalization is lower-casing) are
    split here and their parts given to the tokenizer's model; any other word, and one
    that might hold a special token, goes through the whole tokenizer.  ``keep`` bounds the words remembered.
    """

    def __init__(self, path: str, keep: int = 800_000, recent: int = 100_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.keep, self.most_recent = Tokenizer.from_file(path), keep, recent
        self.model = self.tokenizer.model
        self.parts: dict[str, list[int]] = {}
        self._clear()

    def _clear(self):
        self.old, self.old_slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.recent: dict[int, int] = {}
        self.flat, self.begin = np.zeros(0, dtype=np.uint32), np.zeros(1, dtype=np.int64)

    def _word(self, word: str) -> list[int]:
        out = []
        for part in _SPLIT.findall(word.lower()):
            ids = self.parts.get(part)
            if ids is None:
                if len(self.parts) > self.most_recent:
                    self.parts.clear()
                seen = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_LEVEL)
                ids = self.parts[part] = [t.id for t in self.model.tokenize(seen)]
            out += ids
        return out

    def _learn(self, words: list[str], hashes: np.ndarray) -> np.ndarray:
        """Adds words; returns their slots."""
        flat, sizes = array("I"), []
        for w in words:
            ids = self._word(w) if "<|" not in w and _SIMPLE.fullmatch(w) else self.tokenizer.encode(w, add_special_tokens=False).ids
            flat.extend(ids)
            sizes.append(len(ids))
        slots = np.arange(len(words)) + len(self.begin) - 1
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(np.array(sizes, dtype=np.int64))])
        self.flat = np.concatenate([self.flat, np.frombuffer(flat, dtype=np.uint32)])
        self.recent.update(zip(hashes.tolist(), slots.tolist()))
        if len(self.recent) > self.most_recent:
            h = np.concatenate([self.old, np.fromiter(self.recent.keys(), dtype=np.uint64, count=len(self.recent))])
            at = np.concatenate([self.old_slot, np.fromiter(self.recent.values(), dtype=np.int64, count=len(self.recent))])
            by = np.argsort(h)
            self.old, self.old_slot, self.recent = h[by], at[by], {}
        return slots

    def _slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each known word, -1 for the others."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        if len(self.old):
            at = np.minimum(np.searchsorted(self.old, hashes), len(self.old) - 1)
            known = self.old[at] == hashes
            out[known] = self.old_slot[at[known]]
        rest = np.flatnonzero(out < 0)
        get = self.recent.get
        out[rest] = [get(h, -1) for h in hashes[rest].tolist()]
        return out

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets per text)."""
        starts, ends, wo = tb.word_spans(data, offsets, tb.NONSPACE)
        code, hashes = pd.factorize(tb.word_hashes(data, starts, ends, lower=False))
        if len(self.begin) + len(hashes) > self.keep:
            self._clear()
        slots = self._slots(hashes)
        new = np.flatnonzero(slots < 0)
        if len(new):
            first = np.empty(len(hashes), dtype=np.int64)
            first[code[::-1]] = np.arange(len(code))[::-1]
            raw, at = data.tobytes(), first[new]
            slots[new] = self._learn([raw[a:b].decode("utf-8") for a, b in zip(starts[at].tolist(), ends[at].tolist())], hashes[new])
        slots = slots[code]
        sizes = self.begin[slots + 1] - self.begin[slots]
        stop = np.cumsum(sizes)
        ids = self.flat[np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.begin[slots] - (stop - sizes), sizes)]
        return ids, np.r_[0, stop][wo]


_encoders: dict[str, WordEncoder] = {}


def encoder_of(path: str) -> WordEncoder:
    """One encoder for a worker process, so its tasks share the words they have met."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(path: str, capacity: int, end_id: int):
    def run(batches):
        encoder = encoder_of(path)
        for batch in batches:
            data, offs = tb.buffers(batch.column("text"))
            doc, piece, start, length, crc = [], [], [], [], []
            for lo, hi in tb.blocks(offs):
                ids, io = encoder.encode(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo])
                for i in range(hi - lo):
                    own = np.append(ids[io[i]:io[i + 1]], np.uint32(end_id)).astype("<u4")
                    for n, s in enumerate(range(0, len(own), capacity)):
                        part = own[s:s + capacity]
                        doc.append(lo + i)
                        piece.append(n)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
            yield pa.record_batch([batch.column("id").take(pa.array(doc, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                                  names=["id", "piece", "start", "length", "ids_crc32"])
            tb.release()
    return run


def tokenize_pieces(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, piece, start, length, ids_crc32 of every piece; a null or empty text is the end id alone."""
    kind = docs.schema[id_col].dataType.simpleString()
    return only(docs, id=id_col, text=text_col).mapInArrow(_pieces(path, capacity, end_id), f"id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Largest bound of two families of dual-feasible functions (exact integers)."""
    if not len(lengths):
        return 0
    hist = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((hist * x).sum()) // capacity)
    amount, count = np.cumsum(hist * x), np.cumsum(hist)
    for k in range(1, capacity // 2 + 1):  # over capacity - k counts whole, under k counts nothing
        whole = int(count[-1] - count[capacity - k])
        between = int(amount[capacity - k] - amount[k - 1])
        best = max(best, whole + -(-between // capacity))
    for k in range(1, 65):  # rounded multiples
        scaled = (k + 1) * x
        value = np.where(scaled % capacity == 0, x * k, scaled // capacity * capacity)  # times k
        best = max(best, -(-int((hist * value).sum()) // (capacity * k)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset) of each piece in the given order (longest first), and the fill of each bin."""
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, made = 0, 0
    for i, n in enumerate(lengths.tolist()):
        fits = mask >> n
        if fits:
            r = n + (fits & -fits).bit_length() - 1
            b = room[r].pop()
            if not room[r]:
                mask &= ~(1 << r)
        else:
            r, b = capacity, made
            made += 1
        bins[i], offsets[i] = b, capacity - r
        left = r - n
        if left:
            room[left].append(b)
            mask |= 1 << left
    fill = np.zeros(made, dtype=np.int64)
    np.add.at(fill, bins, lengths)
    return bins, offsets, fill


def _pack(capacity: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "id", "piece", "start"], ascending=[False, True, True, True], kind="stable")
        lengths = pdf["length"].to_numpy(dtype=np.int64)
        bins, offsets, fill = best_fit_decreasing(lengths, capacity)
        gap = len(fill) - lower_bound(lengths, capacity)
        return pdf.assign(bin=bins, offset=offsets, fill=fill[bins], bins=len(fill), gap=gap)
    return run


def pack(pieces: DataFrame, capacity: int = 2048, part_rows: int = 250_000, rounds: int = 4) -> DataFrame:
    """Adds sequence_id and offset to pieces (id, piece, start, length, ...).

    Every piece lies in exactly one sequence, sequences are gapless from offset 0 and hold
    at most ``capacity`` tokens; a length outside 1..capacity is an error.  An
    empty table packs to an empty table; repeated rows are pieces of their own;
    ties are broken by id, piece and start.
    """
    names = pieces.columns
    bad = pieces.where(f"length IS NULL OR length < 1 OR length > {capacity}").limit(1).count()
    if bad:
        raise ValueError(f"piece lengths must lie in 1..{capacity}")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", part long, bin long, offset long, fill long, bins long, gap long"

    def deal(rows: DataFrame, n: int, seed: int) -> DataFrame:
        parts = max(1, -(-n // part_rows))
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("id", "piece", "start", F.lit(seed)), F.lit(parts)).cast("long") + F.lit(seed << 32))
        return cut(dealt.groupBy("part").applyInPandas(_pack(capacity), schema))

    def totals(rows: DataFrame, gaps: bool) -> tuple[int, int]:
        """(bins that would be redone, their pieces)."""
        loose = rows.where(f"gap > 0 AND fill < {capacity}") if gaps else rows
        r = loose.agg(F.count_distinct(F.struct("part", "bin")), F.count(F.lit(1))).first()
        return r[0], r[1]

    now = deal(pieces, pieces.count(), 0)
    done = None
    for r in range(1, rounds + 1):
        bins, n = totals(now, gaps=True)
        if not bins or now.where("gap > 0").select("part").distinct().limit(2).count() < 2:
            break
        again = deal(now.where(f"gap > 0 AND fill < {capacity}").select(*names), n, r)
        if totals(again, gaps=False)[0] >= bins:
            break
        kept = now.where(f"gap <= 0 OR fill = {capacity}")
        done = kept if done is None else done.unionByName(kept)
        now = again
    out = now if done is None else done.unionByName(now)
    return out.select(*names, (F.col("part") * F.lit(1 << 22) + F.col("bin")).alias("sequence_id"), "offset")


def best_fit_pack(docs: DataFrame, path: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenize, cut and pack; one row per piece (see ``tokenize_pieces`` and ``pack``)."""
    pieces = cut(tokenize_pieces(docs, path, capacity, id_col=id_col, text_col=text_col))
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
