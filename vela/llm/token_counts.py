"""Token counts without tokens: count-only Viterbi over a unigram vocabulary.

Method.  An Aho-Corasick automaton finds every vocabulary piece that ends at each
character.  Dynamic programming keeps, for each end, only the best path's score and
its number of pieces, no back-pointers and no token strings.  Ties are the unigram tokenizer's:
a path replaces another only if its score is higher, and paths come in order
of their last piece's start, so of equal scores the longest last piece wins.  A
character that no piece of its own covers is unknown: it scores the smallest score less 10
and counts as its UTF-8 bytes (byte fallback).

White space.  A space is written U+2581 and one is put before a text.  If no piece holds that sign after
another character, no piece crosses the start of a run of spaces, and the best path is the
best paths of the segments between them; likewise around a character in no
piece.  Each distinct segment of a batch is then solved once.  With whole-number
scores (checked) double sums are exact, so the split changes nothing; other vocabularies
run over whole texts.
"""
from __future__ import annotations

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from vela.llm import textbytes as tb
from vela.llm.common import only

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


class UnigramCounter:
    """Best score and piece count of texts for (piece, score) pairs."""

    def __init__(self, pieces: list[tuple[str, float]], keep: int = 1_000_000):
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        if pieces:
            self.automaton.make_automaton()
        self.single = {p for p, _ in pieces if len(p) == 1}
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        whole = all(float(s).is_integer() for _, s in pieces)
        self.by_segment = whole and not any(SPACE in p.lstrip(SPACE) for p, _ in pieces)
        self.lines = not any("\n" in p for p, _ in pieces)
        self.keep, self.known = keep, {}

    def best(self, text: str) -> tuple[float, int]:
        """Score and count of the best path over a text (spaces already written as the sign)."""
        n = len(text)
        score, count = [0.0] * (n + 1), [0] * (n + 1)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        if len(self.automaton):
            for end, hit in self.automaton.iter(text):
                ends[end].append(hit)
        for i, c in enumerate(text):
            top, pieces, first = -np.inf, 0, n
            for length, s in ends[i]:
                start = i + 1 - length
                value = score[start] + s
                if value > top or value == top and start < first:
                    top, pieces, first = value, count[start] + 1, start
            if c not in self.single:
                value = score[i] + self.unknown
                if value > top:
                    top, pieces = value, count[i] + len(c.encode("utf-8", "surrogatepass"))
            score[i + 1], count[i + 1] = top, pieces
        return score[n], count[n]

    def _solve(self, segment: str) -> tuple[float, int]:
        return self.best(segment.replace(" ", SPACE))

    def count(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(score, pieces) of each text; each text already begins with the extra space."""
        n, raw = len(offsets) - 1, data.tobytes()
        score, pieces = np.zeros(n), np.zeros(n, dtype=np.int64)
        if not self.by_segment:
            for i in range(n):
                if offsets[i + 1] > offsets[i]:
                    score[i], pieces[i] = self._solve(raw[offsets[i]:offsets[i + 1]].decode())
            return score, pieces
        if not len(data):
            return score, pieces
        space = data == 32
        begins = space & ~np.r_[False, space[:-1]]
        if self.lines:
            line = data == 10
            begins |= line | np.r_[False, line[:-1]]
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(begins)
        ends = np.r_[starts[1:], len(data)]
        code, hashes = pd.factorize(tb.word_hashes(data, starts, ends, lower=False))
        if len(self.known) + len(hashes) > self.keep:
            self.known = {}
        first = np.empty(len(hashes), dtype=np.int64)
        first[code[::-1]] = np.arange(len(code))[::-1]
        got = []
        for h, at in zip(hashes.tolist(), first.tolist()):
            v = self.known.get(h)
            if v is None:
                v = self.known[h] = self._solve(raw[starts[at]:ends[at]].decode())
            got.append(v)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        score = np.bincount(doc, weights=np.array([v[0] for v in got])[code], minlength=n)
        np.add.at(pieces, doc, np.array([v[1] for v in got], dtype=np.int64)[code])
        return score, pieces


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Ordinary pieces and scores of a sentencepiece model file (no control, unknown or byte pieces)."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


def _count(path: str):
    def run(batches):
        counter = UnigramCounter(vocabulary(path))
        for batch in batches:
            text = pc.replace_substring(pc.fill_null(batch.column("text").cast(pa.large_string()), ""), SPACE, " ")
            text = pc.if_else(pc.equal(text, ""), "", pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), text, pa.scalar("", pa.large_string())))
            data, offs = tb.buffers(text)
            parts = [counter.count(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]) for lo, hi in tb.blocks(offs)]
            score = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0)
            pieces = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, dtype=np.int64)
            yield pa.record_batch([batch.column("id"), pa.array(pieces), pa.array(score)], names=["id", "n_pieces", "score"])
            tb.release()
    return run


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_pieces and the best path's score of each row.

    A null or empty text has no pieces and score 0; repeated rows give a row each;
    extra columns are left out.  The vocabulary file must exist on every executor.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return only(docs, id=id_col, text=text_col).mapInArrow(_count(path), f"id {kind}, n_pieces long, score double").withColumnRenamed("id", id_col)
