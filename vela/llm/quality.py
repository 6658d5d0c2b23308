"""Quality classifier: a sparse ensemble of rules over text statistics.

Method.  Statistics of a text (shares of character kinds, word lengths, repetition ...) are
computed in one vectorised pass.  On a bounded sample of labelled rows small
trees are boosted on random row and statistic subsets; every path from a root to a node becomes
a rule, a conjunction of thresholds.  A lasso logistic regression over the rules keeps
few of them, and those are compiled into one Spark column expression, which scores every row inside
generated code.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vela.llm import textbytes as tb
from vela.llm.common import cut, only

STATISTICS = ("log_words", "word_length", "upper_share", "digit_share", "symbol_share", "bang_share", "stop_share", "line_share", "wide_share", "repeat_share", "distinct_share", "letterless_share", "doubled_share", "longest_word")
_KINDS = {"upper": range(0x41, 0x5B), "digit": range(0x30, 0x3A), "symbol": [ord(c) for c in "#$%&*|@^~_=+<>\\/{}[]`"], "bang": [ord(c) for c in "!?"], "stop": [ord(c) for c in ".,;:"], "line": [10, 13], "wide": range(0x80, 0x100)}
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _kind(values) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(values)] = True
    return out


def statistics_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of STATISTICS for each text; zeros for an empty one."""
    size = np.diff(offsets)
    safe = np.maximum(size, 1)

    def per_text(mask: np.ndarray, at: np.ndarray = offsets) -> np.ndarray:
        return np.diff(np.r_[0, np.cumsum(mask, dtype=np.int64)][at])

    out = {f"{k}_share": per_text(_kind(v)[data]) / safe for k, v in _KINDS.items()}
    out["doubled_share"] = per_text(np.r_[False, data[1:] == data[:-1]] if len(data) else data) / safe
    starts, ends, wo = tb.word_spans(data, offsets, tb.NONSPACE)
    words = np.diff(wo)
    some = np.maximum(words, 1)
    hashes = tb.word_hashes(data, starts, ends, lower=True)
    lengths = (ends - starts).astype(np.int64)
    letters = np.r_[0, np.cumsum(_LETTER[data], dtype=np.int64)]
    again = np.r_[False, hashes[1:] == hashes[:-1]] if len(hashes) else np.zeros(0, dtype=bool)
    again[wo[:-1][words > 0]] = False
    out["log_words"] = np.log1p(words)
    out["word_length"] = np.diff(np.r_[0, np.cumsum(lengths)][wo]) / some
    out["repeat_share"] = per_text(again, wo) / some
    out["letterless_share"] = per_text(letters[ends] == letters[starts], wo) / some
    out["distinct_share"] = np.array([len(np.unique(hashes[a:b])) for a, b in zip(wo[:-1], wo[1:])]) / some
    full = np.flatnonzero(words)
    out["longest_word"] = np.zeros(len(size))
    if len(full):
        out["longest_word"][full] = np.log1p(np.maximum.reduceat(lengths, wo[:-1][full]))
    return np.stack([out[k] for k in STATISTICS], axis=1)


def _statistics(batches):
    for batch in batches:
        data, offs = tb.buffers(batch.column("text"))
        rows = [statistics_of(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]) for lo, hi in tb.blocks(offs)]
        s = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
        yield pa.record_batch([batch.column("id"), *(pa.array(s[:, i], pa.float64()) for i in range(len(STATISTICS)))], names=["id", *STATISTICS])
        tb.release()


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and STATISTICS of each row; a null text counts as empty."""
    kind = docs.schema[id_col].dataType.simpleString()
    return only(docs, id=id_col, text=text_col).mapInArrow(_statistics, f"id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """All of (statistic, above?, threshold) hold; above means >, else <=."""

    terms: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        out = None
        for name, above, t in self.terms:
            c = F.col(name) > F.lit(t) if above else F.col(name) <= F.lit(t)
            out = c if out is None else out & c
        return out

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for name, above, t in self.terms:
            v = x[:, STATISTICS.index(name)]
            out &= v > t if above else v <= t
        return out


@dataclass
class RuleModel:
    intercept: float
    rules: list[tuple[Rule, float]]

    def column(self) -> Column:
        z = F.lit(self.intercept)
        for rule, weight in self.rules:
            z = z + F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree(bins: np.ndarray, edges: list[np.ndarray], residual: np.ndarray, columns: np.ndarray, depth: int, least: int) -> list[tuple]:
    """Paths to all nodes below the root of a least-squares tree on binned statistics."""
    paths, todo = [], [(np.arange(len(bins)), ())]
    while todo:
        rows, path = todo.pop()
        if path:
            paths.append(path)
        best = None
        if len(path) < depth and len(rows) >= 2 * least:
            g, n = residual[rows].sum(), len(rows)
            for c in columns:
                if not len(edges[c]):
                    continue
                b = bins[rows, c]
                sums = np.cumsum(np.bincount(b, weights=residual[rows], minlength=len(edges[c]) + 1))[:-1]
                counts = np.cumsum(np.bincount(b, minlength=len(edges[c]) + 1))[:-1]
                ok = (counts >= least) & (n - counts >= least)
                gain = np.where(ok, sums ** 2 / np.maximum(counts, 1) + (g - sums) ** 2 / np.maximum(n - counts, 1) - g * g / n, -1)
                k = int(gain.argmax())
                if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
                    best = (gain[k], c, k)
        if best is None:
            continue
        _, c, k = best
        low = bins[rows, c] <= k
        t = float(edges[c][k])
        todo.append((rows[low], (*path, (STATISTICS[c], False, t))))
        todo.append((rows[~low], (*path, (STATISTICS[c], True, t))))
    return paths


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.3, l1: float = 0.0005, steps: int = 600, seed: int = 5) -> RuleModel:
    """Boosted trees, their paths as rules, then lasso logistic weights (accelerated proximal gradient)."""
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    if len(np.unique(y)) < 2:
        return RuleModel(float(np.log(share / (1 - share))), [])
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(x[:, c], np.linspace(0, 1, 66)[1:-1])) for c in range(x.shape[1])]
    edges = [e[e < x[:, c].max()] for c, e in enumerate(edges)]
    bins = np.stack([np.searchsorted(e, x[:, c], side="left") for c, e in enumerate(edges)], axis=1)
    margin, found = np.full(len(y), np.log(share / (1 - share))), {}
    least = max(5, len(y) // 500)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        rows = np.flatnonzero(rng.random(len(y)) < 0.5)
        cols = rng.choice(x.shape[1], size=max(2, x.shape[1] * 2 // 3), replace=False)
        paths = _tree(bins[rows], edges, (y - p)[rows], np.sort(cols), depth, least)
        for path in paths:
            found.setdefault(Rule(tuple(sorted(path))), None)
        # every row falls into one leaf: the deepest paths
        for path in paths:
            if not any(len(q) > len(path) and q[:len(path)] == path for q in paths):
                inside = Rule(path).holds(x)
                value = (y - p)[inside].sum() / max((p * (1 - p))[inside].sum(), 1e-6)
                margin[inside] += rate * np.clip(value, -4, 4)
    rules = list(found)
    if not rules:
        return RuleModel(float(np.log(share / (1 - share))), [])
    m = np.stack([r.holds(x) for r in rules], axis=1).astype(np.float64)
    varied = (m.mean(axis=0) > 0) & (m.mean(axis=0) < 1)
    rules, m = [r for r, v in zip(rules, varied) if v], m[:, varied]
    w, v, b, vb, t = np.zeros(len(rules)), np.zeros(len(rules)), np.log(share / (1 - share)), np.log(share / (1 - share)), 1.0
    step = 4.0 / max(float(np.linalg.eigvalsh(m.T @ m / len(y))[-1]) + 1, 1e-9)
    for _ in range(steps):
        g = 1 / (1 + np.exp(-(m @ v + vb))) - y
        w2 = v - step * (m.T @ g / len(y))
        w2 = np.sign(w2) * np.maximum(np.abs(w2) - step * l1, 0)
        b2, t2 = vb - step * g.mean(), (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, vb = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return RuleModel(float(b), [(r, float(c)) for r, c in zip(rules, w) if abs(c) > 1e-6])


def fit_quality(stats: DataFrame, labels: DataFrame, label_id: str = "doc_id", label_col: str = "quality", max_rows: int = 20_000, **options) -> RuleModel:
    """Learn from labelled rows (id, 0/1; null labels are left out); ``max_rows`` bounds the sample."""
    marked = only(labels, lid=label_id, y=label_col).where("y IS NOT NULL AND lid IS NOT NULL")
    n = marked.count()
    if n > max_rows:
        marked = marked.where(F.pmod(F.xxhash64("lid", F.lit(17)), F.lit(1_000_003)) < int(1_000_003 * max_rows / n))
    rows = stats.join(marked, stats.id == marked.lid).select("id", "y", *STATISTICS).collect()
    rows.sort(key=lambda r: str(r.id))
    return fit_rules(np.array([[r[s] for s in STATISTICS] for r in rows]).reshape(len(rows), len(STATISTICS)), np.array([float(r.y) for r in rows]), **options)


def score_quality(docs: DataFrame, train_labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """id, score (higher: label 1 likelier) and predicted (score >= 0.5) of each row.

    Null and empty texts are scored by their zero statistics; repeated rows give a row
    each; without two label values the score is the (clipped) label share, 0.5 without labels.
    """
    stats = cut(text_statistics(docs, id_col, text_col))
    model = fit_quality(stats, train_labels, id_col, label_col)
    score = model.column()
    return stats.select(F.col("id").alias(id_col), score.alias("score")).withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
