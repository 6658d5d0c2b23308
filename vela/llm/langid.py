"""Language identification with a byte convolutional network trained in numpy.

Model.  A window of ``length`` bytes (A-Z folded, zero-padded at the end of a
text) goes through filters of several widths (a filter of width w holds one
256-entry table per offset, which is a convolution over one-hot bytes), max pooling over
the window, a rectifier and a softmax layer.  A text is cut into adjacent windows
that cover all of it; its class probabilities are the mean of the windows'
probabilities, weighted by the bytes each window holds.

Training.  A bounded sample (``max_docs`` labelled documents in all, spread
evenly over the languages, ``windows_per_doc`` windows each at random places) goes to
the driver; Adam on cross-entropy with back-propagation through the pooled
positions only.  Prediction is one map-only pass over whole texts; the
broadcast model has a fixed size.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vela.llm import textbytes as tb
from vela.llm.common import crc_mod, only

UNDETERMINED = "und"


class ByteCnn:
    """Tables ``conv[w][j]`` (256 x filters), dense ``weight`` and ``bias``."""

    def __init__(self, langs: list[str], length: int = 256, widths: tuple[int, ...] = (2, 3, 4), filters: int = 16, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.langs, self.length, self.widths, self.filters = langs, length, widths, filters
        self.conv = [rng.normal(0, 0.4 / np.sqrt(w), (w, 256, filters)).astype(np.float32) for w in widths]
        hidden = filters * len(widths)
        self.weight = rng.normal(0, 1 / np.sqrt(hidden), (hidden, len(langs))).astype(np.float32)
        self.bias = np.zeros(len(langs), dtype=np.float32)
        self._pairs = None

    def __getstate__(self):
        return self.__dict__ | {"_pairs": None}

    def maps(self, x: np.ndarray) -> list[np.ndarray]:
        """Filter responses (windows x positions x filters) for each width."""
        out = []
        for w, tables in zip(self.widths, self.conv):
            p = x.shape[1] - w + 1
            a = tables[0][x[:, :p]]
            for j in range(1, w):
                a += tables[j][x[:, j:p + j]]
            out.append(a)
        return out

    def pooled(self, x: np.ndarray) -> np.ndarray:
        """Max-pooled responses; two neighbouring bytes share one table of sums."""
        if self._pairs is None:
            self._pairs = [[(t[j][:, None, :] + t[j + 1][None, :, :]).reshape(65536, -1) for j in range(0, w - 1, 2)] for w, t in zip(self.widths, self.conv)]
        two = x[:, :-1].astype(np.int32) * 256 + x[:, 1:]
        out = []
        for w, tables, pairs in zip(self.widths, self.conv, self._pairs):
            p = x.shape[1] - w + 1
            a = pairs[0].take(two[:, :p], axis=0)
            for j in range(1, len(pairs)):
                a += pairs[j].take(two[:, 2 * j:p + 2 * j], axis=0)
            if w % 2:
                a += tables[w - 1].take(x[:, w - 1:], axis=0)
            out.append(a.max(axis=1))
        return np.concatenate(out, axis=1)

    def softmax(self, pooled: np.ndarray) -> np.ndarray:
        z = np.maximum(pooled, 0) @ self.weight + self.bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, batch: int = 128, rate: float = 0.01, seed: int = 11) -> ByteCnn:
        rng = np.random.default_rng(seed)
        params = [*self.conv, self.weight, self.bias]
        first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step, total = 0, max(1, epochs * -(-len(x) // batch))
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for s in range(0, len(x), batch):
                xb, yb = x[order[s:s + batch]].copy(), y[order[s:s + batch]]
                short = np.flatnonzero(rng.random(len(xb)) < 0.25)  # short texts too
                keep = rng.integers(4, self.length // 2, len(short))
                xb[short] *= np.arange(self.length)[None, :] < keep[:, None]
                maps = self.maps(xb)
                at = [m.argmax(axis=1) for m in maps]
                pooled = np.concatenate([np.take_along_axis(m, a[:, None, :], axis=1)[:, 0] for m, a in zip(maps, at)], axis=1)
                p = self.softmax(pooled)
                p[np.arange(len(xb)), yb] -= 1
                p /= len(xb)
                grads = [np.zeros_like(c) for c in self.conv]
                back = (p @ self.weight.T) * (pooled > 0)
                cols, rows = np.arange(self.filters)[None, :], np.arange(len(xb))[:, None]
                for i, (w, a) in enumerate(zip(self.widths, at)):
                    g = back[:, i * self.filters:(i + 1) * self.filters]
                    for j in range(w):
                        np.add.at(grads[i][j], (xb[rows, a + j], np.broadcast_to(cols, a.shape)), g)
                grads += [np.maximum(pooled, 0).T @ p, p.sum(axis=0)]
                step += 1
                lr = rate * (1 - step / (total + 1))
                for q, g, m1, m2 in zip(params, grads, first, second):
                    m1 += 0.1 * (g - m1)
                    m2 += 0.001 * (g * g - m2)
                    q -= (lr * (m1 / (1 - 0.9 ** step)) / (np.sqrt(m2 / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
        self._pairs = None
        return self

    def predict(self, data: np.ndarray, offsets: np.ndarray, chunk: int = 96) -> np.ndarray:
        """Class probabilities of each text (zeros for an empty one)."""
        n, size = len(offsets) - 1, self.length
        lengths = np.diff(offsets)
        count = -(-lengths // size)
        doc = np.repeat(np.arange(n), count)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
        start = offsets[doc] + nth * size
        held = np.minimum(size, offsets[doc + 1] - start)
        padded = np.concatenate([tb.LOWER[data], np.zeros(size, dtype=np.uint8)])
        view = np.lib.stride_tricks.sliding_window_view(padded, size)
        out = np.zeros((n, len(self.langs)))
        for s in range(0, len(doc), chunk):
            x = view[start[s:s + chunk]].copy()
            h = held[s:s + chunk]
            x *= np.arange(size)[None, :] < h[:, None]
            np.add.at(out, doc[s:s + chunk], self.softmax(self.pooled(x)) * h[:, None])
        return out / np.maximum(lengths, 1)[:, None]


def _sample(length: int, per_doc: int, seed: int):
    def run(batches):
        for batch in batches:
            data, offs = tb.buffers(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            keys = batch.column("key").to_pylist()
            out_l, out_x = [], []
            for i, lang in enumerate(langs):
                text = tb.LOWER[data[offs[i]:offs[i + 1]]]
                if not len(text):
                    continue
                rng = np.random.default_rng([seed, keys[i] & 0x7FFFFFFF])
                places = rng.integers(0, max(1, len(text) - length // 2), per_doc) if len(text) > length else [0]
                for p in places:
                    out_l.append(lang)
                    out_x.append(text[p:p + length].tobytes())
            yield pa.record_batch([pa.array(out_l, pa.string()), pa.array(out_x, pa.binary())], names=["lang", "x"])
    return run


def fit_langid(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", max_docs: int = 6000,
               windows_per_doc: int = 4, max_langs: int = 512, length: int = 256, epochs: int = 5, seed: int = 7) -> ByteCnn | None:
    """Train on the rows with a non-null language and a text; None if there are none.

    ``max_docs`` bounds the sample (in all, split evenly over the languages);
    more than ``max_langs`` distinct labels is an error.
    """
    rows = only(labelled, lang=lang_col, text=text_col, id=id_col).where("lang IS NOT NULL AND text IS NOT NULL AND length(text) > 0") \
        .select("lang", "text", F.xxhash64(F.col("id"), F.lit(seed)).alias("key"))
    counts = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    if not counts:
        return None
    langs = sorted(r.lang for r in counts)
    per = max(1, max_docs // len(langs))
    share = F.create_map(*[x for r in counts for x in (F.lit(r.lang), F.lit(min(1.0, 1.1 * per / r.n)))])
    picked = rows.where(F.pmod("key", F.lit(1_000_003)) < F.lit(1_000_003.0) * share[F.col("lang")])
    got = picked.mapInArrow(_sample(length, windows_per_doc, seed), "lang string, x binary").collect()
    got.sort(key=lambda r: (r.lang, bytes(r.x)))  # the same order whatever the partitions
    x = np.zeros((len(got), length), dtype=np.uint8)
    for i, r in enumerate(got):
        x[i, :len(r.x)] = np.frombuffer(bytes(r.x), dtype=np.uint8)
    index = {v: i for i, v in enumerate(langs)}
    return ByteCnn(langs, length=length, seed=seed).fit(x, np.array([index[r.lang] for r in got]), epochs=epochs)


def _predict(model_bc, carried: list[str]):
    def run(batches):
        model = model_bc.value
        for batch in batches:
            data, offs = tb.buffers(batch.column("text"))
            parts = [model.predict(data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]) for lo, hi in tb.blocks(offs)]
            p = np.concatenate(parts) if parts else np.zeros((0, len(model.langs)))
            best = p.argmax(axis=1) if len(p) else np.zeros(0, dtype=int)
            letters = np.array(batch.column("letters").to_pylist(), dtype=bool)
            names = np.array(model.langs, dtype=object)[best]
            yield pa.record_batch([batch.column("id"), pa.array(np.where(letters, names, UNDETERMINED), pa.string()),
                                   pa.array(np.where(letters, np.clip(p[np.arange(len(p)), best], 0, 1), 0.0), pa.float64()), *(batch.column(c) for c in carried)], names=["id", "lang_pred", "score", *carried])
            tb.release()
    return run


def identify(docs: DataFrame, model: ByteCnn | None, text_col: str = "text", id_col: str = "doc_id", carry: list[str] | None = None) -> DataFrame:
    """id, lang_pred, score for each row, and with ``carry`` also text and rest (a struct of those columns).

    A null text, one without a letter, or any text when there is no model gives
    ``und`` with score 0.  Repeated rows give a row each; the prediction reads the
    text alone.
    """
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("struct<none:int>")
    letters = F.coalesce(F.col(f"`{text_col}`").rlike(r"\p{L}"), F.lit(False))
    work = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), letters.alias("letters"), rest.alias("rest"))
    carried = ["text", "rest"] if carry else []
    if model is None:
        return work.select(F.col("id").alias(id_col), F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"), *carried)
    bc = docs.sparkSession.sparkContext.broadcast(model)
    kinds = {c: work.schema[c].dataType.simpleString() for c in ("id", *carried)}
    return work.mapInArrow(_predict(bc, carried), f"id {kinds['id']}, lang_pred string, score double" + "".join(f", {c} {kinds[c]}" for c in carried)).withColumnRenamed("id", id_col)


def train_rows(docs: DataFrame) -> DataFrame:
    """Rows that may teach: crc32(doc_id as text) mod 4 is not 2."""
    return docs.where(crc_mod("doc_id", 4) != 2)
