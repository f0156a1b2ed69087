"""Language identification by a byte convolutional network.

A text is cut into windows of WINDOW bytes. Filters of widths 2, 3 and 4 run
over the bytes of a window (one-hot, so a filter is a table of byte weights),
each filter's largest value goes through a ReLU to a softmax layer. The
network is trained in numpy on windows of a bounded sample of the labelled
texts. A text's prediction sums its windows' log-probabilities, weighted by
the bytes in them, so every byte of a long text counts.

For prediction the byte tables of a filter are added up to tables of byte
pairs: a filter of width 4 is the pair table at i plus the one at i + 2.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, bounded_sample, id_remainder

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 8  # for each width
# Bounds of the training sample: documents and windows of one language.
SAMPLE_DOCS = 600
SAMPLE_WINDOWS = 900
WINDOWS_PER_TEXT = 6
# Documents of the whole sample: with more languages each has fewer, LEAST_DOCS at least.
SAMPLE_TOTAL, LEAST_DOCS = 120_000, 20
EPOCHS, RATE, BATCH, SEED = 14, 0.02, 64, 11
# Windows predicted at once, so that their tables stay in the processor's cache.
BLOCK = 24
# Bytes of text predicted together (or one longer text).
TEXT_BLOCK = 1 << 20
UNKNOWN = "und"


def text_windows(raw: bytes) -> np.ndarray:
    """The bytes as rows of WINDOW, the last one filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[:len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(n, WINDOW)


class ByteNet:
    """tables[w]: (w, 256, FILTERS); out: (filters, languages); bias of both."""

    def __init__(self, languages: list[str], seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.tables = {w: rng.normal(0, 0.3 / np.sqrt(w), (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS}
        self.bias = {w: np.zeros(FILTERS, np.float32) for w in WIDTHS}
        total = FILTERS * len(WIDTHS)
        self.out = rng.normal(0, 1 / np.sqrt(total), (total, len(languages))).astype(np.float32)
        self.out_bias = np.zeros(len(languages), np.float32)
        self.pairs = None

    def _pooled(self, x: np.ndarray):
        """Pooled values and, for training, where each filter had its largest."""
        pooled, where = [], []
        for w in WIDTHS:
            n = WINDOW - w + 1
            z = sum(self.tables[w][j][x[:, j:j + n]] for j in range(w))
            at = z.argmax(axis=1)
            where.append(at)
            pooled.append(np.take_along_axis(z, at[:, None, :], 1)[:, 0] + self.bias[w])
        return np.concatenate(pooled, 1), where

    def fit(self, x: np.ndarray, y: np.ndarray) -> "ByteNet":
        """Adam on the cross entropy; the gradient of a max goes to the bytes
        under the filter where it was taken."""
        rng = np.random.default_rng(SEED)
        params = [*(self.tables[w] for w in WIDTHS), *(self.bias[w] for w in WIDTHS), self.out, self.out_bias]
        m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
        step = 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            order = rng.permutation(len(x))
            for lo in range(0, len(x), BATCH):
                part = order[lo:lo + BATCH]
                xb, yb = x[part], y[part]
                pooled, where = self._pooled(xb)
                act = np.maximum(pooled, 0)
                p = _softmax(act @ self.out + self.out_bias)
                p[np.arange(len(yb)), yb] -= 1
                p /= len(yb)
                back = (p @ self.out.T) * (pooled > 0)
                grads = []
                for k, w in enumerate(WIDTHS):
                    g, own = np.zeros_like(self.tables[w]), back[:, k * FILTERS:(k + 1) * FILTERS]
                    for j in range(w):
                        under = np.take_along_axis(xb, where[k] + j, 1)
                        np.add.at(g[j], (under, np.arange(FILTERS)[None, :]), own)
                    grads.append(g)
                grads += [back[:, k * FILTERS:(k + 1) * FILTERS].sum(0) for k in range(len(WIDTHS))]
                grads += [act.T @ p, p.sum(0)]
                step += 1
                for q, g, a, b in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    q -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
        return self

    def _prepare(self) -> None:
        """Byte tables -> one table of byte pairs, its columns: width 2, the first
        pairs of widths 3 and 4, the second pair of 4; and the last byte of 3."""
        t2, t3, t4 = (self.tables[w] for w in WIDTHS)
        pair = lambda a, b: (a[:, None, :] + b[None, :, :]).reshape(65536, FILTERS)
        self.pairs = np.ascontiguousarray(np.concatenate(
            [pair(t2[0], t2[1]), pair(t3[0], t3[1]), pair(t4[0], t4[1]), pair(t4[2], t4[3])], 1))
        self.last = np.ascontiguousarray(t3[2])

    def log_probs(self, x: np.ndarray) -> np.ndarray:
        """(windows, languages), a few windows at a time."""
        if self.pairs is None:
            self._prepare()
        out = np.empty((len(x), len(self.languages)), np.float32)
        f = FILTERS
        for lo in range(0, len(x), BLOCK):
            b = x[lo:lo + BLOCK]
            g = self.pairs.take((b[:, :-1].astype(np.uint16) << 8) | b[:, 1:], axis=0)
            parts = [g[:, :, :f], g[:, :-1, f:2 * f] + self.last.take(b[:, 2:], axis=0), g[:, :-2, 2 * f:3 * f] + g[:, 2:, 3 * f:]]
            pooled = np.concatenate([_max_pool(z) + self.bias[w] for z, w in zip(parts, WIDTHS)], 1)
            z = np.maximum(pooled, 0) @ self.out + self.out_bias
            z -= z.max(axis=1, keepdims=True)
            out[lo:lo + BLOCK] = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        return out


def _max_pool(z: np.ndarray) -> np.ndarray:
    """z.max(axis=1), by halves: long contiguous runs instead of many short ones."""
    while z.shape[1] > 1:
        half = z.shape[1] // 2
        top = np.maximum(z[:, :half], z[:, half:2 * half])
        if z.shape[1] % 2:
            np.maximum(top[:, :1], z[:, -1:], out=top[:, :1])
        z = top
    return z[:, 0]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(labelled: DataFrame) -> ByteNet | None:
    """labelled: (doc_id, text, lang), no nulls. None if there is no row.

    Every language is learned. At most SAMPLE_DOCS documents of each, fewer if that
    makes more than SAMPLE_TOTAL, are drawn by a hash of doc_id and text, WINDOWS_PER_TEXT of
    their windows reach the driver, and SAMPLE_WINDOWS of them are learned."""
    languages = sorted(r[0] for r in labelled.select("lang").distinct().collect())
    if not languages:
        return None
    per = min(SAMPLE_DOCS, max(LEAST_DOCS, SAMPLE_TOTAL // len(languages)))
    sample = bounded_sample(labelled, "lang", ["doc_id", "text"], per)
    rows = sample.select("doc_id", "text", "lang").mapInPandas(
        _training_windows, "doc_id long, lang string, pos int, w binary").collect()
    rows.sort(key=lambda r: (r[0], r[2], bytes(r[3])))
    rng, xs, ys = np.random.default_rng(SEED), [], []
    by: dict[str, list[bytes]] = {}
    for r in rows:
        by.setdefault(r[1], []).append(bytes(r[3]))
    for k, lang in enumerate(languages):
        own = by.get(lang, [])
        for i in rng.permutation(len(own))[:SAMPLE_WINDOWS].tolist():
            xs.append(np.frombuffer(own[i].ljust(WINDOW, b"\0"), np.uint8))
            ys.append(k)
    return ByteNet(languages).fit(np.array(xs), np.array(ys))


def _training_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """WINDOWS_PER_TEXT windows of each text, evenly spread over the whole of it."""
    for b in batches:
        rows = []
        for doc_id, text, lang in zip(b["doc_id"], b["text"], b["lang"]):
            w = text_windows(text.encode())
            rows += [(doc_id, lang, i, w[i].tobytes()) for i in np.unique(np.linspace(0, len(w) - 1, WINDOWS_PER_TEXT).astype(int)).tolist()]
        yield pd.DataFrame(rows, columns=["doc_id", "lang", "pos", "w"])


def predict_texts(net: ByteNet, raws: list[bytes]) -> tuple[list[str], np.ndarray]:
    """Languages and scores of some texts, their windows predicted together."""
    x = [text_windows(r) for r in raws]
    n = np.array([len(w) for w in x])
    first = np.cumsum(n) - n
    logs = net.log_probs(np.concatenate(x))
    weight = np.full(len(logs), float(WINDOW))
    weight[first + n - 1] = [len(r) - WINDOW * (k - 1) for r, k in zip(raws, n.tolist())]
    best = np.add.reduceat(weight[:, None] * logs, first, axis=0).argmax(axis=1)
    p = np.exp(logs[np.arange(len(logs)), np.repeat(best, n)]) * weight
    score = np.minimum(1.0, np.add.reduceat(p, first) / np.add.reduceat(weight, first))
    return [net.languages[k] for k in best.tolist()], score


def _predict(batches: Iterator[pd.DataFrame], net) -> Iterator[pd.DataFrame]:
    net = net.value
    for b in batches:
        pred = np.full(len(b), UNKNOWN, object)
        score = np.zeros(len(b))
        known = np.flatnonzero(b["letters"].to_numpy() & (net is not None))
        raws = [t.encode() for t in b["text"].to_numpy()[known]]
        lo = size = 0
        for i, r in enumerate(raws):
            size += len(r)
            if size > TEXT_BLOCK or i + 1 == len(raws):
                pred[known[lo:i + 1]], score[known[lo:i + 1]] = predict_texts(net, raws[lo:i + 1])
                lo, size = i + 1, 0
        yield pd.DataFrame({"doc_id": b["doc_id"], "held_out": b["held_out"], "lang_pred": pred, "score": score})


def identify(docs: DataFrame, mod: int = 4, held_out: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score), one row per input row.

    Learns from the rows with a text, a lang and a doc_id whose crc32 remainder
    is not ``held_out``; lang, source and doc_id are never inputs of a
    prediction. score is the mean probability of lang_pred over the windows.
    A null text, a text without a letter, and any text if nothing could be
    learned is ``und`` with score 0. A null doc_id is never learned from and
    is not held out. Repeated rows give repeated rows; other columns are
    ignored; an empty table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    rest = id_remainder("doc_id", mod)
    net = train(d.where((rest != held_out) & F.col("text").isNotNull() & F.col("lang").isNotNull()))
    return (d.select(as_text("doc_id"), "text", F.coalesce(rest == held_out, F.lit(False)).alias("held_out"),
                     F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))
            .mapInPandas(partial(_predict, net=docs.sparkSession.sparkContext.broadcast(net)),
                         "doc_id string, held_out boolean, lang_pred string, score double")
            .withColumn("doc_id", as_id("doc_id")))
