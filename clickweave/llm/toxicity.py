"""Toxicity scoring of texts whose disguise has been undone.

Spans that look disguised (leet characters inside words, a letter three times
or more in a row, letters set apart by separators) become character lattices:
each observed character offers the letters it may stand for, repeats offer
one or two letters, separators offer a gap or nothing. Viterbi decoding under
a character trigram model picks the reading. The trigrams are counted over
all documents. The restored words are then scored with a lexicon of words and
word beginnings learned from labelled texts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, checkpoint, id_remainder

# fixed value: letters that a character may stand for
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "il"}
WEAK = "!|"  # behind a word these mostly are what they seem
SEPARATORS = " .-_*/,"
# Letters of the model: a-z and the lower-case letters of Latin-1; 0 is the gap
# between words, OTHER any other letter.
LETTERS = [chr(c) for c in [*range(97, 123), *range(0xDF, 0x100)] if c != 0xF7]
CODE = {c: i + 1 for i, c in enumerate(LETTERS)}
OTHER = len(LETTERS) + 1
SYMBOLS = OTHER + 1
# Weights of trigram, bigram and unigram.
MIX = (0.85, 0.13, 0.02)
# Log-probabilities of the channel.
LEETED, UNCHANGED, GAP_KEPT, GAP_ADDED, REPEATED = math.log(0.4), math.log(0.002), math.log(0.4), math.log(0.6), math.log(0.5)
WEAK_KEPT = math.log(0.6)
# Documents of the training sample, by label.
SAMPLE = {1: 4000, 0: 6000}
# A feature of the lexicon is in so many, and in this share, of the sample's toxic
# texts; surely (by Wilson's lower bound) so large a share of its texts is toxic;
# and it has no more clean texts than the surest feature's share of them explains:
# wrong labels give every feature some.
MIN_SUPPORT, MIN_SHARE, LEAST_SURE = 4, 0.01, 0.6
# Standard errors between a share and what it surely is.
SURE = 2.0
PREFIXES = (4, 5)
BLOCK_CHARS = 1 << 18
CACHE_SPANS = 50_000
WORD = re.compile(r"[^\W\d_]+")


def code_table() -> np.ndarray:
    """Model code of the first 256 code points; what lies above counts as OTHER."""
    return np.array([CODE.get(chr(c), 0) for c in range(256)], np.uint8)


def _codes(text: str) -> np.ndarray:
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.where(cp < 256, code_table()[np.minimum(cp, 255)], OTHER).astype(np.int64)


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total = np.zeros(SYMBOLS ** 3, np.int64)
    for b in batches:
        for lo, hi in text_blocks(b["text"]):
            c = _codes("\n\n" + "\n".join(t for t in b["text"].iloc[lo:hi] if t is not None).lower() + "\n\n")
            c = np.concatenate([[0], c[np.concatenate([[True], (c[1:] > 0) | (c[:-1] > 0)])]])
            total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=len(total))
    at = np.flatnonzero(total)
    yield pd.DataFrame({"tri": at, "n": total[at]})


def text_blocks(texts) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        n = len(t) if t is not None else 0
        if i > start and size + n > BLOCK_CHARS:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)


def character_model(docs: DataFrame) -> np.ndarray:
    """log P(c | a, b) as [a, b, c], from the trigrams of all texts (gaps of any
    kind are one symbol). At most SYMBOLS**3 counts reach the driver."""
    n = np.zeros(SYMBOLS ** 3)
    parts = docs.select(F.col("text").cast("string")).mapInPandas(_count, "tri int, n long")
    for tri, k in parts.groupBy("tri").agg(F.sum("n")).collect():
        n[tri] = k
    n = n.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    n[:, 0, :] = n[:, 0, :].sum(axis=0)  # before a gap nothing matters
    bi = n.sum(axis=0)
    uni = bi.sum(axis=0) + 1.0
    share = lambda x: x / np.maximum(x.sum(axis=-1, keepdims=True), 1.0)
    return np.log(MIX[0] * share(n) + MIX[1] * share(bi)[None] + MIX[2] * share(uni)[None, None]).astype(np.float32)


def disguised(cp: np.ndarray, text_start: np.ndarray) -> list[tuple[int, int, bool]]:
    """(start, end, spaced) of the spans that look disguised, in order, none
    overlapping. cp: code points of some lower-cased texts, one behind the other."""
    kind = np.zeros(256, np.uint8)
    kind[[ord(c) for c in LETTERS]] = 1
    kind[[ord(c) for c in LEET]] = 2
    kind = np.where(cp < 256, kind[np.minimum(cp, 255)], 0)
    n = len(cp)
    cut = text_start.copy()
    cut[1:] |= kind[1:] != kind[:-1]
    at = np.flatnonzero(cut)
    end = np.append(at[1:], n)
    k = kind[at]
    # the characters of a run, repeats counted once
    new = np.append(True, cp[1:] != cp[:-1]) | cut if n else cut
    size = np.diff(np.append(0, np.cumsum(new)[end - 1])) if n else end
    same_left = ~text_start[at]
    left = np.where(same_left, np.concatenate([[0], k[:-1]]), 0)
    right = np.append(np.where(same_left[1:], k[1:], 0), 0)
    leet = (k == 2) & ((left == 1) & (right == 1) & (size <= 3) | (left == 0) & (right == 1) & (size <= 2)
                       | (left == 1) & (right == 0) & (size <= 2))
    marks = at[leet]
    if n > 2:
        three = (cp[2:] == cp[1:-1]) & (cp[1:-1] == cp[:-2]) & (kind[2:] == 1) & ~text_start[2:] & ~text_start[1:-1]
        marks = np.concatenate([marks, np.flatnonzero(three)])
    # words: runs of letters and leet characters
    inside = kind > 0
    edge = inside & text_start
    edge[1:] |= inside[1:] & ~inside[:-1]
    start = np.flatnonzero(edge)
    stop_at = np.flatnonzero(inside & np.append(~inside[1:] | text_start[1:], True)) + 1
    hit = np.unique(np.searchsorted(start, marks, "right") - 1)
    spans = [(a, b, False) for a, b in zip(start[hit].tolist(), stop_at[hit].tolist())]
    # letters set apart
    single = start[(stop_at - start == 1) & ~np.isin(cp[start], [ord(c) for c in WEAK])]
    if len(single) > 2:
        other = np.cumsum(~np.isin(cp, [ord(c) for c in SEPARATORS]))
        text = np.cumsum(text_start)
        joined = (other[single[1:] - 1] == other[single[:-1]]) & (text[single[1:]] == text[single[:-1]])
        change = np.flatnonzero(np.diff(np.concatenate([[0], joined.astype(np.int8), [0]])))
        for a, b in zip(change[::2].tolist(), change[1::2].tolist()):
            # three characters need a letter, so that short lists of numbers stay
            if b - a >= 3 or b - a == 2 and (kind[single[a:b + 1]] == 1).any():
                spans.append((int(single[a]), int(single[b]) + 1, True))
    out, last = [], 0
    for s in sorted(spans, key=lambda s: (s[0], -s[1])):
        if s[0] >= last:
            out.append(s)
            last = s[1]
    return out


class Decoder:
    """Viterbi decoding of spans under a character model."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp
        self.known: dict[tuple[str, bool], str] = {}

    def columns(self, span: str, spaced: bool) -> list[list[tuple[str, float]]]:
        """The lattice: for each column its readings, as (output, log-probability)."""
        cols: list[list[tuple[str, float]]] = []
        i, behind = 0, len(span.rstrip(WEAK))
        while i < len(span):
            c = span[i]
            if spaced and c in SEPARATORS:
                cols.append([("", GAP_ADDED), (" ", GAP_KEPT)])
                while span[i] in SEPARATORS:  # a letter is last
                    i += 1
                continue
            j = i
            while not spaced and j < len(span) and span[j] == c:
                j += 1
            run = max(1, j - i)
            same = 0.0 if c not in LEET else WEAK_KEPT if i >= behind and c in WEAK else UNCHANGED
            options = [(x, LEETED) for x in LEET.get(c, "")] + [(c, same)]
            cols.append(options)
            if run == 2:
                cols.append(options)
            elif run > 2:  # a stretched letter stands for one or two
                cols.append([("", REPEATED), *[(x, p + REPEATED) for x, p in options]])
            i += run
        return cols

    def __call__(self, span: str, spaced: bool) -> str:
        got = self.known.get((span, spaced))
        if got is None:
            got = self._decode(span, spaced)
            if len(self.known) > CACHE_SPANS:
                self.known.clear()
            self.known[(span, spaced)] = got
        return got

    def _decode(self, span: str, spaced: bool) -> str:
        logp = self.logp
        code = lambda c: CODE.get(c, 0 if not c.isalpha() else OTHER)
        # state -> (score, the outputs so far as a chain (chain before, output))
        best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        for col in self.columns(span, spaced):
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (p, out) in best.items():
                for x, q in col:
                    if x:
                        c = code(x)
                        state, score = (b, c), p + q + float(logp[a, b, c])
                    else:
                        state, score = (a, b), p + q
                    if state not in new or score > new[state][0]:
                        new[state] = (score, (out, x) if x else out)
            best = new
        ends = [(p + float(logp[a, b, 0]), out) for (a, b), (p, out) in best.items()]
        top = max(p for p, _ in ends)
        return max(_chained(out) for p, out in ends if p == top)


def _chained(out: tuple | None) -> str:
    parts = []
    while out is not None:
        out, x = out
        parts.append(x)
    return "".join(reversed(parts))


def restore(texts: list[str], decoder: Decoder) -> list[str]:
    """Lower-cased texts with their disguised spans decoded."""
    low = [t.lower() for t in texts]
    joined = "".join(low)
    if not joined:
        return low
    size = np.fromiter(map(len, low), np.int64, len(low))
    first = np.cumsum(size) - size
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    text_start = np.zeros(len(cp), bool)
    text_start[first[size > 0]] = True
    by: dict[int, list[tuple[int, int, bool]]] = {}
    spans = disguised(cp, text_start)
    for s, t in zip(spans, (np.searchsorted(first, [s[0] for s in spans], "right") - 1).tolist()):
        by.setdefault(t, []).append(s)
    for t, own in by.items():
        base, text, parts, at = int(first[t]), low[t], [], 0
        for a, b, spaced in own:
            parts += [text[at:a - base], decoder(text[a - base:b - base], spaced)]
            at = b - base
        low[t] = "".join(parts) + text[at:]
    return low


def features(text: str) -> set[str]:
    """Words of a restored text, and their beginnings marked with a star."""
    words = set(WORD.findall(text))
    return words | {w[:n] + "*" for n in PREFIXES for w in words if len(w) > n}


def _feature_rows(batches: Iterator[pd.DataFrame], logp) -> Iterator[pd.DataFrame]:
    decoder = Decoder(logp.value)
    for b in batches:
        for lo, hi in text_blocks(b["text"]):
            part = b.iloc[lo:hi]
            own = [sorted(features(t)) for t in restore(part["text"].tolist(), decoder)]
            yield pd.DataFrame({"doc_id": part["doc_id"].to_numpy(), "toxic": part["toxic"].to_numpy(), "f": own})


def learn(docs: DataFrame, labels: DataFrame, logp, mod: int, held_out: int) -> tuple[dict[str, float], float]:
    """(feature -> its share of toxic texts, share of toxic texts without any).

    Labels of documents whose remainder is not ``held_out``; about SAMPLE[y]
    documents of label y are drawn by a hash of doc_id, and texts that are the
    same count once. A feature is taken if at least MIN_SUPPORT texts and MIN_SHARE of the
    toxic ones have it, its share of toxic texts is surely LEAST_SURE or more, and
    its clean texts are no more than the surest feature has by share, within
    SURE standard errors. So the lexicon has fewer entries than the toxic
    sample has words, by MIN_SHARE."""
    y = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    y = y.where(F.col("toxic").isin(0, 1) & (id_remainder("doc_id", mod) != held_out)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = {r[0]: r[1] for r in y.groupBy("toxic").count().collect()}
    if not n.get(1):
        return {}, 0.0
    sample = F.lit(False)
    for label, most in SAMPLE.items():
        u = F.shiftrightunsigned(F.xxhash64(F.lit(7), "doc_id"), 11) / F.lit(float(1 << 53))
        sample = sample | ((F.col("toxic") == label) & (u < min(1.0, most / max(n.get(label, 0), 1))))
    # about SAMPLE's number of short rows
    drawn = docs.where(F.col("text").isNotNull()).join(F.broadcast(y.where(sample)), "doc_id").select("doc_id", "text", "toxic")
    drawn = drawn.groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    rows = drawn.mapInPandas(partial(_feature_rows, logp=logp), "doc_id long, toxic int, f array<string>").persist()
    size = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    scale = (n.get(0, 0) / max(size.get(0, 0), 1)) / (n[1] / max(size.get(1, 0), 1))  # clean texts behind each one drawn
    each = rows.select("doc_id", "toxic", F.explode("f").alias("f"))
    support = max(MIN_SUPPORT, math.ceil(MIN_SHARE * size.get(1, 0)))
    found = each.groupBy("f").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")).where(F.col("t") >= support)
    found = found.withColumn("n", F.col("t") + F.col("c") * scale).withColumn("p", (F.col("t") + 0.1) / (F.col("n") + 0.2))
    share, z2 = F.col("t") / F.col("n"), SURE * SURE
    low = (share + z2 / (2 * F.col("n")) - SURE * F.sqrt(share * (1 - share) / F.col("n") + z2 / (4 * F.col("n") * F.col("n")))) / (1 + z2 / F.col("n"))
    found = checkpoint(found.withColumn("low", low))
    q = found.agg(F.max_by("p", F.struct("low", "t"))).first()[0] or 1.0
    explained = F.col("n") * (1 - q) + SURE * F.sqrt(F.col("n") * q * (1 - q))
    precise = found.where((F.col("low") >= LEAST_SURE) & (F.col("c") * scale <= explained))
    best = precise.select("f", "p").collect()
    done = each.where("toxic = 1").join(precise, "f", "left_semi").select("doc_id").distinct().count()
    missed = (size.get(1, 0) - done) / (size.get(1, 0) - done + size.get(0, 0) * scale + 1)
    rows.unpersist()
    return {r[0]: r[1] for r in best}, float(min(missed, 0.49))


def _score(batches: Iterator[pd.DataFrame], model, with_text: bool) -> Iterator[pd.DataFrame]:
    logp, lexicon, base = model.value
    decoder = Decoder(logp)
    for b in batches:
        for lo, hi in text_blocks(b["text"]):
            part = b.iloc[lo:hi]
            restored = restore(["" if t is None else t for t in part["text"]], decoder)
            score = []
            for t in restored:
                clean = 1.0 - base
                for f in features(t) & lexicon.keys():
                    clean *= 1.0 - lexicon[f]
                score.append(1.0 - clean)
            out = part.drop(columns="text").assign(score=score)
            if with_text:
                out["restored"] = restored
            yield out


def fit(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0):
    """(character model, lexicon, score of a text without features), broadcast."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sc = docs.sparkSession.sparkContext
    logp = character_model(d)
    return sc.broadcast((logp, *learn(d, labels, sc.broadcast(logp), mod, held_out)))


def score(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0, with_text: bool = False) -> DataFrame:
    """(doc_id, held_out, score, predicted[, restored]), one row per input row.

    A score is 1 minus the product of (1 - p) over the lexicon features of the
    restored text, with the share of toxic texts that have no feature as the
    score of texts without any; predicted is 1 from 0.5 on. Null and empty
    texts have no feature. Labels that are null or neither 0 nor 1, and those
    of null ids, are not learned from; a document labelled twice is toxic if
    one label says so. Without any toxic label all scores are 0. A null doc_id is not held out.
    Repeated rows give repeated rows; other columns are ignored; an empty
    table gives an empty result.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    d = d.select(as_text("doc_id"), F.coalesce(id_remainder("doc_id", mod) == held_out, F.lit(False)).alias("held_out"), "text")
    extra = ", restored string" if with_text else ""
    out = d.mapInPandas(partial(_score, model=fit(docs, labels, mod, held_out), with_text=with_text),
                        "doc_id string, held_out boolean, score double" + extra)
    return out.select(as_id("doc_id"), "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      *(["restored"] if with_text else []))


def _scores(text: pd.Series, model) -> pd.Series:
    b = pd.DataFrame({"text": text})
    parts = [p["score"] for p in _score(iter([b]), model, False)]
    return pd.concat(parts) if parts else pd.Series([], dtype=float)


def classify(docs: DataFrame, labels: DataFrame, mod: int = 5, held_out: int = 0) -> DataFrame:
    """(row, score, predicted): as ``score``, with a struct of the input's columns."""
    model = fit(docs, labels, mod, held_out)
    scored = F.pandas_udf(lambda t: _scores(t, model), "double")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.withColumn("score", scored(F.col("row.text").cast("string")))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
