"""Byte-level BPE encoding by prefix-sharing trie traversal, and decoding.

For merges applied in rank order, the encoding of a word's prefix is fixed by
its last token: it is the one vocabulary token that is a suffix of the prefix
and may stand behind the encoding of what is left of it. Two tokens may stand
side by side if merging their bytes anew would keep the border between them.
The distinct words of a block form a trie; in sorted order its paths are
walked depth-first, and the last-token states of a shared prefix are computed
once. Encoded words stay in a bounded cache of the Python worker, under the
words themselves.

The vocabulary file is read on the driver and broadcast, with the classes of
all code points (some megabytes, whatever the input).
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text

CACHE_WORDS = 250_000
CACHE_PAIRS = 300_000
BLOCK_CHARS = 1 << 18
# Longer words are not kept from block to block, which bounds the cache.
CACHED_CHARS = 200
# fixed value: how byte-level BPE cuts a text into words before any merge
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary:
    printable Latin-1 stands for itself, the rest follows from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out = {chr(b): b for b in own}
    rest = (b for b in range(256) if b not in set(own))
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


def letter_classes() -> np.ndarray:
    """Of each code point: 1 letter, 2 number, 3 white space, 0 anything else, as
    the tokenizers library sees it. Its Unicode version is not this Python's."""
    from tokenizers import Regex, pre_tokenizers
    out = np.zeros(0x110000, np.uint8)
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for lo in range(0, len(every), 1 << 14):  # the library keeps some hundred bytes a character
        points = np.array(every[lo:lo + (1 << 14)])
        text = "".join(map(chr, points.tolist()))
        for number, pattern in ((1, r"\p{L}+"), (2, r"\p{N}+"), (3, r"\s+")):
            other = np.zeros(len(points) + 1, np.int64)
            for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(text):
                other[a] += 1
                other[b] -= 1
            out[points[np.cumsum(other[:-1]) == 0]] = number
    return out


class Codec:
    """Encoder and decoder of one vocabulary file (tokenizers JSON)."""

    def __init__(self, source: str, classes: np.ndarray, cache_words: int = CACHE_WORDS):
        import regex
        spec = json.loads(source)
        sym = byte_symbols()
        raw = lambda s: bytes(sym[c] for c in s)
        vocab = {raw(t): i for t, i in spec["model"]["vocab"].items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added_cut = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.bytes_of = {i: t for t, i in vocab.items()}
        for t, i in self.added.items():
            self.bytes_of[i] = bytes(sym[c] for c in t) if all(c in sym for c in t) else t.encode()
        # pair of ids -> (rank, merged id); token id -> the pair that makes it
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        self.made: dict[int, tuple[int, int]] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            x, y = m if isinstance(m, list) else m.split(" ")
            a, b = raw(x), raw(y)
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.merge[pair] = (rank, whole)
            self.made.setdefault(whole, pair)
        self.rank = {t: self.merge[p][0] for t, p in self.made.items()}
        # tokens that merging never yields (their own bytes merge otherwise) can't be last
        self.vocab = {t: i for t, i in vocab.items() if len(t) == 1 or self._merged(t, vocab) == [i]}
        self.fits: dict[tuple[int, int], bool] = {}
        # longest token that ends with these three bytes
        self.reach: dict[bytes, int] = {}
        for t in self.vocab:
            if len(t) > 2:
                self.reach[t[-3:]] = max(len(t), self.reach.get(t[-3:], 2))
        # the spelling of all tokens in one array
        top = max(self.bytes_of) + 1
        self.length_of = {i: len(t) for i, t in self.bytes_of.items()}
        self.sizes = np.array([self.length_of.get(i, 0) for i in range(top)], np.int64)
        self.spelled_at = np.cumsum(self.sizes) - self.sizes
        self.spelled = np.frombuffer(b"".join(self.bytes_of.get(i, b"") for i in range(top)), np.uint8)
        self.classes = classes
        self.cache: dict[str, bytes] = {}
        self.cache_words = cache_words

    def _merged(self, word: bytes, vocab: dict[bytes, int]) -> list[int]:
        """Plain merging in rank order, for the vocabulary's own tokens."""
        ids = [vocab[word[i:i + 1]] for i in range(len(word))]
        while len(ids) > 1:
            found = [(self.merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
            if not found:
                break
            rank, k = min(found)
            ids[k:k + 2] = [self.merge[(ids[k], ids[k + 1])][1]]
        return ids

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the bytes of a and b ends in exactly [a, b]: no merge
        across the border may come before those that finish its two sides."""
        known = self.fits.get((a, b))
        if known is not None:
            return known
        x, y, limit, key = a, b, 1 << 60, (a, b)
        ok = True
        while True:
            m = self.merge.get((x, y))
            if m is not None and m[0] < limit:
                ok = False
                break
            # undo the later of the two merges beside the border
            rx, ry = self.rank.get(x, -1), self.rank.get(y, -1)
            if rx < 0 and ry < 0:
                break
            if rx > ry:
                # x's own merge came after y's; before it, x's right half stood at the border
                limit, x = rx, self.made[x][1]
            elif ry > rx:
                # at equal rank the left merge comes first, so a border merge of this rank is too late only here
                limit, y = ry + 1, self.made[y][0]
            else:
                limit, y = ry + 1, self.made[y][0]
        if len(self.fits) > CACHE_PAIRS:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Distinct words -> their ids as packed little-endian 32-bit integers."""
        out = [b""] * len(words)
        path, last = b"", [-1]  # last[d]: last token of the encoding of path[:d]
        vocab, fits, may_follow, reach = self.vocab, self.fits, self.may_follow, self.reach
        for raw, at in sorted((w.encode(), i) for i, w in enumerate(words)):
            shared, top = 0, min(len(path), len(raw))
            while shared < top and path[shared] == raw[shared]:
                shared += 1
            del last[shared + 1:]
            for d in range(shared + 1, len(raw) + 1):
                start = d - reach.get(raw[d - 3:d], 2) if d > 2 else 0
                for start in range(start if start > 0 else 0, d):
                    t = vocab.get(raw[start:d])
                    if t is not None:
                        if not start:
                            break
                        pair = (last[start], t)
                        ok = fits.get(pair)
                        if ok or ok is None and may_follow(*pair):
                            break
                last.append(t)
            path = raw
            ids, d = [], len(raw)
            while d:
                t = last[d]
                ids.append(t)
                d -= self.length_of[t]
            ids.reverse()
            out[at] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def _slow(self, text: str) -> np.ndarray:
        """One text that holds an added token's own string, which is that one token."""
        parts, at = [], 0
        for m in self.added_cut.finditer(text):
            parts += [*self.encode_block([text[at:m.start()]]), np.array([self.added[m.group()]], "<u4")]
            at = m.end()
        return np.concatenate(parts + self.encode_block([text[at:]]))

    def cut(self, cp: np.ndarray, text_start: np.ndarray) -> np.ndarray:
        """Where the words of WORD_PATTERN begin. cp: the code points of some
        texts, one behind the other; text_start: marks the first of each text."""
        cls = self.classes[cp]
        begin = text_start.copy()
        begin[1:] |= cls[1:] != cls[:-1]
        at = np.flatnonzero(begin)
        end = np.append(at[1:], len(cp))
        # white space before more text: its last character stands apart, and
        # goes to the word behind it if it is a plain space
        inner = (cls[at] == 3) & (end < len(cp))
        inner[inner] = ~text_start[end[inner]]
        s, e = at[inner], end[inner]
        begin[e - 1] = True
        begin[e[cp[e - 1] == 32]] = False
        # 's 't 'm 'd 're 've 'll: an apostrophe alone in its run, no space before it
        q = at[(end - at == 1) & (cp[at] == 39) & (end < len(cp))]
        q = q[begin[q]]
        q = q[~text_start[q + 1]]
        if len(q):
            one = np.isin(cp[q + 1], (115, 116, 109, 100))
            has2 = q + 2 < len(cp)
            q2 = np.where(has2, q + 2, q)
            x, y = cp[q + 1], cp[q2]
            two = ~one & has2 & ~text_start[q2] & (((x == 114) | (x == 118)) & (y == 101) | (x == 108) & (y == 108))
            begin[q[one | two] + 1] = False
            stop = np.concatenate([q[one] + 2, q[two] + 3])
            begin[stop[stop < len(cp)]] = True
        return np.flatnonzero(begin)

    def encode_block(self, texts: list[str]) -> list[np.ndarray]:
        """Texts -> their ids. Equal words of the block are looked up once."""
        if any(a in t for a in self.added for t in texts):
            return [self._slow(t) if any(a in t for a in self.added) else self.encode_block([t])[0] for t in texts]
        joined = "".join(texts)
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        first = np.cumsum(size) - size
        if not joined:
            return [np.zeros(0, "<u4") for _ in texts]
        cp = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        text_start = np.zeros(len(cp), bool)
        text_start[first[size > 0]] = True
        start = self.cut(cp, text_start)
        words = list(map(joined.__getitem__, map(slice, start.tolist(), [*start[1:].tolist(), len(cp)])))
        found = list(map(self.cache.get, words))
        new = list({w for w, f in zip(words, found) if f is None})
        if new:
            packed = dict(zip(new, self.encode_words(new)))
            found = [packed[w] if f is None else f for w, f in zip(words, found)]
            if len(self.cache) + len(new) > self.cache_words:
                self.cache.clear()
            self.cache.update((w, f) for w, f in packed.items() if len(w) <= CACHED_CHARS)
        flat = np.frombuffer(b"".join(found), "<u4")
        stop = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        # ids before each text's first word
        before = np.concatenate([[0], stop])[np.searchsorted(start, np.append(first, len(cp)))]
        return [flat[x:y] for x, y in zip(before[:-1].tolist(), before[1:].tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        """Ids -> the decoded text in UTF-8 (bytes that are no character become U+FFFD)."""
        n = self.sizes[ids]
        stop = np.cumsum(n)
        if not len(ids):
            return b""
        raw = self.spelled[np.repeat(self.spelled_at[ids] - (stop - n), n) + np.arange(stop[-1])].tobytes()
        return raw.decode("utf-8", "replace").encode()


_codecs: dict[int, Codec] = {}


def _codec(vocabulary) -> Codec:
    """One codec in a Python worker, whatever the number of its tasks."""
    if vocabulary.value[0] not in _codecs:
        _codecs.clear()
        source, classes = vocabulary.value[1:]
        _codecs[vocabulary.value[0]] = Codec(source, np.frombuffer(zlib.decompress(classes), np.uint8))
    return _codecs[vocabulary.value[0]]


def blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about BLOCK_CHARS characters (or one longer text)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > BLOCK_CHARS:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def _encode(batches: Iterator[pd.DataFrame], vocabulary, with_ids: bool) -> Iterator[pd.DataFrame]:
    codec = _codec(vocabulary)
    for b in batches:
        texts = ["" if t is None else t for t in b["text"]]
        for lo, hi in blocks(texts):
            ids = codec.encode_block(texts[lo:hi])
            out = pd.DataFrame({
                "doc_id": b["doc_id"].iloc[lo:hi].to_numpy(),
                "n_tokens": [len(x) for x in ids],
                "ids_sha256": [hashlib.sha256(x.tobytes()).hexdigest() for x in ids],
                "decoded_sha256": [hashlib.sha256(codec.decode(x)).hexdigest() for x in ids]})
            if with_ids:
                out["ids"] = [x.astype(np.int32) for x in ids]
            yield out


def broadcast_vocabulary(spark, path: str | None = None):
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        source = f.read()
    return spark.sparkContext.broadcast((hashlib.sha256(source.encode()).hexdigest(), source, zlib.compress(letter_classes().tobytes())))


def encode_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]), one row per input row.

    A null text is an empty one: no ids, hashes of nothing. Repeated rows give
    repeated rows; a null doc_id stays null; other columns are ignored; an
    empty table gives an empty result. Texts are encoded whole, in blocks.
    ``path`` names the vocabulary file on the driver.
    """
    kept = ", ids array<int>" if with_ids else ""
    out = (docs.select(as_text("doc_id"), F.col("text").cast("string"))
           .mapInPandas(partial(_encode, vocabulary=broadcast_vocabulary(docs.sparkSession, path), with_ids=with_ids),
                        "doc_id string, n_tokens long, ids_sha256 string, decoded_sha256 string" + kept))
    return out.withColumn("doc_id", as_id("doc_id"))


def _decode(batches: Iterator[pd.DataFrame], vocabulary) -> Iterator[pd.DataFrame]:
    codec = _codec(vocabulary)
    for b in batches:
        texts = [None if i is None else codec.decode(np.asarray(i, np.int64)).decode() for i in b["ids"]]
        yield pd.DataFrame({"doc_id": b["doc_id"], "text": texts})


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids) -> (doc_id, text); null ids give a null text."""
    return encoded.select(as_text("doc_id"), "ids").mapInPandas(
        partial(_decode, vocabulary=broadcast_vocabulary(encoded.sparkSession, path)),
        "doc_id string, text string").withColumn("doc_id", as_id("doc_id"))
