"""Line dedup over range-partitioned line hashes.

Every line becomes a 128-bit hash of its key with its document and position;
the text stays where it is. The hashes are range-partitioned by (hash,
document) and sorted within partitions by (hash, document, position), so a
line found in a third of all documents is spread over many partitions and a
document's repeats of a line meet in one. Each partition streams its runs of
equal hashes, counts their documents and hands out the positions to drop. A
run at the edge of a partition may go on in the next one: its rows are kept
open, and the counts of edge runs (two a partition at most) are added up and
decide them. What comes back is one compressed keep bitmap per document.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ascii_lower, checkpoint, key128, shuffle_partitions

MIN_DOCUMENTS = 10
MIN_CHARS = 1
WHITE = " \t\n\x0b\x0c\r"


def document_key(docs: DataFrame) -> DataFrame:
    """(doc_id, text, dk): dk is a hash of both, so rows equal in both share one
    bitmap and other rows never do. A null text is an empty one."""
    d = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return d.withColumn("dk", key128(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")))


def line_hashes(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(h1, h2, doc, pos, n, d1, d2): one row per line whose key has at least
    ``min_chars`` code points; n is the number of the document's lines."""
    rows = (document_key(docs)
            .select("dk", F.coalesce("doc_id", F.lit(-2**63)).alias("doc"), F.split("text", "\n", -1).alias("lines"))
            .select("dk", "doc", F.size("lines").alias("n"), F.posexplode("lines").alias("pos", "line")))
    key = ascii_lower(F.trim(F.col("line"), F.lit(WHITE)))
    rows = rows.select("dk", "doc", "n", "pos", key.alias("key")).where(F.char_length("key") >= min_chars)
    rows = rows.withColumn("h", key128(F.col("key")))
    return rows.select(F.col("h.a").alias("h1"), F.col("h.b").alias("h2"), "doc", "pos", "n",
                       F.col("dk.a").alias("d1"), F.col("dk.b").alias("d2"))


STREAMED = "kind byte, h1 long, h2 long, pos int, n int, d1 long, d2 long, docs long, part int, head boolean"


def _stream(batches: Iterator[pd.DataFrame], min_docs: int, keep_first: bool) -> Iterator[pd.DataFrame]:
    """One sorted range partition. kind 0: a line to drop; kind 1: a line of an
    edge run, still open; kind 2: the number of documents of an edge run."""
    from pyspark import TaskContext
    place = TaskContext.get().partitionId()
    run = None  # the run that may go on in the next batch
    started = False

    def rows(kind, part, head):
        return part[["h1", "h2", "pos", "n", "d1", "d2"]].assign(
            kind=np.int8(kind), docs=0, part=np.int32(place), head=head)

    def feed(part, n_docs, begins):
        run["docs"] += n_docs
        run["last"] = part["doc"].iat[-1]
        head = np.zeros(len(part), bool)
        head[0] = begins
        run["parts"].append((part, head))
        if run["edge"] or run["docs"] >= min_docs:
            for p, h in run["parts"]:
                if run["edge"]:
                    yield rows(1, p, h)
                else:
                    yield rows(0, p[~h], False) if keep_first else rows(0, p, False)
            run["parts"] = []

    def close(at_end):
        if at_end:
            for p, h in run["parts"]:
                yield rows(1, p, h)
        if at_end or run["edge"]:
            yield pd.DataFrame({"kind": [2], "h1": [run["key"][0]], "h2": [run["key"][1]], "pos": [0], "n": [0],
                                "d1": [0], "d2": [0], "docs": [run["docs"]], "part": [place], "head": [False]})

    for b in batches:
        if not len(b):
            continue
        h1, h2, doc = (b[c].to_numpy() for c in ("h1", "h2", "doc"))
        change = np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])])
        new_doc = change | np.concatenate([[True], doc[1:] != doc[:-1]])
        start = np.flatnonzero(change)
        end = np.append(start[1:], len(b))
        n_docs = np.add.reduceat(new_doc.astype(np.int64), start)
        at = 0
        if run is not None and run["key"] == (h1[0], h2[0]):
            yield from feed(b.iloc[:end[0]], int(n_docs[0]) - int(run["last"] == doc[0]), False)
            at = 1
        if at == len(start):
            continue
        if run is not None:
            yield from close(False)
        if not started:  # the partition's first run may have begun in the one before
            run = {"key": (h1[0], h2[0]), "docs": 0, "last": None, "edge": True, "parts": []}
            started = True
            yield from feed(b.iloc[:end[0]], int(n_docs[0]), True)
            at = 1
            if at == len(start):
                continue
            yield from close(False)
        inner = np.arange(at, len(start) - 1)
        inner = inner[n_docs[inner] >= min_docs]
        if len(inner):
            mark = np.zeros(len(b) + 1, np.int64)
            mark[start[inner] + int(keep_first)] += 1
            np.add.at(mark, end[inner], -1)
            yield rows(0, b[np.cumsum(mark[:-1]) > 0], False)
        k = start[-1]
        run = {"key": (h1[k], h2[k]), "docs": 0, "last": None, "edge": False, "parts": []}
        yield from feed(b.iloc[k:], int(n_docs[-1]), True)
    if run is not None:
        yield from close(True)


def _bitmaps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        maps = []
        for n, gone in zip(b["n_lines"], b["gone"]):
            keep = np.ones(n, bool)
            keep[np.asarray(gone, np.int64)] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield b[["d1", "d2", "n_lines"]].assign(n_dropped=b["gone"].map(len), bitmap=maps)


def keep_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS,
                 keep_first: bool = False) -> DataFrame:
    """(d1, d2, n_lines, n_dropped, bitmap) of the documents that lose lines.

    A line whose key is found in ``min_docs`` documents or more loses all its
    places, or all but the first by (doc_id, position) with ``keep_first``
    (``min_docs=1`` then is plain dedup of lines). Rows of one doc_id count as
    one document. The bitmap is a zlib-compressed string of bits, 1: stays.
    """
    lines = line_hashes(docs, min_chars)
    lines = (lines.repartitionByRange(shuffle_partitions(docs.sparkSession), "h1", "h2", "doc")
             .sortWithinPartitions("h1", "h2", "doc", "pos"))
    out = checkpoint(lines.mapInPandas(partial(_stream, min_docs=min_docs, keep_first=keep_first), STREAMED))
    # at most two rows for each partition
    edge = out.where("kind = 2").groupBy("h1", "h2").agg(F.sum("docs").alias("all_docs"), F.min("part").alias("first"))
    opened = out.where("kind = 1").join(F.broadcast(edge), ["h1", "h2"]).where(F.col("all_docs") >= min_docs)
    if keep_first:
        opened = opened.where("not (head and part = first)")
    cols = ["d1", "d2", "n", "pos"]
    gone = out.where("kind = 0").select(cols).union(opened.select(cols))
    return gone.groupBy("d1", "d2").agg(F.max("n").alias("n_lines"), F.collect_set("pos").alias("gone")).mapInPandas(
        _bitmaps, "d1 long, d2 long, n_lines int, n_dropped int, bitmap binary")


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), count=n_lines).astype(bool)


def _kept(text: pd.Series, bitmap: pd.Series) -> pd.Series:
    out = []
    for t, m in zip(text, bitmap):
        if t is None or m is None:
            out.append(None)
        else:
            lines = t.split("\n")
            out.append("\n".join(x for x, k in zip(lines, unpack(m, len(lines))) if k))
    return pd.Series(out, dtype=object)


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS,
                keep_first: bool = False) -> DataFrame:
    """(row, kept, n_lines, n_dropped), one row per input row: ``row`` is a
    struct of the input's columns, whatever their names, and ``kept`` its text
    without the dropped lines.

    A null or empty text is one empty line, which never is dropped while
    ``min_chars`` is 1 or more. Repeated rows are one document and all get the
    same result; a null doc_id is a document like any other. An empty table
    gives an empty result.
    """
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row.text").cast("string"), F.lit(""))
    dk = key128(F.coalesce(F.col("row.doc_id").cast("long").cast("string"), F.lit("")), text)
    keyed = keyed.withColumn("dk", dk).select("row", F.col("dk.a").alias("d1"), F.col("dk.b").alias("d2"))
    met = keyed.join(keep_bitmaps(docs, min_docs, min_chars, keep_first), ["d1", "d2"], "left")
    cut = F.pandas_udf(_kept, "string")(F.when(F.col("bitmap").isNotNull(), text), F.col("bitmap"))
    return met.select(
        "row", F.when(F.col("bitmap").isNull(), text).otherwise(cut).alias("kept"),
        (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"))
