"""Benchmark decontamination with a positional inverted index.

The words of the training texts that also are words of a benchmark item are
stored as postings (term, document, position). A benchmark window is looked up
from its rarest terms: the postings of its two rarest terms, each moved back
by the term's offset in the window, are intersected, which leaves the places
(document, start) where the window may stand; the words there are then
compared. The same lists, joined within a distance instead of exactly, give
proximity matches.

Everything is DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from clickweave.llm.common import ascii_lower, checkpoint
from clickweave.session import scratch_path

WINDOW_WORDS = 10
# Tables of benchmark terms and windows are broadcast up to this many rows
# (counted first); beyond it the same joins shuffle.
BROADCAST_ROWS = 500_000
# fixed value: ASCII characters that are no part of a word
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text (null: none); A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), NO_WORD, -1), "")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, dk): dk is a 64-bit hash of both. Two documents with one
    hash would share candidate places, which the comparison of words sorts out."""
    d = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return d.withColumn("dk", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.coalesce("text", F.lit(""))))


def windows(benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(wid, words, items): the distinct windows with the ids, as strings, of the
    items that hold them. An item of fewer words, but not none, is one window.
    Items with a null id have windows that hit, but no id to report."""
    w = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where("size(w) > 0")
    w = w.select("item", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (size - 1)))).alias("s"))
    w = w.select("item", F.slice("w", F.col("s"), size).alias("words"))
    w = w.groupBy("words").agg(F.collect_set("item").alias("items"))
    return w.select(F.xxhash64(F.concat_ws(" ", "words")).alias("wid"), "words", "items")


def sized(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def write_postings(docs: DataFrame, terms: DataFrame, n_terms: int, path: str) -> DataFrame:
    """The index: (term, dk, pos) of every place of the given terms (term, word),
    written to ``path``."""
    spark = docs.sparkSession
    tokens = keyed(docs).select("dk", F.posexplode(words(F.col("text"))).alias("pos", "word"))
    tokens.join(sized(terms, n_terms), "word").select("term", "dk", "pos").write.parquet(path)
    return spark.read.parquet(path)


def rarest(win: DataFrame, postings: DataFrame, terms: DataFrame, k: int) -> DataFrame:
    """(wid, rank, term, offset): the k rarest distinct terms of each window by
    their number of postings, each at its first offset."""
    df = terms.join(postings.groupBy("term").agg(F.count("*").alias("n")), "term", "left").select(
        "term", "word", F.coalesce("n", F.lit(0)).alias("n"))
    at = win.select("wid", F.posexplode("words").alias("offset", "word"))
    at = at.groupBy("wid", "word").agg(F.min("offset").alias("offset")).join(df, "word")
    rank = F.row_number().over(W.partitionBy("wid").orderBy("n", "term"))
    return at.withColumn("rank", rank).where(F.col("rank") <= k).select("wid", "rank", "term", "offset")


class Index:
    """Windows of a benchmark and the postings of their terms in ``docs``."""

    def __init__(self, docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS):
        self.windows = checkpoint(windows(benchmark, size))
        self.n_windows = self.windows.count()
        words_used = self.windows.select(F.explode("words").alias("word")).distinct()
        self.terms = checkpoint(words_used.select(F.xxhash64("word").alias("term"), "word"))
        # columns compress well, so the index is a table in the shared folder
        self.path = scratch_path(docs.sparkSession, f"postings-{uuid.uuid4().hex}")
        self.postings = write_postings(docs, self.terms, self.terms.count(), self.path)
        self.anchors = checkpoint(rarest(self.windows, self.postings, self.terms, 2))

    def drop(self) -> None:
        """Deletes the postings; what was computed from them must be written by then."""
        path = self.postings.sparkSession._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.postings.sparkSession._jsc.hadoopConfiguration()).delete(path, True)

    def starts(self, rank: int) -> DataFrame:
        """(wid, dk, start): postings of each window's rarest (rank 1) or second
        rarest (2) term, moved back by the term's offset."""
        a = self.anchors.where(F.col("rank") == rank).select("wid", "term", "offset")
        return (self.postings.join(sized(a, self.n_windows), "term")
                .select("wid", "dk", (F.col("pos") - F.col("offset")).alias("start")))

    def candidates(self) -> DataFrame:
        """(wid, dk, start) where both rarest terms are in place; windows of one
        distinct term have only the one list."""
        alone = self.anchors.groupBy("wid").agg(F.max("rank").alias("r")).where("r = 1").select("wid")
        one = self.starts(1).where("start >= 0")
        two = self.starts(2).where("start >= 0")
        both = one.join(two, ["wid", "dk", "start"], "left_semi")
        return both.union(one.join(sized(alone, self.n_windows), "wid", "left_semi")).distinct()

    def proximity(self, slop: int) -> DataFrame:
        """(wid, dk, start, gap): windows whose two rarest terms stand in a
        document as far apart as in the window, give or take 1 to ``slop`` words
        (exact places are ``candidates``). Only neighbouring cells of slop + 1
        starts meet, never all places of a document."""
        cell = F.floor(F.col("start") / (slop + 1))
        one = self.starts(1).withColumn("cell", F.explode(F.array(cell - 1, cell, cell + 1)))
        two = self.starts(2).withColumn("cell", cell).withColumnRenamed("start", "other")
        met = one.join(two, ["wid", "dk", "cell"]).withColumn("gap", F.abs(F.col("start") - F.col("other")))
        return met.where((F.col("gap") >= 1) & (F.col("gap") <= slop)).groupBy("wid", "dk", "start").agg(F.min("gap").alias("gap"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(row, n_words, n_hit, item_ids, spans, contaminated), one row per input
    row; ``row`` is a struct of the input's columns, whatever their names.

    spans: array of (start, length) in words of the windows found; n_hit: the
    words inside any of them; item_ids: the sorted ids of their items. A null
    or empty text has no words and no hits. Repeated rows all get the same
    result; a null doc_id is a document like any other. An empty benchmark hits
    nothing, empty documents give an empty result.
    """
    ix = Index(docs, benchmark, size)
    places = checkpoint(ix.candidates())
    ix.drop()
    found = places.join(sized(ix.windows, ix.n_windows), "wid")
    found = found.groupBy("dk").agg(F.collect_list(F.struct("start", "words", "items")).alias("places"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row.text").cast("string")
    dk = F.xxhash64(F.coalesce(F.col("row.doc_id").cast("long").cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    met = rows.withColumn("dk", dk).join(found, "dk", "left").withColumn("w", words(text))
    good = F.filter(F.coalesce("places", F.array()),
                    lambda p: F.slice(F.col("w"), p["start"] + 1, F.size(p["words"])) == p["words"])
    met = met.select("row", F.size("w").cast("long").alias("n_words"), F.when(F.col("places").isNotNull(), good).alias("good"))
    spans = F.transform("good", lambda p: F.struct(p["start"].alias("start"), F.size(p["words"]).alias("length")))
    hit = F.array_distinct(F.flatten(F.transform("good", lambda p: F.sequence(p["start"], p["start"] + F.size(p["words"]) - 1))))
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("good", lambda p: p["items"]))))
    out = met.select("row", "n_words", spans.alias("spans"),
                     F.coalesce(F.size(hit), F.lit(0)).cast("long").alias("n_hit"),
                     F.coalesce(items, F.array().cast("array<string>")).alias("item_ids"))
    return out.withColumn("n_hit", F.greatest("n_hit", F.lit(0))).withColumn("contaminated", F.col("n_hit") > 0)
