"""A corpus pipeline of five stages over the ``documents`` table.

Every stage takes (spark, docs, sf_dir), works on all rows the one before it
kept, and returns a DataFrame; ``run`` writes each stage's result as Parquet
into the shared folder and reads it back as the next one's input. All stages
but the last return the columns of ``documents``.

In every stage a null text is an empty one: it is not toxic, has one empty line
(which stays), is linked with other texts without words, holds no benchmark
window and has no tokens. Rows with a null doc_id are documents that no stage
drops as copies. Repeated rows get the same decision; rows of one doc_id with
different texts are dropped as copies only together. Other columns than those of
``documents`` are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import bpe, decontaminate, line_dedup, simhash, toxicity
from clickweave.llm.common import table
from clickweave.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go. Labels come from the labels table."""
    return toxicity.classify(docs, table(spark, sf_dir, "labels")).where("predicted = 0").select("row.*").select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten documents or more go; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs.select(COLUMNS))
    return out.select("row.doc_id", F.col("kept").alias("text"), "row.lang", "row.source",
                      F.char_length("kept").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each SimHash group stays."""
    return simhash.one_of_each(docs.select(COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    out = decontaminate.decontaminate(docs.select(COLUMNS), table(spark, sf_dir, "benchmark"))
    return out.where("not contaminated").select("row.*").select(COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of what is left."""
    return bpe.encode_decode(docs)


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_repeated_lines), ("simhash", drop_near_copies),
          ("decontamination", drop_leaks), ("bpe", tokenize)]

# The toxicity model and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}/{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
