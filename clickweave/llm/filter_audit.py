"""Interaction of document filters, from relations of failing ids.

Every filter has its table of the rows that fail it. The survivors of each set
of filters that may come first in an order are found for all sets at once:
filter by filter, a row that may yet survive stands for the sets without the
filter and for those with it, and a left-anti join with the filter's table
takes the latter away from rows that fail. Only rows that fail some filter go
through these joins; all others survive every set. Left-semi joins of the
survivors with the tables give what the next filter removes, left-anti joins
of the tables with the removed rows give what an earlier filter had removed
already. A filter removes the same rows wherever the set before it is the
same, so orders are looked up, not run.
"""

from __future__ import annotations

import uuid
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpoint
from clickweave.session import scratch_path

# A text with more than this share of the rows goes to the others by broadcast;
# there are fewer than 1 / HOT_SHARE of them.
HOT_SHARE = 0.001
MAX_FILTERS = 6
# fixed values of the five filters
MIN_WORDS, DISTINCT_PERCENT, UPPER_PERCENT = 100, 80, 10
SYMBOLS = r"[#$%&*|]"
WHITE = r"[\x20\x09-\x0D]+"


def default_filters(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails, by filter; the fifth filter,
    repeated texts, comes from ``repeats``."""
    words = F.array_remove(F.split(text, WHITE, -1), "")
    upper = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {"A": F.size(words) < MIN_WORDS,
            "B": 100 * F.size(F.array_distinct(words)) < DISTINCT_PERCENT * F.size(words),
            "C": 100 * upper.cast("long") > UPPER_PERCENT * F.char_length(text),
            "D": text.rlike(SYMBOLS)}


def repeats(rows: DataFrame) -> DataFrame:
    """(row_id) of the rows (row_id, doc_id, digest) whose text a smaller doc_id
    has too. The copies of one text may be any share of the rows."""
    r = rows.where("doc_id is not null")
    texts = checkpoint(r.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
                       .where("last > first"))
    many = F.col("n") > HOT_SHARE * rows.count()
    hot, cold = texts.where(many).select("digest", "first"), texts.where(~many).select("digest", "first")
    r = r.join(F.broadcast(hot.withColumnRenamed("first", "hot_first")), "digest", "left")
    few = r.where("hot_first is null").join(cold, "digest").where("doc_id > first")
    return r.where("doc_id > hot_first").select("row_id").union(few.select("row_id"))


class Failing:
    """The stored tables: ``rows`` (row_id, part, good, toxic) of all documents,
    and for each filter the ids of the rows that fail it."""

    def __init__(self, docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None,
                 repeated: str | None = "E"):
        spark = docs.sparkSession
        base = scratch_path(spark, f"filters-{uuid.uuid4().hex}")
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        fails = default_filters(text) if filters is None else filters
        self.names = [*fails, *([repeated] if repeated else [])]
        if not 1 <= len(self.names) <= MAX_FILTERS:
            raise ValueError(f"between 1 and {MAX_FILTERS} filters")
        d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                        F.unhex(F.sha2(text, 256)).alias("digest"),
                        *[F.coalesce(c, F.lit(False)).alias(f"fails_{n}") for n, c in fails.items()])
        # written once, so that the number of a row stays
        d.withColumn("row_id", F.monotonically_increasing_id()).write.parquet(f"{base}/rows")
        every = spark.read.parquet(f"{base}/rows")
        for n in fails:
            every.where(f"fails_{n}").select("row_id").write.parquet(f"{base}/failing/filter={n}")
        if repeated:
            repeats(every.select("row_id", "doc_id", "digest")).write.parquet(f"{base}/failing/filter={repeated}")
        self.tables = {n: spark.read.schema("row_id long").parquet(f"{base}/failing/filter={n}") for n in self.names}
        self.every = every.select("row_id", "doc_id", "part")
        known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
            F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
            F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")).where("good + toxic > 0")
        ids = reduce(DataFrame.union, self.tables.values()).distinct()
        some = self.every.join(ids, "row_id", "left_semi").join(known, "doc_id", "left")
        self.rows = checkpoint(some.select("row_id", "part", F.coalesce("good", F.lit(0)).alias("good"),
                                           F.coalesce("toxic", F.lit(0)).alias("toxic")))

    def bit(self, name: str) -> int:
        return 1 << self.names.index(name)

    def survivors(self) -> DataFrame:
        """(row_id, part, good, toxic, before): rows that fail some filter, with
        each set of filters (a bit for each) that all the same leaves them."""
        s = self.rows.withColumn("before", F.lit(0))
        for n in self.names:
            bit = self.bit(n)
            s = s.withColumn("before", F.explode(F.array(F.col("before"), F.col("before").bitwiseOR(bit))))
            failing = self.tables[n].withColumnRenamed("row_id", "failing")
            s = s.join(failing, (F.col("row_id") == F.col("failing")) & (F.col("before").bitwiseAND(bit) != 0), "left_anti")
        return s

    def removed(self, survivors: DataFrame, name: str) -> DataFrame:
        """(row_id, part, good, toxic, before): what this filter removes behind
        each set of others."""
        without = survivors.where(F.col("before").bitwiseAND(self.bit(name)) == 0)
        return without.join(self.tables[name], "row_id", "left_semi")

    def redundant(self, removed: DataFrame, name: str) -> DataFrame:
        """(row_id, part, before): rows that fail this filter, with the sets of
        others that had removed them already."""
        sets = [m for m in range(1, 1 << len(self.names)) if not m & self.bit(name)]
        f = self.rows.select("row_id", "part").join(self.tables[name], "row_id", "left_semi")
        f = f.withColumn("before", F.explode(F.array(*map(F.lit, sets)))) if sets else f.withColumn("before", F.lit(0)).where("false")
        return f.join(removed.select("row_id", "before"), ["row_id", "before"], "left_anti")

    def unique(self, name: str) -> DataFrame:
        """(row_id, part): rows that fail this filter alone."""
        f = self.rows.select("row_id", "part").join(self.tables[name], "row_id", "left_semi")
        for other in self.names:
            if other != name:
                f = f.join(self.tables[other], "row_id", "left_anti")
        return f


def interactions(failing: Failing) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(part, before, kept), (part, filter, before, removed, good_lost, toxic_lost,
    redundant) and (part, filter, unique_fails), counts of rows; groups of no rows
    are left out, and ``kept`` counts only rows that fail some filter."""
    s = checkpoint(failing.survivors())
    kept = s.groupBy("part", "before").agg(F.count("*").alias("kept"))
    steps, alone = [], []
    for n in failing.names:
        gone = failing.removed(s, n)
        counts = [gone.select("part", "before", F.lit(1).alias("removed"), "good", "toxic", F.lit(0).alias("redundant")),
                  failing.redundant(gone, n).select("part", "before", F.lit(0), F.lit(0), F.lit(0), F.lit(1))]
        steps.append(reduce(DataFrame.union, counts).groupBy("part", F.lit(n).alias("filter"), "before").agg(
            F.sum("removed").alias("removed"), F.sum("good").alias("good_lost"), F.sum("toxic").alias("toxic_lost"),
            F.sum("redundant").alias("redundant")))
        alone.append(failing.unique(n).groupBy("part", F.lit(n).alias("filter")).agg(F.count("*").alias("unique_fails")))
    return kept, reduce(DataFrame.union, steps), reduce(DataFrame.union, alone)


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column] | None = None, repeated: str | None = "E") -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley): one row for each part, order of the filters
    and step in it, zeros included.

    ``filters``: conditions under which a row of ``docs`` (doc_id, text, lang and
    any others) fails, by one-letter name; null is false. ``repeated`` names one
    more, which fails texts that a smaller doc_id has too (None: no such filter).
    A null text is an empty one, a null lang the part ''. Every row is a document
    of its own, also rows of one doc_id or equal ones; rows with a null doc_id
    repeat none and are repeated by none, and have no label. A document is good
    or toxic if any of its labels says so. Other columns are ignored. An empty
    table has no parts and gives an empty result.
    """
    f = Failing(docs, labels, filters, repeated)
    k = len(f.names)
    total = f.every.groupBy("part").agg(F.count("*").alias("total"))
    some = f.rows.groupBy("part").agg(F.count("*").alias("some"))
    clean = total.join(some, "part", "left").select("part", (F.col("total") - F.coalesce("some", F.lit(0))).alias("clean"))
    kept, steps, alone = interactions(f)
    share = F.element_at(F.array(*[F.lit(factorial(i) * factorial(k - 1 - i)) for i in range(k)]), (F.bit_count("before") + 1).cast("int"))
    steps = checkpoint(steps)
    shapley = steps.groupBy("part", "filter").agg(F.sum(F.col("removed") * share).alias("shapley"))
    plan = []
    for order in permutations(f.names):
        before = 0
        for i, n in enumerate(order):
            plan.append(("".join(order), i + 1, n, before, before | f.bit(n)))
            before |= f.bit(n)
    # k * k! rows, set by the number of filters
    spark = docs.sparkSession
    rows = spark.createDataFrame([(i, *p) for i, p in enumerate(plan)], "i int, filter_order string, step int, filter string, before int, after int")
    out = clean.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(len(plan) - 1)))).join(F.broadcast(rows), "i").drop("i")
    out = out.join(steps, ["part", "filter", "before"], "left").join(
        kept.select("part", F.col("before").alias("after"), "kept"), ["part", "after"], "left")
    out = out.join(alone, ["part", "filter"], "left").join(shapley, ["part", "filter"], "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select("part", "filter_order", "step", (F.col("clean") + F.coalesce("kept", F.lit(0))).alias("kept"),
                      *map(count, ["removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]))
