"""URL filter: allow and block rules, and gradient-boosted trees for the rest.

A rule decides the URLs of its host and all subdomains whose path starts with
the rule's path; the longest fitting rule wins. The URLs that rules decide are
the labelled ones: boosted trees learn from a bounded sample of them, weighted
for what it stands for, and judge the others by lexical features (lengths,
depth, digit ratio, entropy, parameter counts, and statistics of the host's
suffix). The statistics are counted over all labelled URLs; a URL that is learned
from does not count in its own.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import as_id, as_text, ascii_lower, bounded_sample, checkpoint
from clickweave.operators.lookup import lookup

RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
# Bound of the training sample, for each verdict.
SAMPLE = 8000
TREES, DEPTH, SEED = 12, 4, 5
FEATURES = ("url_chars", "host_chars", "path_chars", "query_chars", "labels", "depth", "digit_ratio", "hyphens",
            "entropy", "parameters", "has_fragment", "is_https")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://`` up to / ? # or the end, A-Z lower-cased) and
    path (from there up to ? # or the end); both empty for a null or no ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    part = lambda n: F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)([^?#]*)", n)
    return ascii_lower(part(1)), part(2)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict), null where none fits. Of equally long rules the
    smallest text wins; of the same rule twice, a block."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, v in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]], r[1] == "block")):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def _lexical(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for url, host, path in zip(b["url"], b["host"], b["path"]):
            url = url or ""
            n = max(len(url), 1)
            query = url.partition("#")[0].partition("?")[2]
            counts = Counter(url).values()
            rows.append([
                float(len(url)), float(len(host)), float(len(path)), float(len(query)),
                float(host.count(".") + bool(host)), float(sum(map(bool, path.split("/")))),
                sum(c.isdigit() for c in url) / n, float(url.count("-")),
                -sum(k / n * math.log2(k / n) for k in counts), float(sum(map(bool, query.split("&")))),
                float("#" in url), float(url[:8].lower() == "https://")])
        yield b.assign(lexical=rows)


def with_features(judged: DataFrame) -> DataFrame:
    """Adds ``lexical``, the FEATURES of each url, and ``suffix``, the host's last label."""
    rows = judged.withColumn("page_id", as_text("page_id"))
    out = rows.mapInPandas(_lexical, ", ".join(f"{n} {t}" for n, t in rows.dtypes) + ", lexical array<double>")
    return out.withColumn("page_id", as_id("page_id")).withColumn("suffix", F.substring_index("host", ".", -1))


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(suffix, k, b): labelled URLs of each last label of a host, and blocked ones."""
    return labelled.groupBy(F.substring_index("host", ".", -1).alias("suffix")).agg(
        F.count("*").alias("k"), F.sum((F.col("verdict") == "block").cast("int")).alias("b"))


def train(labelled: DataFrame):
    """labelled: (page_id, url, host, path, verdict). (model, counts of all
    suffixes), or the only verdict there is, or None.

    At most SAMPLE URLs of each verdict are learned from, by a hash of id and
    URL; their weights make up for the different rates of the verdicts."""
    verdicts = [r[0] for r in labelled.select("verdict").distinct().collect()]
    if len(verdicts) < 2:
        return verdicts[0] if verdicts else None
    suffixes = checkpoint(suffix_counts(labelled))
    sample = checkpoint(with_features(bounded_sample(labelled, "verdict", ["page_id", "url"], SAMPLE)))
    drawn = {r[0]: r[1] for r in sample.groupBy("verdict").count().collect()}
    block = (F.col("verdict") == "block").cast("int")
    least = sample.select((F.col("rows_") / F.when(block == 1, drawn["block"]).otherwise(drawn["allow"])).alias("w"), "verdict")
    least = least.agg(F.min("w")).first()[0]
    weight = F.col("rows_") / F.when(block == 1, drawn["block"]).otherwise(drawn["allow"]) / least
    rows = assembled(sample, suffixes, F.lit(1), block).select("features", block.cast("double").alias("label"), weight.alias("weight"))
    rows = rows.coalesce(max(1, sum(drawn.values()) // 4000)).persist()
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(rows)
    rows.unpersist()
    return model, suffixes


def assembled(rows: DataFrame, suffixes: DataFrame, own: Column | None = None, own_block: Column | None = None) -> DataFrame:
    """Adds the feature vector; a suffix that no labelled URL has, none but the
    row itself with ``own`` and ``own_block``, has neutral statistics."""
    zero = F.lit(0)
    met = lookup(checkpoint(rows), suffixes, "suffix", how="left")
    k = F.coalesce("k", zero) - (zero if own is None else own)
    b = F.coalesce("b", zero) - (zero if own_block is None else own_block)
    return met.withColumn("features", array_to_vector(F.concat("lexical", F.array(F.log1p(k.cast("double")), (b + 1) / (k + 2))))).drop("k", "b")


def judge(pages: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score), one row per input row.

    verdict is the rule's, else block if the trees' probability of a block
    (score; null where a rule decided) is ``threshold`` or more. If the rules
    decide no URL, the others are allowed; if all they decide have one
    verdict, the others get that verdict. A null or empty URL, or one without
    ``://``, has an empty host and path, fits no rule and is judged by its
    features. Repeated rows give repeated rows; other columns are ignored; an
    empty table gives an empty result.
    """
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    host, path = host_and_path(F.col("url"))
    p = p.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    p = p.withColumn("rule", rule).withColumn("verdict", verdict)
    learned = train(p.where(F.col("rule").isNotNull()).select("page_id", "url", "host", "path", "verdict"))
    if learned is None or isinstance(learned, str):
        return p.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(learned or "allow")).alias("verdict"),
                        F.lit(None).cast("double").alias("score"))
    model, suffixes = learned
    decided = p.where(F.col("rule").isNotNull()).withColumn("score", F.lit(None).cast("double"))
    rest = model.transform(assembled(with_features(p.where(F.col("rule").isNull())), suffixes))
    rest = rest.withColumn("score", vector_to_array("probability")[1]).withColumn(
        "verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    cols = ["page_id", "host", "path", "rule", "verdict", "score"]
    return decided.select(cols).unionByName(rest.select(cols))
