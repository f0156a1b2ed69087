"""The operators as queries over the test tables, with DuckDB SQL where it can
express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm import (bpe, conversation_trie, decontaminate, embedding_join, filter_audit, language, line_dedup, phrases,
                            quality, simhash, toxicity, urls, warc)
from clickweave.llm.common import table


def op1_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                      table(spark, sf_dir, "benchmark"))
    return out.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit",
                      F.size("item_ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"), "contaminated")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a replica with known damage, so that there is something to find
    return warc.audit_damaged_copy(table(spark, sf_dir, "pages"), F.expr("page_id % 97 = 13"), F.expr("page_id % 97 = 29"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.edited_pairs(table(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_embedding_join, op2_simhash, op3_bpe, op4_toxicity, op5_quality, op6_line_dedup,
                              op7_decontaminate, op8_warc, op9_language, op10_urls, op11_filter_audit, op12_phrases,
                              op13_conversation_trie)}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower_sql(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_UPPER.lower()}')"


# Every pair is compared, which only small tables allow.
_EMBEDDINGS_SQL = """
WITH RECURSIVE vec AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
usable AS (
  SELECT vec_id, v FROM vec
  WHERE v IS NOT NULL AND len(v) > 0 AND len([x for x in v if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in v if x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b
  ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (
  SELECT x, y FROM link
  UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
lowest AS (SELECT x AS vec_id, min(y) AS low FROM reach GROUP BY x),
degree AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
       vec_id <= coalesce(low, vec_id) AS kept
FROM vec LEFT JOIN lowest USING (vec_id) LEFT JOIN degree USING (vec_id)"""

_LINES_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, {_lower_sql("trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM lines),
repeated AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_DOCUMENTS})
SELECT doc_id, count(*) AS n_lines, count(repeated.key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE repeated.key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN repeated ON keyed.key = repeated.key GROUP BY doc_id"""


def _words_sql(text: str) -> str:
    return f"[x for x in string_split_regex({_lower_sql(text)}, '{decontaminate.NO_WORD}') if x <> '']"


_LEAKS_SQL = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words_sql("coalesce(text, '')")} AS w FROM benchmark),
placed AS (
  SELECT item, w, unnest(range(1, greatest(1, len(w) - {decontaminate.WINDOW_WORDS - 1}) + 1)) AS s
  FROM item WHERE len(w) > 0),
wanted AS (
  SELECT DISTINCT item, w[s:s + {decontaminate.WINDOW_WORDS - 1}] AS words FROM placed),
lengths AS (SELECT DISTINCT len(words) AS n FROM wanted),
doc AS (SELECT doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
place AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM doc JOIN lengths ON len(w) >= n),
found AS (
  SELECT doc_id, s, n, item FROM place JOIN wanted ON w[s:s + n - 1] = words),
inside AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found WHERE item IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN inside USING (doc_id) LEFT JOIN named USING (doc_id)"""

_FILTERS_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         [x for x in string_split_regex(coalesce(text, ''), '{filter_audit.WHITE}') if x <> ''] AS w
  FROM documents),
judged AS (
  SELECT doc_id, part,
         len(w) < {filter_audit.MIN_WORDS} AS a, 100 * len(list_distinct(w)) < {filter_audit.DISTINCT_PERCENT} * len(w) AS b,
         100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > {filter_audit.UPPER_PERCENT} * length(text) AS c,
         regexp_matches(text, '{filter_audit.SYMBOLS}') AS d,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM words),
known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
cell AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS fails, count(*) AS n,
         count(*) FILTER (WHERE good = 1) AS good, count(*) FILTER (WHERE toxic = 1) AS toxic
  FROM judged LEFT JOIN known USING (doc_id) GROUP BY 1, 2),
filters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
  SELECT '' AS filter_order, 0 AS used
  UNION ALL SELECT filter_order || f, used + bit FROM orders, filters WHERE used & bit = 0),
steps AS (
  SELECT o.filter_order, i AS step, bit,
         (SELECT coalesce(sum(p.bit), 0) FROM filters p WHERE instr(o.filter_order, p.f) < i) AS before
  FROM (SELECT filter_order FROM orders WHERE used = 31) o, range(1, 6) r(i), filters
  WHERE f = substr(o.filter_order, i, 1)),
counted AS (
  SELECT c.part, s.filter_order, s.step, s.bit,
         sum(n) FILTER (WHERE fails & (before::INT | bit) = 0) AS kept,
         sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before::INT = 0) AS removed,
         sum(n) FILTER (WHERE fails & bit <> 0 AND fails & before::INT <> 0) AS redundant,
         sum(n) FILTER (WHERE fails = bit) AS unique_fails,
         sum(good) FILTER (WHERE fails & bit <> 0 AND fails & before::INT = 0) AS good_lost,
         sum(toxic) FILTER (WHERE fails & bit <> 0 AND fails & before::INT = 0) AS toxic_lost
  FROM cell c, steps s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM counted"""

# Ancestors come from the prefixes of a node's smallest member. DuckDB has no
# crc32, so its table is made from the polynomial.
_TRIE_SQL = """
WITH RECURSIVE crc_table AS (
  SELECT i, i AS c, 0 AS k FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM crc_table WHERE k < 8),
crc_step AS (SELECT i, c FROM crc_table WHERE k = 8),
turns AS (
  SELECT conv_id, turn, coalesce(text, '') AS text,
         sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS h
  FROM conversations WHERE conv_id IS NOT NULL),
placed AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) - 1 AS pos, text, h FROM turns),
ids AS (SELECT conv_id, count(*) AS n, conv_id::VARCHAR AS s FROM placed GROUP BY conv_id),
crc AS (
  SELECT conv_id, s, 1 AS i, 4294967295::BIGINT AS v FROM ids
  UNION ALL
  SELECT conv_id, s, i + 1, xor(v >> 8, (SELECT c FROM crc_step WHERE crc_step.i = xor(v & 255, ascii(substr(s, crc.i, 1))::BIGINT)))
  FROM crc WHERE i <= length(s)),
convs AS (
  SELECT ids.conv_id, ids.n, ids.conv_id - ids.conv_id % 100 AS base, xor(v, 4294967295) % 6 AS h
  FROM ids JOIN crc ON crc.conv_id = ids.conv_id AND crc.i = length(ids.s) + 1),
sized AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS met FROM convs c LEFT JOIN ids b ON b.conv_id = c.base),
seq AS (
  SELECT c.conv_id, pos + 1 AS depth, text, p.h FROM sized c JOIN placed p ON p.conv_id = c.base WHERE pos < met
  UNION ALL
  SELECT c.conv_id, pos - c.h + met + 1, text, p.h FROM sized c JOIN placed p USING (conv_id) WHERE pos >= c.h),
paths AS (
  SELECT conv_id, depth, length(text) AS chars, string_agg(h, '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM seq
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
named AS (SELECT *, min(conv_id) OVER (PARTITION BY depth, path) AS node FROM paths),
ends AS (
  SELECT node, depth, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
  FROM named JOIN (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id) USING (conv_id, depth) GROUP BY node, depth),
nodes AS (SELECT node, depth, count(*) AS n_convs, min(chars) AS chars FROM named GROUP BY node, depth),
linked AS (
  SELECT n.*, up.node AS parent FROM nodes n LEFT JOIN named up ON up.conv_id = n.node AND up.depth = n.depth - 1),
children AS (SELECT parent AS node, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2),
full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (node, depth)),
sums AS (
  SELECT a.node, a.depth, count(*) FILTER (WHERE d.n_children = 0) AS n_leaves, sum((d.n_convs - 1) * d.chars) AS saved
  FROM full_nodes d JOIN named a ON a.conv_id = d.node AND a.depth <= d.depth GROUP BY a.node, a.depth)
SELECT f.node AS conv_id, f.depth, f.parent AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved::BIGINT AS saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM full_nodes f JOIN sums USING (node, depth) LEFT JOIN ends USING (node, depth)"""

ORACLE: dict[str, str] = {
    "op1_embedding_join": _EMBEDDINGS_SQL, "op6_line_dedup": _LINES_SQL, "op7_decontaminate": _LEAKS_SQL,
    "op11_filter_audit": _FILTERS_SQL, "op13_conversation_trie": _TRIE_SQL}
