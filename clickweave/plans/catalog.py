"""Named queries over the test tables and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
``events`` table of that folder (re-shaped by ``behavior_events``). The
oracle text computes the same result in DuckDB from the same parquet file.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators import aggregates as agg
from ..operators import features as feat
from ..operators import recommend as rec
from ..operators import runs as runs_op
from ..operators import serving
from ..schema import EVENT_COLUMNS
from ..schema import TTL_CATEGORY_INTERESTS, TTL_RECENT_BEHAVIORS
from ..session import checkpoint
from ..sources import kafka as kafka_src
from ..sources import lake
from ..sources.fixtures import behavior_events, with_events
from ..streaming import micro_batch as mb
from ..streaming import records as rec_files
from ..streaming import stateful

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- C1, B11, B20, A8 ----------------------------------------------------------

_WEIGHT_SQL = """CASE WHEN action_type = 'purchase' THEN 4.0 WHEN action_type = 'add_to_cart' THEN 3.0
                      WHEN action_type = 'click' THEN 2.0 ELSE 1.0 END"""


@register("interaction_strength", with_events() + f"""
SELECT user_id, product_id, CAST(SUM({_WEIGHT_SQL}) AS DOUBLE) AS interaction_strength
FROM behavior_events GROUP BY user_id, product_id HAVING SUM({_WEIGHT_SQL}) > 0""")
def q_interaction_strength(spark, sf_dir):
    return agg.interaction_strength(behavior_events(spark, sf_dir))


@register("interaction_filtered", with_events() + f"""
SELECT user_id, product_id, CAST(SUM({_WEIGHT_SQL}) AS DOUBLE) AS interaction_strength
FROM behavior_events GROUP BY user_id, product_id HAVING SUM({_WEIGHT_SQL}) > 4""")
def q_interaction_filtered(spark, sf_dir):
    return agg.interaction_strength_sql(spark, behavior_events(spark, sf_dir), min_strength=4.0)


# --- B1-B7, D1-D5, B8, B9, B22 ---------------------------------------------------

_BASIC_SQL = """
  CASE WHEN product_price < 50 THEN 'low' WHEN product_price < 200 THEN 'medium' ELSE 'high' END AS price_range,
  regexp_matches(user_agent, '(?i)mobile|android|iphone') AS is_mobile,
  CASE WHEN referrer IS NULL THEN 'direct' WHEN contains(referrer, 'google') THEN 'search'
       WHEN contains(referrer, 'facebook') THEN 'social' ELSE 'other' END AS referrer_type"""

_TEMPORAL_SQL = """
  CAST(hour("timestamp") AS INTEGER) AS hour_of_day,
  CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week,
  COALESCE(dayofweek("timestamp") IN (0, 6), false) AS is_weekend,
  CASE WHEN hour("timestamp") BETWEEN 6 AND 11 THEN 'morning'
       WHEN hour("timestamp") BETWEEN 12 AND 17 THEN 'afternoon'
       WHEN hour("timestamp") BETWEEN 18 AND 22 THEN 'evening' ELSE 'night' END AS time_segment"""


def _window_sql(frame: int) -> str:
    return f"""
  CAST(row_number() OVER (PARTITION BY user_id, session_id ORDER BY "timestamp") AS INTEGER) AS action_sequence,
  count(*) OVER (PARTITION BY user_id, session_id ORDER BY "timestamp"
                 RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS session_action_count,
  CAST(sum(CASE WHEN action_type = 'view' THEN 1 ELSE 0 END) OVER recent AS BIGINT) AS recent_view_count,
  CAST(sum(CASE WHEN action_type = 'add_to_cart' THEN 1 ELSE 0 END) OVER recent AS BIGINT) AS recent_cart_count,
  avg(CASE WHEN action_type = 'view' THEN product_price END) OVER recent AS avg_price_viewed"""

# Averages are compared at 6 decimals: both engines sum doubles in their own
# order, which moves the last bits.
AVG_DECIMALS = 6


def rounded(df, *names):
    from pyspark.sql import functions as F
    return df.withColumns({n: F.round(n, AVG_DECIMALS) for n in names})


def _window_from(frame: int, source: str = "behavior_events", keys: str = "user_id") -> str:
    return f"""
FROM (SELECT *, CAST(floor(epoch("timestamp")) AS BIGINT) AS ts_unix FROM {source})
WINDOW recent AS (PARTITION BY {keys} ORDER BY ts_unix RANGE BETWEEN {frame} PRECEDING AND CURRENT ROW)"""


_SEGMENT_SQL = """
  CASE WHEN recent_cart_count > 0 AND action_sequence <= 3 THEN 'quick_buyer'
       WHEN recent_view_count > 5 THEN 'browser'
       WHEN action_type = 'purchase' AND session_action_count <= 2 THEN 'direct_buyer'
       ELSE 'casual_visitor' END AS user_behavior_type,
  CASE WHEN session_action_count >= 10 THEN 'high' WHEN session_action_count >= 5 THEN 'medium'
       ELSE 'low' END AS engagement_level"""

_WEEK_SESSIONS_SQL = """
week_events AS (
  SELECT * EXCLUDE (session_id),
         user_id || '_w' || strftime(date_trunc('week', "timestamp"), '%Y%m%d') AS session_id
  FROM behavior_events)"""

WIDE_FRAME = 7 * 86400


def week_sessions(events):
    """Sessions of one ISO week per user (wide parameter set)."""
    from pyspark.sql import functions as F
    return events.withColumn("session_id", F.concat(
        F.col("user_id"), F.lit("_w"), F.date_format(F.date_trunc("week", "timestamp"), "yyyyMMdd")))


@register("basic_features", with_events() + f"""
SELECT event_id, product_price, user_agent, referrer, {_BASIC_SQL} FROM behavior_events""")
def q_basic_features(spark, sf_dir):
    return feat.add_basic_features(behavior_events(spark, sf_dir)) \
        .select("event_id", "product_price", "user_agent", "referrer",
                "price_range", "is_mobile", "referrer_type")


@register("temporal_features", with_events() + f"""
SELECT event_id, "timestamp", {_TEMPORAL_SQL} FROM behavior_events""")
def q_temporal_features(spark, sf_dir):
    return feat.add_temporal_features(behavior_events(spark, sf_dir)) \
        .select("event_id", "timestamp", "hour_of_day", "day_of_week", "is_weekend", "time_segment")


_WIN_OUT = ["event_id", "user_id", "session_id", "timestamp", "action_sequence", "session_action_count",
            "recent_view_count", "recent_cart_count", "avg_price_viewed"]


@register("window_features", with_events() + f"""
SELECT * REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed) FROM (
SELECT event_id, user_id, session_id, "timestamp", {_window_sql(600)} {_window_from(600)})""")
def q_window_features(spark, sf_dir):
    return rounded(feat.add_aggregated_features(behavior_events(spark, sf_dir)).select(*_WIN_OUT),
                   "avg_price_viewed")


@register("window_features_wide", with_events(_WEEK_SESSIONS_SQL) + f"""
SELECT * REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed) FROM (
SELECT event_id, user_id, session_id, "timestamp", {_window_sql(WIDE_FRAME)}
{_window_from(WIDE_FRAME, "week_events")})""")
def q_window_features_wide(spark, sf_dir):
    ev = week_sessions(behavior_events(spark, sf_dir))
    return rounded(feat.add_aggregated_features(ev, recent_seconds=WIDE_FRAME).select(*_WIN_OUT),
                   "avg_price_viewed")


def _featured_cte(frame: int, source: str, keys: str = "user_id") -> str:
    return f"""
featured AS (
  SELECT *, {_BASIC_SQL}, {_TEMPORAL_SQL}, {_window_sql(frame)} {_window_from(frame, source, keys)})"""


_SEGMENTS_SELECT = f"""SELECT * EXCLUDE (ts_unix) REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed),
  {_SEGMENT_SQL} FROM featured"""


@register("user_segments", with_events(_featured_cte(600, "behavior_events")) + _SEGMENTS_SELECT)
def q_user_segments(spark, sf_dir):
    return rounded(feat.process_user_behavior(behavior_events(spark, sf_dir)), "avg_price_viewed")


@register("user_segments_wide",
          with_events(_WEEK_SESSIONS_SQL, _featured_cte(WIDE_FRAME, "week_events")) + _SEGMENTS_SELECT)
def q_user_segments_wide(spark, sf_dir):
    ev = week_sessions(behavior_events(spark, sf_dir))
    return rounded(feat.process_user_behavior(ev, recent_seconds=WIDE_FRAME), "avg_price_viewed")


# --- C2-C5, B19 -------------------------------------------------------------------

@register("user_features", with_events() + """
SELECT user_id,
       count(*) AS total_events,
       count(DISTINCT session_id) AS session_count,
       count(DISTINCT product_id) AS unique_products_viewed,
       count(DISTINCT product_category) AS categories_explored,
       round(avg(product_price), 6) AS avg_price_interest,
       CAST(sum(CASE WHEN action_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
       CAST(sum(CASE WHEN action_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_additions,
       max("timestamp") AS last_activity,
       CAST(sum(CASE WHEN action_type = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS conversion_rate,
       CAST(sum(CASE WHEN action_type = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE)
         / greatest(sum(CASE WHEN action_type = 'add_to_cart' THEN 1 ELSE 0 END), 1) AS cart_conversion_rate
FROM behavior_events GROUP BY user_id""")
def q_user_features(spark, sf_dir):
    return rounded(agg.user_features(behavior_events(spark, sf_dir)), "avg_price_interest")


@register("product_features", with_events() + """
SELECT product_id, product_category,
       count(*) AS total_interactions,
       count(DISTINCT user_id) AS unique_users,
       CAST(sum(CASE WHEN action_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS view_count,
       CAST(sum(CASE WHEN action_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS cart_count,
       CAST(sum(CASE WHEN action_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchase_count,
       arg_min(product_price, ("timestamp", event_id)) AS price,
       CAST(count(DISTINCT user_id) AS DOUBLE) / count(*) AS popularity_score,
       CAST(sum(CASE WHEN action_type = 'purchase' THEN 1 ELSE 0 END) AS DOUBLE)
         / nullif(sum(CASE WHEN action_type = 'view' THEN 1 ELSE 0 END), 0) AS conversion_rate
FROM behavior_events GROUP BY product_id, product_category""")
def q_product_features(spark, sf_dir):
    return agg.product_features(behavior_events(spark, sf_dir), price_order=("timestamp", "event_id"))


# --- C1-C5 by days ---------------------------------------------------------------

ROLLING_DAYS = 7


@register("rolling_interactions", with_events(f"""
days AS (SELECT DISTINCT CAST("timestamp" AS DATE) AS day FROM behavior_events),
pairs AS (
  SELECT day, user_id, product_id, sum({_WEIGHT_SQL}) AS score
  FROM days JOIN behavior_events ON CAST("timestamp" AS DATE) BETWEEN day - {ROLLING_DAYS - 1} AND day
  GROUP BY day, user_id, product_id)""") + """
SELECT day, user_id, count(*) AS products, CAST(sum(score) AS DOUBLE) AS score, CAST(max(score) AS DOUBLE) AS strongest
FROM pairs GROUP BY day, user_id""")
def q_rolling_interactions(spark, sf_dir):
    """Interaction scores over the last seven days, for every day, each from the
    day before by adding a day and subtracting one (C1)."""
    from datetime import timedelta
    from pyspark.sql import functions as F
    from ..operators import daily
    path, out = _scratch(spark, "days"), _scratch(spark, "rolling")
    daily.day_scores(behavior_events(spark, sf_dir)).write.partitionBy("event_date").parquet(path)
    table = spark.read.parquet(path)
    days = sorted(r[0] for r in table.select("event_date").distinct().collect())  # folders
    window = None
    for d in days:
        old = d - timedelta(days=ROLLING_DAYS)
        window = checkpoint(daily.slide(window, table.where(F.col("event_date") == d),
                                        table.where(F.col("event_date") == old) if old in days else None))
        # written day by day: a task of a union of all days would read a piece of each
        window.groupBy(F.lit(d).alias("day"), "user_id").agg(
            F.count(F.lit(1)).alias("products"), F.sum("score").alias("score"), F.max("score").alias("strongest")) \
            .write.mode("append").parquet(out)
    return spark.read.parquet(out)


@register("user_features_by_days", ORACLE["user_features"])
def q_user_features_by_days(spark, sf_dir):
    """The user features put together from two stretches of days, the second
    added to a dictionary that did not know its values."""
    from pyspark.sql import functions as F
    from ..operators import daily
    events = behavior_events(spark, sf_dir)
    half = F.col("timestamp") < "2024-01-12"
    names = {"session_count": "session_id", "unique_products_viewed": "product_id", "categories_explored": "product_category"}
    labels, days, sets = {}, [], {n: [] for n in names}
    for part in (events.where(half), events.where(~half)):
        days.append(daily.day_users(part))
        for name, col in names.items():
            labels[col] = checkpoint(daily.extend_labels(labels.get(col), part, col))
            sets[name].append(daily.day_sets(part, ["user_id"], col, labels[col]))
    return rounded(daily.users_over_days(days[0].unionByName(days[1]), {n: a.unionByName(b) for n, (a, b) in sets.items()}),
                   "avg_price_interest")


# --- G7 ------------------------------------------------------------------------------

HOLDOUT = "2024-01-20"


@register("ranking_metrics", with_events(f"""
recs AS (
  SELECT user_id, product_id, row_number() OVER (PARTITION BY user_id ORDER BY sum({_WEIGHT_SQL}) DESC, product_id) AS rank
  FROM behavior_events WHERE "timestamp" < TIMESTAMP '{HOLDOUT}' GROUP BY user_id, product_id QUALIFY rank <= 10)""", f"""
truth AS (SELECT DISTINCT user_id, product_id FROM behavior_events WHERE "timestamp" >= TIMESTAMP '{HOLDOUT}')""", """
hit AS (
  SELECT user_id, count(*) AS hits, sum(1 / log2(rank + 1)) AS gain FROM recs JOIN truth USING (user_id, product_id) GROUP BY user_id)""", """
ideal AS (SELECT i AS k, sum(1 / log2(i + 1)) OVER (ORDER BY i) AS best FROM range(1, 11) t(i))""") + """
SELECT user_id, relevant, coalesce(hits, 0) AS hits, coalesce(hits, 0) / 10.0::DOUBLE AS precision,
       coalesce(hits, 0)::DOUBLE / relevant AS recall, round(coalesce(gain, 0) / best, 9) AS ndcg
FROM (SELECT user_id, count(*) AS relevant FROM truth GROUP BY user_id)
LEFT JOIN hit USING (user_id) JOIN ideal ON k = least(relevant, 10)""")
def q_ranking_metrics(spark, sf_dir):
    """Ranking quality (G7) of an exact score: each user's ten strongest
    products before a day, against those of that day on."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    from ..operators.ranking import ranking_metrics
    events = behavior_events(spark, sf_dir)
    best = Window.partitionBy("user_id").orderBy(F.col("interaction_strength").desc(), "product_id")
    recs = agg.interaction_strength(events.where(F.col("timestamp") < HOLDOUT)).withColumn("rank", F.row_number().over(best)).where("rank <= 10")
    out = ranking_metrics(recs, events.where(F.col("timestamp") >= HOLDOUT))
    return out.withColumn("ndcg", F.round("ndcg", 9))


# --- C6-C11, H9 -------------------------------------------------------------------


def _runs_cte(name: str, source: str, key: str, ttl: int) -> str:
    """Runs of ``key``: a new run when the gap to the key's previous event
    is >= ttl seconds. Adds run_no (1, 2, ...) and run_start."""
    return f"""
{name}_gaps AS (
  SELECT *, CASE WHEN lag("timestamp") OVER (PARTITION BY {key} ORDER BY "timestamp") IS NULL
                   OR "timestamp" - lag("timestamp") OVER (PARTITION BY {key} ORDER BY "timestamp")
                      >= INTERVAL {ttl} SECOND THEN 1 ELSE 0 END AS run_flag
  FROM {source}),
{name}_nos AS (
  SELECT *, sum(run_flag) OVER (PARTITION BY {key} ORDER BY "timestamp" ROWS UNBOUNDED PRECEDING) AS run_no
  FROM {name}_gaps),
{name} AS (
  SELECT * EXCLUDE (run_flag), min("timestamp") OVER (PARTITION BY {key}, run_no) AS run_start
  FROM {name}_nos)"""


def _newest_run_cte(name: str, source: str, key: str, ttl: int) -> str:
    return _runs_cte(f"{name}_all", source, key, ttl) + f""",
{name} AS (
  SELECT * FROM {name}_all QUALIFY run_no = max(run_no) OVER (PARTITION BY {key}))"""


_TIME_TEXT = """strftime("timestamp", '%Y-%m-%d %H:%M:%S')"""


def _recent_sql(n: int) -> str:
    return with_events(_newest_run_cte("live", "behavior_events", "user_id", TTL_RECENT_BEHAVIORS)) + f"""
SELECT user_id, rank, product_id, action_type, product_category AS category, product_price AS price,
       {_TIME_TEXT} AS "timestamp",
       CAST(json_object('product_id', product_id, 'action_type', action_type, 'category', product_category,
                        'price', product_price, 'timestamp', {_TIME_TEXT}) AS VARCHAR) AS behavior_json
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, event_id DESC) AS rank
      FROM live)
WHERE rank <= {n}"""


@register("recent_behaviors_100", _recent_sql(100))
def q_recent_behaviors_100(spark, sf_dir):
    return serving.recent_behaviors(behavior_events(spark, sf_dir), n=100, tie_break="event_id")


@register("recent_behaviors_10", _recent_sql(10))
def q_recent_behaviors_10(spark, sf_dir):
    return serving.recent_behaviors(behavior_events(spark, sf_dir), n=10, tie_break="event_id")


def _counter_sql(field_sql: str, ranked: bool = False) -> str:
    body = _counter_body(field_sql)
    if ranked:
        body = f"""
SELECT *, CAST(row_number() OVER (PARTITION BY user_id ORDER BY count DESC, field ASC) AS INTEGER) AS rank
FROM ({body})"""
    return with_events(_newest_run_cte("live", "behavior_events", "user_id", TTL_CATEGORY_INTERESTS)) + body


def _counter_body(field_sql: str, kind: str | None = None) -> str:
    k = f"'{kind}' AS kind, " if kind else ""
    return f"""
SELECT user_id, {k}{field_sql} AS field, count(*) AS count FROM live GROUP BY user_id, {field_sql}"""


_BAND_SQL = """CASE WHEN product_price < 50 THEN '0-50' WHEN product_price < 100 THEN '50-100'
     WHEN product_price < 200 THEN '100-200' WHEN product_price < 500 THEN '200-500'
     WHEN product_price IS NOT NULL THEN '500+' END"""


@register("category_interests", _counter_sql("product_category"))
def q_category_interests(spark, sf_dir):
    return serving.category_interests(behavior_events(spark, sf_dir))


@register("price_preferences", _counter_sql(_BAND_SQL, ranked=True))
def q_price_preferences(spark, sf_dir):
    return serving.price_preferences(behavior_events(spark, sf_dir))


@register("action_counts", _counter_sql("action_type"))
def q_action_counts(spark, sf_dir):
    return serving.action_counts(behavior_events(spark, sf_dir))


_SESSION_SELECT = f"""
SELECT session_id, arg_min(user_id, "timestamp") AS user_id,
       strftime(min("timestamp"), '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(max("timestamp"), '%Y-%m-%d %H:%M:%S') AS last_activity,
       count(*) AS action_count"""


@register("session_summary", with_events() + _SESSION_SELECT + """
FROM behavior_events GROUP BY session_id""")
def q_session_summary(spark, sf_dir):
    return serving.session_summary(behavior_events(spark, sf_dir), ttl_seconds=None)


@register("session_summary_runs", with_events(_runs_cte("session_runs", "behavior_events", "session_id", 3600))
          + _SESSION_SELECT + """
FROM session_runs GROUP BY session_id, run_no""")
def q_session_summary_runs(spark, sf_dir):
    return serving.session_summary(behavior_events(spark, sf_dir), ttl_seconds=3600, all_runs=True)


def _expiry_sql(ttl: int) -> str:
    return with_events(_runs_cte("user_runs", "behavior_events", "user_id", ttl)) + f"""
SELECT user_id, min("timestamp") AS run_start, max("timestamp") AS last_write, count(*) AS events,
       max("timestamp") + INTERVAL {ttl} SECOND AS expires_at
FROM user_runs GROUP BY user_id, run_no"""


@register("expiry_1d", _expiry_sql(86400))
def q_expiry_1d(spark, sf_dir):
    return runs_op.run_summary(behavior_events(spark, sf_dir), "user_id", 86400)


@register("expiry_2d", _expiry_sql(2 * 86400))
def q_expiry_2d(spark, sf_dir):
    return runs_op.run_summary(behavior_events(spark, sf_dir), "user_id", 2 * 86400)


@register("quarantine", with_events() + """
SELECT event_id, user_id,
       CASE WHEN user_id IS NULL THEN 'missing user_id' WHEN session_id IS NULL THEN 'missing session_id'
            WHEN action_type IS NULL THEN 'missing action_type'
            WHEN product_category IS NULL THEN 'missing product_category'
            WHEN product_price IS NULL THEN 'missing product_price'
            WHEN "timestamp" IS NULL THEN 'missing timestamp' END AS reason
FROM behavior_events""")
def q_quarantine(spark, sf_dir):
    return serving.tag_storable(behavior_events(spark, sf_dir)).select("event_id", "user_id", "reason")


@register("price_bands", with_events() + f"""
SELECT event_id, product_price, {_BAND_SQL} AS band FROM behavior_events""")
def q_price_bands(spark, sf_dir):
    from ..functions import price_band
    return behavior_events(spark, sf_dir).select("event_id", "product_price", price_band().alias("band"))


@register("action_weights", with_events() + f"""
SELECT event_id, action_type, CAST({_WEIGHT_SQL} AS DOUBLE) AS weight FROM behavior_events""")
def q_action_weights(spark, sf_dir):
    from ..functions.columns import action_weight
    return behavior_events(spark, sf_dir).select("event_id", "action_type", action_weight().alias("weight"))


# A lifetime of a day, at which most users of the tables have expired.
AS_OF = "2024-01-30 12:00:00"


@register("action_counts_as_of", with_events(_newest_run_cte("live", "behavior_events", "user_id", 86400)) + f"""
SELECT user_id, concat('user:', user_id, ':action_counts') AS key, action_type AS field, count(*) AS count
FROM (SELECT *, max("timestamp") OVER (PARTITION BY user_id) AS last FROM live)
WHERE TIMESTAMP '{AS_OF}' < last + INTERVAL 86400 SECOND GROUP BY user_id, action_type""")
def q_action_counts_as_of(spark, sf_dir):
    counts = serving.action_counts(behavior_events(spark, sf_dir), ttl_seconds=86400, as_of=AS_OF)
    return serving.with_serving_key(counts, "action_counts")


# --- A2-A9, A12, B12, B18 ---------------------------------------------------------


def _fresh_lake(spark, sf_dir: str) -> str:
    """Write the events of ``sf_dir`` to a new lake folder below the shared
    checkpoint folder and return its path."""
    import uuid
    from ..session import scratch_path
    path = scratch_path(spark, f"lake-{uuid.uuid4().hex}")
    lake.write_lake(behavior_events(spark, sf_dir), path)
    return path


@register("lake_roundtrip", with_events() + """
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM behavior_events""")
def q_lake_roundtrip(spark, sf_dir):
    return lake.read_lake(spark, _fresh_lake(spark, sf_dir))


@register("lake_two_runs", with_events() + """
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM behavior_events""")
def q_lake_two_runs(spark, sf_dir):
    """One batch write and two runs of the stream sink that both start at
    batch 0, one of them replayed, in one lake."""
    from pyspark.sql import functions as F
    path = _scratch(spark, "lake")
    events = behavior_events(spark, sf_dir)
    part = [events.where(F.pmod("event_id", F.lit(3)) == i) for i in range(3)]
    lake.write_lake(part[0], path)
    mb.BatchSink(lake_path=path, run_id="a")(part[1], 0)
    for _ in range(2):
        mb.BatchSink(lake_path=path, run_id="b")(part[2], 0)
    return lake.read_lake(spark, path)


TARGET_DAY = "2024-01-15"


@register("time_range_day", with_events() + """
SELECT *, CAST("timestamp" AS DATE) AS event_date FROM behavior_events
WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-16 00:00:00'""")
def q_time_range_day(spark, sf_dir):
    events = lake.read_lake(spark, _fresh_lake(spark, sf_dir))
    return lake.time_range(events, *lake.day_range(TARGET_DAY))


@register("decode_roundtrip", with_events() + """
SELECT user_id, product_id, action_type, "timestamp", session_id, product_category,
       CAST(CAST(product_price AS FLOAT) AS DOUBLE) AS product_price, user_agent, ip_address, referrer,
       user_id AS kafka_key
FROM behavior_events""")
def q_decode_roundtrip(spark, sf_dir):
    records = kafka_src.encode_events(behavior_events(spark, sf_dir))
    decoded = kafka_src.decode_events(records)
    return kafka_src.fill_event_time(decoded).select(*EVENT_COLUMNS, "kafka_key")


# --- C12, E1-E3, F2, F3, G1-G6 ------------------------------------------------------

_LABELS_SQL = """
SELECT '{col}' AS "column", label, CAST(row_number() OVER (ORDER BY freq DESC, label ASC) - 1 AS INTEGER) AS idx
FROM (SELECT {col} AS label, count(*) AS freq FROM scores WHERE {col} IS NOT NULL GROUP BY {col})"""

_SCORES_CTE = f"""
scores AS (
  SELECT user_id, product_id, CAST(SUM({_WEIGHT_SQL}) AS DOUBLE) AS interaction_strength
  FROM behavior_events GROUP BY user_id, product_id HAVING SUM({_WEIGHT_SQL}) > 0)"""


@register("label_index", with_events(_SCORES_CTE) + _LABELS_SQL.format(col="user_id")
          + "\nUNION ALL" + _LABELS_SQL.format(col="product_id"))
def q_label_index(spark, sf_dir):
    from pyspark.sql import functions as F
    scores = agg.interaction_strength(behavior_events(spark, sf_dir))
    dicts = rec.fit_indexers(scores)
    return (dicts.users.select(F.lit("user_id").alias("column"), "label", "idx")
            .unionByName(dicts.products.select(F.lit("product_id").alias("column"), "label", "idx")))


@register("encoded_interactions", with_events(
    _SCORES_CTE,
    "users AS (" + _LABELS_SQL.format(col="user_id") + ")",
    "products AS (" + _LABELS_SQL.format(col="product_id") + ")") + """
SELECT s.user_id, s.product_id, s.interaction_strength, u.idx AS user_idx, p.idx AS product_idx
FROM scores s JOIN users u ON s.user_id = u.label JOIN products p ON s.product_id = p.label""")
def q_encoded_interactions(spark, sf_dir):
    scores = agg.interaction_strength(behavior_events(spark, sf_dir))
    return rec.encode(scores, rec.fit_indexers(scores)) \
        .select("user_id", "product_id", "interaction_strength", "user_idx", "product_idx")


def _trained(spark, sf_dir):
    scores = checkpoint(agg.interaction_strength(behavior_events(spark, sf_dir)))
    dicts = rec.fit_indexers(scores)
    return rec.fit_als(rec.encode(scores, dicts)), dicts


def _shape(recs, scores):
    """One row per user: what holds of any correct top-n, whatever the factors."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    known = scores.select("product_id").distinct().withColumn("known", F.lit(True))
    before = F.lag("rating").over(Window.partitionBy("user_id").orderBy("rank"))
    rows = recs.join(known, "product_id", "left").withColumn("before", before)
    return rows.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.count_distinct("product_id").alias("products"),
        F.bool_and(F.coalesce("known", F.lit(False))).alias("all_known"),
        F.bool_and((F.col("rating") >= 0) & (F.col("before").isNull() | (F.col("before") >= F.col("rating")))).alias("ordered"))


_SHAPE_SQL = """
SELECT user_id, least(10, (SELECT count(DISTINCT product_id) FROM scores)) AS n, 1 AS first_rank,
       CAST(least(10, (SELECT count(DISTINCT product_id) FROM scores)) AS INTEGER) AS last_rank,
       least(10, (SELECT count(DISTINCT product_id) FROM scores)) AS products, true AS all_known, true AS ordered
FROM (SELECT DISTINCT user_id FROM scores)"""


@register("recommend_shape", with_events(_SCORES_CTE) + _SHAPE_SQL)
def q_recommend_shape(spark, sf_dir):
    """G4-G6 over every user, as the properties any correct result has."""
    model, dicts = _trained(spark, sf_dir)
    events = behavior_events(spark, sf_dir)
    return _shape(rec.recommend(model, dicts, events.select("user_id"), n=10), events)


@register("train_job_shape", with_events(_SCORES_CTE) + _SHAPE_SQL)
def q_train_job_shape(spark, sf_dir):
    """The training job (G7): lake, scores, ALS, saved artifacts; loaded again
    (A10) and asked for every user (G6)."""
    from ..sources.models import load_model
    from .train import train
    path = _fresh_lake(spark, sf_dir)
    root = train(spark, path, None, None, _scratch(spark, "models"))
    return _shape(rec.recommend_all(*load_model(spark, root), n=10), lake.read_lake(spark, path))


@register("top_n_decode", with_events(_SCORES_CTE) + """
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY interaction_strength DESC, product_id)
                     AS INTEGER) AS rank, product_id, interaction_strength AS rating
FROM scores QUALIFY rank <= 5""")
def q_top_n_decode(spark, sf_dir):
    """Decoding of ranked index arrays (G5, E1, B17) over an exact score: each
    user's five strongest products."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    scores = checkpoint(agg.interaction_strength(behavior_events(spark, sf_dir)))
    dicts = rec.fit_indexers(scores)
    best = Window.partitionBy("user_idx").orderBy(F.col("interaction_strength").desc(), "product_id")
    five = rec.encode(scores, dicts).withColumn("rank", F.row_number().over(best)).where("rank <= 5")
    lists = five.groupBy("user_idx").agg(F.array_sort(F.collect_list(F.struct(
        (-F.col("interaction_strength")).alias("low"), "product_id", "product_idx",
        F.col("interaction_strength").alias("rating")))).alias("recommendations"))
    return rec._decode(lists, dicts)


# Whole-number factors, so that scores and ties are exact in both engines: how
# often a user, or a product, has each action, a product's counts less 2.
_GIVEN_ACTIONS = ("view", "click", "add_to_cart", "purchase", "error")
_GIVEN_SQL = ", ".join(f"count(*) FILTER (WHERE action_type = '{a}') AS {a}" for a in _GIVEN_ACTIONS)


@register("top_n_given_factors", with_events(
    f"u AS (SELECT user_id, {_GIVEN_SQL} FROM behavior_events GROUP BY user_id)",
    f"p AS (SELECT product_id, {_GIVEN_SQL} FROM behavior_events GROUP BY product_id)") + f"""
SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY rating DESC, product_id) AS INTEGER) AS rank,
       product_id, rating
FROM (SELECT user_id, product_id,
             CAST({" + ".join(f"u.{a} * (p.{a} - 2)" for a in _GIVEN_ACTIONS)} AS DOUBLE) AS rating FROM u, p)
QUALIFY rank <= 10""")
def q_top_n_given_factors(spark, sf_dir):
    """Exact top 10 by inner product (G4, G6) over given factors, in blocks of
    16 products."""
    from pyspark.sql import functions as F
    from ..operators.topn import top_n
    events = behavior_events(spark, sf_dir)

    def factors(col, less):
        counts = events.groupBy(F.substring_index(col, "_", -1).cast("int").alias("id")).agg(
            F.array(*[(F.count_if(F.col("action_type") == a) - less).cast("double") for a in _GIVEN_ACTIONS]).alias("features"))
        return counts

    best, _ = top_n(factors("user_id", 0), factors("product_id", 2), 10, block_items=16)
    return best.select(F.format_string("user_%06d", "user").alias("user_id"), "rank",
                       F.format_string("product_%06d", "item").alias("product_id"), F.col("score").alias("rating"))


@register("recommend_top10")
def q_recommend_top10(spark, sf_dir):
    """Top 10 through the given-users path (G4, E2: semi join + exact top-n),
    asked for every user id in the events."""
    model, dicts = _trained(spark, sf_dir)
    return rec.recommend(model, dicts, behavior_events(spark, sf_dir).select("user_id"), n=10)


@register("recommend_all")
def q_recommend_all(spark, sf_dir):
    model, dicts = _trained(spark, sf_dir)
    return rec.recommend_all(model, dicts, n=10)


# --- H1-H12, A11, A14, C13 ----------------------------------------------------------


def _scratch(spark, name):
    import uuid
    from ..session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def _record_stream(spark, sf_dir, days: int, copies: int = 1, change=None, late_days=None) -> DataFrame:
    """A stream of the events of ``sf_dir`` as records, ``days`` of them to a
    micro-batch: record files in a folder per day, as many for every day, written
    in day order (and ``copies`` times, to model producer retries)."""
    path = _scratch(spark, "records")
    events = behavior_events(spark, sf_dir)
    if change is not None:
        events = change(events)
    staged = rec_files.stage_days(events, late_days=late_days)
    files = rec_files.even_files(staged)
    for i in range(copies):
        rec_files.write_days(spark, staged, path, files_per_day=files, suffix="" if i == 0 else f"r{i}", at_once=days)
    return rec_files.read_record_stream(spark, path, max_files=days * files)


_STREAM_EVENTS_CTE = """
stream_events AS (
  SELECT * EXCLUDE (event_id) REPLACE (CAST(CAST(product_price AS FLOAT) AS DOUBLE) AS product_price),
         CAST("timestamp" AS DATE) AS day
  FROM behavior_events)"""

# Days (record files) per micro-batch. Per-batch features depend on it (the
# oracle groups its windows the same way); the stateful results do not.
FEATURE_DAYS_PER_BATCH = 3
STATE_DAYS_PER_BATCH = 5

_STREAM_BATCHES_CTE = f"""
stream_batches AS (
  SELECT * EXCLUDE (day), (dense_rank() OVER (ORDER BY day) - 1) // {FEATURE_DAYS_PER_BATCH} AS day
  FROM stream_events)"""

_STREAM_FEATURE_COLS = EVENT_COLUMNS + feat.BASIC_COLS + feat.TEMPORAL_COLS + feat.WINDOW_COLS \
    + feat.SEGMENT_COLS


@register("stream_features", with_events(_STREAM_EVENTS_CTE, _STREAM_BATCHES_CTE,
                                         _featured_cte(600, "stream_batches", "user_id, day"))
          + f"""SELECT * EXCLUDE (ts_unix, day) REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed),
  {_SEGMENT_SQL} FROM featured""")
def q_stream_features(spark, sf_dir):
    """Micro-batches of three days each through the full job; per-batch
    features (windows restart every micro-batch, H7)."""
    out = _scratch(spark, "stream")
    events = mb.decode_stream(_record_stream(spark, sf_dir, FEATURE_DAYS_PER_BATCH))
    q = mb.start_stream(events, checkpoint=f"{out}/checkpoint", lake_path=f"{out}/lake",
                        serving_path=f"{out}/serving", features_path=f"{out}/features",
                        available_now=True)
    q.awaitTermination()
    feats = spark.read.parquet(f"{out}/features")
    return rounded(feats.select(*_STREAM_FEATURE_COLS), "avg_price_viewed")


@register("stream_stateful", with_events(_STREAM_EVENTS_CTE) + f"""
SELECT * EXCLUDE (ts_unix, day) REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed) FROM (
SELECT *, {_window_sql(600)} {_window_from(600, "stream_events")})""")
def q_stream_stateful(spark, sf_dir):
    """Cross-batch window features with keyed state; equals the batch result."""
    out = _scratch(spark, "stateful")
    records = _record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH)
    events = mb.decode_stream(records).select(*EVENT_COLUMNS)
    with stateful.configured(spark):
        q = (stateful.stateful_features(events).writeStream.format("parquet")
             .option("path", f"{out}/features").option("checkpointLocation", f"{out}/checkpoint")
             .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return rounded(spark.read.parquet(f"{out}/features")
                   .select(*EVENT_COLUMNS, *feat.WINDOW_COLS), "avg_price_viewed")


_STREAM_ALL_SQL = with_events(_STREAM_EVENTS_CTE, _featured_cte(600, "stream_events")) + f"""
SELECT * EXCLUDE (ts_unix, day) REPLACE (round(avg_price_viewed, 6) AS avg_price_viewed), {_SEGMENT_SQL} FROM featured"""


def _lookback(spark, sf_dir, late_days=None):
    from ..streaming.lookback import current_features
    out = _scratch(spark, "lookback")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, late_days=late_days))
    mb.start_stream(events, checkpoint=f"{out}/checkpoint", lake_path=f"{out}/lake", features_path=f"{out}/features",
                    feature_mode="lookback", available_now=True).awaitTermination()
    return rounded(current_features(spark, f"{out}/features").select(*_STREAM_FEATURE_COLS), "avg_price_viewed")


@register("stream_lookback", _STREAM_ALL_SQL)
def q_stream_lookback(spark, sf_dir):
    """All features across micro-batches by a look back into the lake (H8);
    equals the batch result."""
    return _lookback(spark, sf_dir)


@register("late_stream", _STREAM_ALL_SQL)
def q_late_stream(spark, sf_dir):
    """Every fifth record comes six days late, into a later micro-batch; rows
    that it changes are corrected (H12), so the features equal the batch result."""
    from pyspark.sql import functions as F
    return _lookback(spark, sf_dir, F.when(F.col("offset") % 5 == 0, 6).otherwise(0))


@register("stream_once", with_events() + """
SELECT user_id, product_id, action_type, "timestamp", session_id, product_category,
       CAST(CAST(product_price AS FLOAT) AS DOUBLE) AS product_price, user_agent, ip_address, referrer,
       event_id AS "offset", CAST("timestamp" AS DATE) AS event_date
FROM behavior_events""")
def q_stream_once(spark, sf_dir):
    """Every record delivered twice, every fifth one days late; each is kept
    once, late ones too (H10, H12)."""
    from pyspark.sql import functions as F
    out = _scratch(spark, "once")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, copies=2, late_days=F.when(F.col("offset") % 5 == 0, 6).otherwise(0)), late="once")
    mb.start_stream(events, checkpoint=f"{out}/checkpoint", lake_path=f"{out}/lake", available_now=True).awaitTermination()
    return lake.read_lake(spark, f"{out}/lake").select(*EVENT_COLUMNS, "offset", "event_date")


@register("stream_metrics", with_events() + f"""
SELECT batch_id, count(*) AS rows, count(*) FILTER (WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0
       AND event_id % 19 <> 0) AS storable, count(*) FILTER (WHERE event_id % 11 = 0) AS no_user,
       min("timestamp") AS first_event, max("timestamp") AS last_event
FROM (SELECT *, (dense_rank() OVER (ORDER BY CAST("timestamp" AS DATE)) - 1) // {STATE_DAYS_PER_BATCH} AS batch_id FROM behavior_events)
GROUP BY batch_id""")
def q_stream_metrics(spark, sf_dir):
    """Counts per micro-batch, written by a listener (H6, C13); only the
    quarantine table is on."""
    from ..streaming.metrics import read_metrics
    out = _scratch(spark, "metrics")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, change=_spoil))
    q = mb.start_stream(events, checkpoint=f"{out}/checkpoint", quarantine_path=f"{out}/bad", metrics_path=f"{out}/metrics",
                        available_now=True)
    q.awaitTermination()
    q.metrics.wait(q)
    spark.streams.removeListener(q.metrics)
    return read_metrics(spark, f"{out}/metrics").select("batch_id", "rows", "storable", "no_user", "first_event", "last_event")


@register("stream_dedup", with_events() + """
SELECT user_id, product_id, action_type, "timestamp", session_id, product_category,
       CAST(CAST(product_price AS FLOAT) AS DOUBLE) AS product_price, user_agent, ip_address, referrer,
       event_id AS "offset", CAST("timestamp" AS DATE) AS event_date
FROM behavior_events""")
def q_stream_dedup(spark, sf_dir):
    """Every record delivered twice; the drop policy keeps each once."""
    out = _scratch(spark, "dedup")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, copies=2), late="drop")
    q = mb.start_stream(events, checkpoint=f"{out}/checkpoint", lake_path=f"{out}/lake",
                        available_now=True)
    q.awaitTermination()
    return lake.read_lake(spark, f"{out}/lake").select(*EVENT_COLUMNS, "offset", "event_date")


LIVE_TTL = 86400
KINDS = ("category_interests", "price_preferences", "action_counts")


@register("stream_serving_tables", with_events(_STREAM_EVENTS_CTE, _newest_run_cte(
    "live", "stream_events", "user_id", LIVE_TTL)) + _counter_body("product_category", KINDS[0])
    + "\nUNION ALL" + _counter_body(_BAND_SQL, KINDS[1]) + "\nUNION ALL" + _counter_body("action_type", KINDS[2]))
def q_stream_serving_tables(spark, sf_dir):
    """The job's serving tables with a lifetime of a day, merged over its
    micro-batches."""
    from functools import reduce
    from pyspark.sql import functions as F
    from ..sources.serving_store import TABLES, read_serving
    out = _scratch(spark, "tables")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH))
    mb.start_stream(events, checkpoint=f"{out}/checkpoint", serving_path=f"{out}/serving", available_now=True,
                    ttls=dict.fromkeys(TABLES, LIVE_TTL)).awaitTermination()
    return reduce(lambda a, b: a.unionByName(b), [
        read_serving(spark, f"{out}/serving", k, ttl_seconds=LIVE_TTL)
        .select("user_id", F.lit(k).alias("kind"), "field", "count") for k in KINDS])


def _spoil(events):
    from pyspark.sql import functions as F
    return events.withColumns({c: F.when(F.col("event_id") % k != 0, F.col(c)) for c, k in SPOILED.items()})


# column -> every how manyth event lacks it
SPOILED = {"user_id": 11, "session_id": 13, "product_category": 17, "product_price": 19}


@register("stream_quarantine", with_events() + """
SELECT * FROM (
SELECT CASE WHEN event_id % 11 <> 0 THEN user_id END AS user_id, product_id, action_type, "timestamp",
       CASE WHEN event_id % 11 = 0 THEN 'missing user_id' WHEN event_id % 13 = 0 THEN 'missing session_id'
            WHEN event_id % 17 = 0 THEN 'missing product_category'
            WHEN event_id % 19 = 0 THEN 'missing product_price' END AS reason
FROM behavior_events) WHERE reason IS NOT NULL""")
def q_stream_quarantine(spark, sf_dir):
    """Events of which some lack a field; the job keeps the bad ones aside."""
    out = _scratch(spark, "quarantine")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, change=_spoil))
    mb.start_stream(events, checkpoint=f"{out}/checkpoint", quarantine_path=f"{out}/bad",
                    available_now=True).awaitTermination()
    return spark.read.parquet(f"{out}/bad").select("user_id", "product_id", "action_type", "timestamp", "reason")


@register("stream_serving_live", with_events(_STREAM_EVENTS_CTE, _newest_run_cte(
    "live", "stream_events", "user_id", LIVE_TTL)) + _counter_body("product_category", "category_interests")
    + "\nUNION ALL" + _counter_body(_BAND_SQL, "price_preferences")
    + "\nUNION ALL" + _counter_body("action_type", "action_counts"))
def q_stream_serving_live(spark, sf_dir):
    """Live counters with a 1-day sliding expiry, kept in keyed state across
    micro-batches; the newest emission per user is the summary."""
    out = _scratch(spark, "live")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH)).select(*EVENT_COLUMNS)
    mb.start_live(events, "counters", f"{out}/counters", f"{out}/checkpoint", available_now=True,
                  ttl_seconds=LIVE_TTL).awaitTermination()
    return mb.read_live(spark, f"{out}/counters").select("user_id", "kind", "field", "count")


@register("stream_recent_live", with_events(
    """stream_events AS (
  SELECT * REPLACE (CAST(CAST(product_price AS FLOAT) AS DOUBLE) AS product_price) FROM behavior_events)""",
    _newest_run_cte("live", "stream_events", "user_id", LIVE_TTL)) + f"""
SELECT user_id, CAST(rank AS INTEGER) AS rank, product_id, action_type, product_category AS category,
       product_price AS price, {_TIME_TEXT} AS "timestamp"
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "timestamp" DESC, event_id DESC) AS rank FROM live)
WHERE rank <= 10""")
def q_stream_recent_live(spark, sf_dir):
    """The newest 10 behaviours of each user with a 1-day sliding expiry, as a
    list in keyed state (live C6); every fifth record comes a day late."""
    from pyspark.sql import functions as F
    from ..functions import format_time
    late = F.when(F.col("offset") % 5 == 0, 1).otherwise(0)
    out = _scratch(spark, "recent")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH, late_days=late), delay="2 days")
    mb.start_live(events, "recent_behaviors", f"{out}/recent", f"{out}/checkpoint", available_now=True,
                  ttl_seconds=LIVE_TTL, n=10, tie_break="offset").awaitTermination()
    return mb.read_live(spark, f"{out}/recent").select(
        "user_id", "rank", "product_id", "action_type", "category", "price", format_time("timestamp").alias("timestamp"))


@register("stream_sessions_live", with_events(_newest_run_cte("live", "behavior_events", "session_id", 3600))
          + _SESSION_SELECT + """
FROM live GROUP BY session_id""")
def q_stream_sessions_live(spark, sf_dir):
    """Session records with a 1-hour sliding expiry in keyed state; the
    newest emission per session is the record."""
    from ..functions import format_time
    out = _scratch(spark, "sessions")
    events = mb.decode_stream(_record_stream(spark, sf_dir, STATE_DAYS_PER_BATCH)).select(*EVENT_COLUMNS)
    mb.start_live(events, "sessions", f"{out}/sessions", f"{out}/checkpoint", available_now=True,
                  ttl_seconds=3600).awaitTermination()
    return mb.read_live(spark, f"{out}/sessions", "session_id").select(
        "session_id", "user_id", format_time("start_time").alias("start_time"),
        format_time("last_activity").alias("last_activity"), "action_count")
