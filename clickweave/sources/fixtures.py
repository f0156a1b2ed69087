"""Behaviour events derived from the driver's ``events`` table.

The reference ships no data; its input is the simulator's event record. The
``behavior_events`` frame re-shapes the test table ``events`` into that
record (see FIXTURES.md §2) so that every operator runs on real, growing
data. ``BEHAVIOR_EVENTS_SQL`` is the same view in DuckDB's dialect, used by
the oracle queries.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CATEGORIES

# --- fixed values of the fixture view ---------------------------------------
AGENT_WINDOWS = "Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 Chrome/120.0 Safari/537.36"
AGENT_IPHONE = "Mozilla/5.0 (iPhone; CPU iPhone OS 17_0 like Mac OS X) AppleWebKit/605.1.15 Mobile/15E148"
AGENT_ANDROID = "Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 Chrome/120.0 Mobile Safari/537.36"
REFERRERS = [None, "https://google.com", "https://facebook.com", "https://instagram.com", "direct"]
# ----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def to_behavior_events(events: DataFrame) -> DataFrame:
    """Map ``events(event_id, ts, user_id, event_type, value, props)`` to the
    behaviour event record plus ``event_id``."""
    k = F.get_json_object("props", "$.k").cast("int")
    cats = F.array(*[F.lit(c) for c in CATEGORIES])
    eid = F.col("event_id")
    agent = (F.when(eid % 4 == 0, AGENT_WINDOWS).when(eid % 4 == 1, AGENT_IPHONE)
             .when(eid % 4 == 2, AGENT_ANDROID))
    ref = F.lit(None).cast("string")
    for i, r in enumerate(REFERRERS):
        if r is not None:
            ref = F.when(eid % 5 == i, r).otherwise(ref)
    ts = F.col("ts").cast("timestamp")
    return events.select(
        eid.alias("event_id"),
        F.format_string("user_%06d", "user_id").alias("user_id"),
        F.format_string("product_%06d", k).alias("product_id"),
        F.when(F.col("event_type") == "signup", "add_to_cart").otherwise(F.col("event_type"))
         .alias("action_type"),
        ts.alias("timestamp"),
        F.format_string("s_%06d_%s", F.col("user_id"), F.date_format(ts, "yyyyMMdd"))
         .alias("session_id"),
        F.element_at(cats, k % 10 + 1).alias("product_category"),
        (F.col("value") * 4).alias("product_price"),
        agent.alias("user_agent"),
        F.format_string("10.0.%d.%d", F.floor(F.col("user_id") / 256).cast("int"),
                        (F.col("user_id") % 256).cast("int")).alias("ip_address"),
        ref.alias("referrer"),
    )


def behavior_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behaviour events of one scale-factor folder (session time zone UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return to_behavior_events(table(spark, sf_dir, "events"))


_CATS_SQL = "[" + ", ".join("'" + c + "'" for c in CATEGORIES) + "]"

BEHAVIOR_EVENTS_SQL = f"""
behavior_events AS (
  SELECT
    event_id,
    printf('user_%06d', user_id) AS user_id,
    printf('product_%06d', CAST(json_extract_string(props, '$.k') AS INTEGER)) AS product_id,
    CASE event_type WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS action_type,
    CAST(ts AS TIMESTAMP) AS "timestamp",
    printf('s_%06d_%s', user_id, strftime(ts, '%Y%m%d')) AS session_id,
    ({_CATS_SQL})[CAST(json_extract_string(props, '$.k') AS INTEGER) % 10 + 1] AS product_category,
    value * 4 AS product_price,
    CASE event_id % 4 WHEN 0 THEN '{AGENT_WINDOWS}' WHEN 1 THEN '{AGENT_IPHONE}'
                      WHEN 2 THEN '{AGENT_ANDROID}' END AS user_agent,
    printf('10.0.%d.%d', user_id // 256, user_id % 256) AS ip_address,
    CASE event_id % 5 WHEN 1 THEN '{REFERRERS[1]}' WHEN 2 THEN '{REFERRERS[2]}'
                      WHEN 3 THEN '{REFERRERS[3]}' WHEN 4 THEN '{REFERRERS[4]}' END AS referrer
  FROM events
)"""


def with_events(*ctes: str) -> str:
    """``WITH behavior_events AS (...), <ctes>`` prefix for an oracle query."""
    parts = [BEHAVIOR_EVENTS_SQL.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n"
