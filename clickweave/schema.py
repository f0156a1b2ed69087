"""Event record, column names and the fixed values the operators share."""

from __future__ import annotations

from pyspark.sql import types as T

# Wire format of one behaviour event (every field nullable). The price is a
# float on the wire; ``decode_events`` widens it to double right away so that
# averages are computed in double precision.
BEHAVIOR_SCHEMA = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("product_id", T.StringType(), True),
    T.StructField("action_type", T.StringType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("session_id", T.StringType(), True),
    T.StructField("product_category", T.StringType(), True),
    T.StructField("product_price", T.FloatType(), True),
    T.StructField("user_agent", T.StringType(), True),
    T.StructField("ip_address", T.StringType(), True),
    T.StructField("referrer", T.StringType(), True),
])

EVENT_COLUMNS = [f.name for f in BEHAVIOR_SCHEMA.fields]

# Metadata columns that travel with a decoded stream record.
RECORD_METADATA = ["kafka_key", "topic", "partition", "offset", "kafka_timestamp"]

# --- fixed values that must equal the reference's -------------------------
# Known actions (others are kept and weigh 1.0).
ACTIONS = ["view", "click", "add_to_cart", "purchase"]

# Interaction weight per action; any other (or null) action weighs 1.0.
ACTION_WEIGHTS = {"purchase": 4.0, "add_to_cart": 3.0, "click": 2.0}
DEFAULT_ACTION_WEIGHT = 1.0

# Product categories, in this order.
CATEGORIES = ["Electronics", "Fashion", "Home & Garden", "Books", "Sports",
              "Beauty", "Toys", "Food & Beverage", "Automotive", "Health"]

# Serving summary lifetimes in seconds (recent behaviours, category interests,
# price preferences, action counts, session).
TTL_RECENT_BEHAVIORS = 86400 * 7
TTL_CATEGORY_INTERESTS = 86400 * 30
TTL_PRICE_PREFERENCES = 86400 * 30
TTL_ACTION_COUNTS = 86400 * 30
TTL_SESSION = 3600

RECENT_BEHAVIORS_KEEP = 100          # newest behaviours kept per user
RECENT_WINDOW_SECONDS = 600          # sliding frame of the recent-activity features
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # text form of times in serving summaries
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ssXXX"  # time range arguments
# --------------------------------------------------------------------------
