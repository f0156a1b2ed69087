"""Per-row column expressions (all JVM-side, codegen friendly).

Every function takes column names or ``Column`` objects and returns a
``Column``; nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import ACTION_WEIGHTS, DEFAULT_ACTION_WEIGHT, ISO_FORMAT, TIME_FORMAT


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- classes ----------------------------------------------------------------

def price_range(price="product_price") -> Column:
    """3-level price class: <50 low, <200 medium, else (null included) high."""
    p = _c(price)
    return F.when(p < 50, "low").when(p < 200, "medium").otherwise("high")


def is_mobile(agent="user_agent") -> Column:
    """Case-insensitive mobile / android / iphone match; null agent gives null."""
    return _c(agent).rlike("(?i)mobile|android|iphone")


def referrer_type(referrer="referrer") -> Column:
    """null -> direct, contains google -> search, facebook -> social, else other.

    Matching is case sensitive and the first match wins; the literal string
    'direct' is *not* null and therefore classed as 'other'.
    """
    r = _c(referrer)
    return (F.when(r.isNull(), "direct")
            .when(r.contains("google"), "search")
            .when(r.contains("facebook"), "social")
            .otherwise("other"))


def price_band(price="product_price") -> Column:
    """5-band price class used by the price preference summary."""
    p = _c(price)
    return (F.when(p < 50, "0-50").when(p < 100, "50-100").when(p < 200, "100-200")
            .when(p < 500, "200-500").when(p.isNotNull(), "500+"))


def action_weight(action="action_type") -> Column:
    """Interaction weight of an action; unknown and null actions weigh 1.0."""
    a = _c(action)
    expr = None
    for name, w in ACTION_WEIGHTS.items():
        expr = F.when(a == name, F.lit(w)) if expr is None else expr.when(a == name, F.lit(w))
    return expr.otherwise(F.lit(DEFAULT_ACTION_WEIGHT))


def is_action(action: str, col="action_type") -> Column:
    return _c(col) == action


def count_if_action(action: str, col="action_type") -> Column:
    """1 for rows of ``action`` else 0 (null action counts 0)."""
    return F.when(_c(col) == action, 1).otherwise(0)


# --- time -------------------------------------------------------------------

def hour_of_day(ts="timestamp") -> Column:
    return F.hour(_c(ts))


def day_of_week(ts="timestamp") -> Column:
    """1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_c(ts))


def is_weekend(ts="timestamp") -> Column:
    """Saturday or Sunday; a null time gives False."""
    return F.when(F.dayofweek(_c(ts)).isin(1, 7), True).otherwise(False)


def time_segment(ts="timestamp") -> Column:
    """6-11 morning, 12-17 afternoon, 18-22 evening, else (null too) night."""
    h = F.hour(_c(ts))
    return (F.when(h.between(6, 11), "morning")
            .when(h.between(12, 17), "afternoon")
            .when(h.between(18, 22), "evening")
            .otherwise("night"))


def event_date(ts="timestamp") -> Column:
    return F.to_date(_c(ts))


def epoch_seconds(ts="timestamp") -> Column:
    """Whole seconds since the epoch (sub-seconds truncated)."""
    return F.unix_timestamp(_c(ts))


def format_time(ts="timestamp") -> Column:
    return F.date_format(_c(ts), TIME_FORMAT)


def parse_iso(text) -> Column:
    """ISO-8601 text with offset, e.g. ``2024-01-01T00:00:00+00:00``."""
    v = F.lit(text) if isinstance(text, str) else text
    return F.to_timestamp(v, ISO_FORMAT)


# --- text -------------------------------------------------------------------

def behavior_json(product="product_id", action="action_type", category="product_category",
                  price="product_price", ts="timestamp") -> Column:
    """One recent-behaviour entry as JSON text (category renamed, price double)."""
    return F.to_json(F.struct(
        _c(product).alias("product_id"),
        _c(action).alias("action_type"),
        _c(category).alias("category"),
        _c(price).cast("double").alias("price"),
        format_time(ts).alias("timestamp"),
    ), {"ignoreNullFields": "false"})


def serving_key(kind: str, ident, suffix: str | None = None) -> Column:
    """``kind:<id>[:suffix]`` key text, e.g. ``user:u1:recent_behaviors``."""
    parts = [F.lit(f"{kind}:"), _c(ident)]
    if suffix:
        parts.append(F.lit(f":{suffix}"))
    return F.concat(*parts)


# --- arithmetic ---------------------------------------------------------------

def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI mode would raise on /0)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))
