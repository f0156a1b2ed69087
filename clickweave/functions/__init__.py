"""Scalar column functions."""

from .columns import (action_weight, behavior_json, count_if_action, day_of_week,
                      epoch_seconds, event_date, format_time, hour_of_day, is_action,
                      is_mobile, is_weekend, parse_iso, price_band, price_range,
                      referrer_type, safe_ratio, serving_key, time_segment)

__all__ = [
    "action_weight", "behavior_json", "count_if_action", "day_of_week", "epoch_seconds",
    "event_date", "format_time", "hour_of_day", "is_action", "is_mobile", "is_weekend",
    "parse_iso", "price_band", "price_range", "referrer_type", "safe_ratio", "serving_key",
    "time_segment",
]
