"""Per-event features.

``process_user_behavior`` adds 14 columns to an event frame and keeps every
row: price / device / referrer / time classes, the position of the event in
its session, a running session count, recent activity of the user in a
sliding frame of ``recent_seconds`` and two segment labels.

Window plan
-----------
The reference partitions its windows by ``user_id`` (recent activity) and by
``(user_id, session_id)`` (position in session). A single heavy key -- a bot,
a session that never ends, or all rows whose user is NULL -- would then sit
in one task. Two facts let the work be split much finer:

* the recent frame is measured in *whole seconds*, so events of a user in
  the same second are peers and can be summed before any window runs;
* a position in a session is "events of the session in earlier seconds"
  plus a position inside the event's own second.

So the plan works on per-second aggregates and touches each event row once:

1. ``recent``: events summed per ``(user, second)`` (map-side combine before
   the shuffle) and windowed over ``(user, time bucket)``, bucket width
   ``W >= frame``; the rows of the last ``frame`` seconds of a bucket are
   copied into the next bucket as *halo* rows, so every sliding frame lies
   inside one partition. A partition holds at most ``W + frame`` rows per
   user, whatever the user's event rate.
2. ``before``: events counted per ``(user, session, second)`` (map-side
   combine), then the session's events in earlier seconds: a running sum
   inside ``(user, session, bucket)`` plus one *offset* row per bucket
   carrying the earlier buckets' count (a window over one row per bucket).
3. The events, the ``recent`` rows and the ``before`` rows are shuffled
   together on ``(user, second)``; inside a second the event's position and
   running count (peers by exact timestamp) are added to ``before``. The
   largest group any task sees is one user's events of one second.

Only step 3 moves whole event rows; steps 1 and 2 read the four key and
value columns and move per-second sums.
The results equal the unsplit windows exactly (tests compare both on the
fixture, a hot user, NULL users and NULL times).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import (day_of_week, epoch_seconds, hour_of_day, is_mobile, is_weekend,
                         price_range, referrer_type, time_segment)
from ..schema import RECENT_WINDOW_SECONDS

DEFAULT_BUCKET_SECONDS = 3600


def add_basic_features(df: DataFrame) -> DataFrame:
    """price_range, is_mobile, referrer_type."""
    return df.withColumns({
        "price_range": price_range("product_price"),
        "is_mobile": is_mobile("user_agent"),
        "referrer_type": referrer_type("referrer"),
    })


def add_temporal_features(df: DataFrame) -> DataFrame:
    """hour_of_day, day_of_week, is_weekend, time_segment."""
    return df.withColumns({
        "hour_of_day": hour_of_day("timestamp"),
        "day_of_week": day_of_week("timestamp"),
        "is_weekend": is_weekend("timestamp"),
        "time_segment": time_segment("timestamp"),
    })


def add_aggregated_features(df: DataFrame, recent_seconds: int = RECENT_WINDOW_SECONDS,
                            tie_break: str | None = None,
                            bucket_seconds: int | None = DEFAULT_BUCKET_SECONDS,
                            earlier: DataFrame | None = None) -> DataFrame:
    """action_sequence, session_action_count, recent_view_count,
    recent_cart_count, avg_price_viewed (D1-D5).

    * ``action_sequence``: 1-based position in (user, session) by time;
      ``tie_break`` orders events with equal times (else arbitrary).
    * ``session_action_count``: *running* count of the session's events up
      to and including this time (equal times count together).
    * ``recent_*``: the user's views / carts in ``[t - recent_seconds, t]``
      (whole seconds, both ends inclusive, across sessions) and the mean
      price of those views (NULL without views).

    ``bucket_seconds=None`` runs the plain windows (one task per user);
    otherwise the per-second plan of the module docstring. ``earlier`` are
    events that count for those of ``df`` but get no row themselves; only
    their per-second sums are used, so their order inside a second of ``df``
    is open (they come first).
    """
    frame = int(recent_seconds)
    cols = df.columns
    if bucket_seconds is None:
        return _plain_windows(df, frame, tie_break).select(*cols, *WINDOW_COLS)
    width = max(int(bucket_seconds), frame, 1)
    recent = _recent_by_second(df, frame, width, earlier)
    before = _session_before(df, width, earlier)

    events = df.withColumns({"_sec": epoch_seconds("timestamp"), "_kind": F.lit(_EVENT)})
    rows = (events.unionByName(recent.withColumn("_kind", F.lit(_RECENT)), allowMissingColumns=True)
            .unionByName(before.withColumn("_kind", F.lit(_BEFORE)), allowMissingColumns=True))
    # Every spec sorts by (user, second, session, time[, tie]) or a prefix of
    # it, so the stage sorts once; the whole-partition frames ignore order.
    order = [F.col("timestamp").asc_nulls_first()] + ([F.col(tie_break).asc_nulls_first()] if tie_break else [])
    per_sec = Window.partitionBy("user_id", "_sec").orderBy(F.col("session_id").asc_nulls_first(), *order) \
        .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    in_sec = Window.partitionBy("user_id", "_sec", "session_id")
    seq = in_sec.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = in_sec.orderBy(F.col("timestamp").asc_nulls_first()) \
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    is_event = F.when(F.col("_kind") == _EVENT, F.lit(1)).otherwise(F.lit(0)).cast("long")
    out = (rows.repartition("user_id", "_sec")
           .withColumns({"_seq": F.sum(is_event).over(seq), "_run": F.sum(is_event).over(running)})
           .withColumns({"_base": F.coalesce(F.max("_before").over(in_sec), F.lit(0).cast("long")),
                         "_rv": F.max("recent_view_count").over(per_sec),
                         "_rc": F.max("recent_cart_count").over(per_sec),
                         "_ra": F.max("avg_price_viewed").over(per_sec)})
           .where(F.col("_kind") == _EVENT))
    return out.select(*cols,
                      (F.col("_base") + F.col("_seq")).cast("int").alias("action_sequence"),
                      (F.col("_base") + F.col("_run")).alias("session_action_count"),
                      F.col("_rv").alias("recent_view_count"),
                      F.col("_rc").alias("recent_cart_count"),
                      F.col("_ra").alias("avg_price_viewed"))


WINDOW_COLS = ["action_sequence", "session_action_count", "recent_view_count",
               "recent_cart_count", "avg_price_viewed"]
_EVENT, _RECENT, _BEFORE = 0, 1, 2
_HOME = 0


def activity_sums(df: DataFrame) -> DataFrame:
    """Views, carts, priced views and their price per (user, second)."""
    action = F.col("action_type")
    view_price = F.when(action == "view", F.col("product_price").cast("double"))
    return (df.select("user_id", epoch_seconds("timestamp").alias("_sec"),
                      F.when(action == "view", 1).otherwise(0).alias("_v"),
                      F.when(action == "add_to_cart", 1).otherwise(0).alias("_c"),
                      view_price.alias("_p"))
            .groupBy("user_id", "_sec")
            .agg(F.sum("_v").alias("_v"), F.sum("_c").alias("_c"),
                 F.count("_p").alias("_pn"), F.sum("_p").alias("_ps")))


def session_sums(df: DataFrame) -> DataFrame:
    """Events per (user, session, second)."""
    return (df.select("user_id", "session_id", epoch_seconds("timestamp").alias("_sec"))
            .groupBy("user_id", "session_id", "_sec").agg(F.count(F.lit(1)).alias("_n")))


def _recent_by_second(df: DataFrame, frame: int, width: int, earlier: DataFrame | None = None) -> DataFrame:
    """``(user_id, _sec, recent_view_count, recent_cart_count,
    avg_price_viewed)`` over ``[_sec - frame, _sec]``. The events are summed
    per (user, second) with a map-side combine; the sums are windowed in time
    buckets with halo rows, so no partition holds more than
    ``width + frame`` rows of a user, whatever the user's event rate."""
    per_user = activity_sums(df)
    if earlier is not None:
        per_user = per_user.unionByName(activity_sums(earlier)).groupBy("user_id", "_sec").agg(
            *[F.sum(c).alias(c) for c in ("_v", "_c", "_pn", "_ps")])
    tb = F.floor(F.col("_sec") / F.lit(width))
    spread = per_user.withColumn("_tb", tb).withColumn(
        "_buckets",
        F.when(F.col("_sec") >= (F.col("_tb") + 1) * width - frame,
               F.array(F.col("_tb"), F.col("_tb") + 1)).otherwise(F.array(F.col("_tb"))))
    rows = spread.select("user_id", "_sec", "_v", "_c", "_pn", "_ps",
                         F.posexplode("_buckets").alias("_kind", "_bucket"))
    w = Window.partitionBy("user_id", "_bucket").orderBy("_sec").rangeBetween(-frame, 0)
    pn = F.sum("_pn").over(w)
    return (rows.repartition("user_id", "_bucket")
            .select("user_id", "_sec", "_kind",
                    F.sum("_v").over(w).alias("recent_view_count"),
                    F.sum("_c").over(w).alias("recent_cart_count"),
                    F.when(pn > 0, F.sum("_ps").over(w) / pn).alias("avg_price_viewed"))
            .where(F.col("_kind") == _HOME).drop("_kind"))


def _session_before(df: DataFrame, width: int, earlier: DataFrame | None = None) -> DataFrame:
    """``(user_id, session_id, _sec, _before)``: events of the session in
    earlier seconds (NULL times first), and those of ``earlier`` in the same
    second. Events are counted per (user,
    session, second) with a map-side combine; running sums inside
    ``(user, session, bucket)``; one offset row per bucket carries the
    earlier buckets' count, from a window over one row per bucket."""
    seconds = session_sums(df).withColumn("_early", F.lit(0).cast("long"))
    if earlier is not None:
        seconds = seconds.unionByName(session_sums(earlier).withColumn("_early", F.col("_n"))) \
            .groupBy("user_id", "session_id", "_sec").agg(F.sum("_n").alias("_n"), F.sum("_early").alias("_early"))
    rows = seconds.select("user_id", "session_id", "_sec", "_n", "_early",
                          F.floor(F.col("_sec") / F.lit(width)).alias("_bucket"))
    per_bucket = rows.groupBy("user_id", "session_id", "_bucket").agg(F.sum("_n").alias("_cnt"))
    earlier = Window.partitionBy("user_id", "session_id").orderBy(F.col("_bucket").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    offsets = (per_bucket.withColumn("_n", F.sum("_cnt").over(earlier)).where(F.col("_n") > 0)
               .select("user_id", "session_id", "_bucket", "_n", F.lit(True).alias("_offset")))
    home = rows.withColumn("_offset", F.lit(False))
    prior = Window.partitionBy("user_id", "session_id", "_bucket") \
        .orderBy(F.col("_offset").desc(), F.col("_sec").asc_nulls_first()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return (home.unionByName(offsets, allowMissingColumns=True)
            .repartition("user_id", "session_id", "_bucket")
            .withColumn("_before", F.coalesce(F.sum("_n").over(prior), F.lit(0).cast("long")) + F.col("_early"))
            .where(~F.col("_offset"))
            .select("user_id", "session_id", "_sec", "_before"))


def _plain_windows(df: DataFrame, frame: int, tie_break: str | None) -> DataFrame:
    """The unsplit windows: user first, so one Exchange serves both specs."""
    recent = Window.partitionBy("user_id").orderBy("_ts_unix").rangeBetween(-frame, 0)
    session = Window.partitionBy("user_id", "session_id")
    order = ["timestamp"] + ([tie_break] if tie_break else [])
    return (df.withColumn("_ts_unix", epoch_seconds("timestamp"))
            .withColumns({
                "recent_view_count": F.sum(F.when(F.col("action_type") == "view", 1).otherwise(0)).over(recent),
                "recent_cart_count": F.sum(F.when(F.col("action_type") == "add_to_cart", 1).otherwise(0)).over(recent),
                "avg_price_viewed": F.avg(F.when(F.col("action_type") == "view",
                                                 F.col("product_price").cast("double"))).over(recent),
            })
            .withColumns({
                "action_sequence": F.row_number().over(session.orderBy(*order)),
                "session_action_count": F.count(F.lit(1)).over(session.orderBy("timestamp")),
            }))


def add_user_segments(df: DataFrame) -> DataFrame:
    """user_behavior_type and engagement_level (B8, B9); first match wins."""
    return df.withColumns({
        "user_behavior_type": (
            F.when((F.col("recent_cart_count") > 0) & (F.col("action_sequence") <= 3), "quick_buyer")
            .when(F.col("recent_view_count") > 5, "browser")
            .when((F.col("action_type") == "purchase") & (F.col("session_action_count") <= 2), "direct_buyer")
            .otherwise("casual_visitor")),
        "engagement_level": (
            F.when(F.col("session_action_count") >= 10, "high")
            .when(F.col("session_action_count") >= 5, "medium")
            .otherwise("low")),
    })


def process_user_behavior(df: DataFrame, recent_seconds: int = RECENT_WINDOW_SECONDS,
                          tie_break: str | None = None,
                          bucket_seconds: int = DEFAULT_BUCKET_SECONDS,
                          earlier: DataFrame | None = None) -> DataFrame:
    """Full feature set: basic, temporal, windows, segments.

    The windows run on per-second rows at every size (``add_aggregated_features``).

    The per-row classes do not depend on the windows, so they are computed
    after the window shuffle: the shuffle then carries only the input
    columns. The output column order is the reference's.
    """
    cols = df.columns
    windowed = add_aggregated_features(df, recent_seconds=recent_seconds, tie_break=tie_break,
                                       bucket_seconds=bucket_seconds, earlier=earlier)
    out = windowed.transform(add_basic_features).transform(add_temporal_features) \
        .transform(add_user_segments)
    return out.select(*cols, *BASIC_COLS, *TEMPORAL_COLS, *WINDOW_COLS, *SEGMENT_COLS)


BASIC_COLS = ["price_range", "is_mobile", "referrer_type"]
TEMPORAL_COLS = ["hour_of_day", "day_of_week", "is_weekend", "time_segment"]
SEGMENT_COLS = ["user_behavior_type", "engagement_level"]
