"""Cross-batch features (H8): the window features of
``operators.features`` computed across micro-batches with keyed state.

Per-batch windows (H7) restart every trigger. Here each user keeps, in the
state store, per-second sums of their last ``recent_seconds`` (the frame is
in whole seconds, so events of one second merge: at most ``frame + 1``
entries per user, whatever the user's event rate) and a counter per
session, so a micro-batch continues where the previous one stopped. On
input that arrives in time order the result equals the batch computation
over all rows. Users are handled in buckets (a hash of the user), all users of a
bucket at once with numpy, on the bucket's rows of one micro-batch (bounded by
the trigger size, not by the history).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schema import RECENT_WINDOW_SECONDS
from .live_serving import BUCKETS, begins, by_bucket, chosen, joined, load_table, micros, numbered, places, store_table, texts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_SESSION_SCHEMA = "seen long"
_APART = 1 << 40  # seconds between users in one sorted column
FEATURE_FIELDS = [
    T.StructField("action_sequence", T.IntegerType()),
    T.StructField("session_action_count", T.LongType()),
    T.StructField("recent_view_count", T.LongType()),
    T.StructField("recent_cart_count", T.LongType()),
    T.StructField("avg_price_viewed", T.DoubleType()),
]


class RecentActivity(StatefulProcessor):
    """State per bucket: per-second sums of its users' recent events (a table), and
    events seen per user and session (map)."""
    # one entry per user and second of the frame
    RECENT = pa.schema([("key", pa.string()), ("sec", pa.int64()), ("views", pa.int64()), ("carts", pa.int64()),
                        ("priced", pa.int64()), ("price", pa.float64())])

    def __init__(self, columns: list[str], recent_seconds: int = RECENT_WINDOW_SECONDS,
                 session_ttl_ms: int | None = None):
        self.columns = columns
        self.frame = int(recent_seconds)
        self.session_ttl_ms = session_ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "rows binary")
        self.sessions = handle.getMapState("sessions", "user_id string, session_id string", _SESSION_SCHEMA,
                                           self.session_ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        cur = pd.concat(list(rows), ignore_index=True)
        user, names = numbered(texts(cur["user_id"]))
        t = micros(cur)
        c_ts = t // 1_000_000
        price = cur["product_price"].astype("float64").to_numpy()
        view = (cur["action_type"] == "view").to_numpy().astype("int64")
        priced = (view == 1) & ~np.isnan(price)

        # per-second sums: the state's seconds plus this batch's events
        held = load_table(self.recent, self.RECENT)
        at = places(names, held["key"])
        batch = {"key": names[user], "sec": c_ts, "views": view, "carts": (cur["action_type"] == "add_to_cart").to_numpy().astype("int64"),
                 "priced": priced.astype("int64"), "price": np.where(priced, price, 0.0)}
        every, code = joined([chosen(held, at >= 0), batch]), np.concatenate([at[at >= 0], user])
        order = np.lexsort((every["sec"], code))
        every, code = chosen(every, order), code[order]
        begin = begins(code, every["sec"])
        secs = {c: np.add.reduceat(v, begin) if c not in ("key", "sec") else v[begin] for c, v in every.items()}
        code = code[begin]

        # sums over [t - frame, t] (whole seconds, both ends, equal seconds included)
        place = code * _APART + secs["sec"]
        lo = np.searchsorted(place, user * _APART + c_ts - self.frame, side="left")
        hi = np.searchsorted(place, user * _APART + c_ts, side="right")

        def over(column):
            # a running sum of each user's own, so that no user's prices blur another's
            upto = pd.Series(secs[column]).groupby(code).cumsum().to_numpy()
            before = np.where((lo > 0) & (code[np.maximum(lo - 1, 0)] == user), upto[np.maximum(lo - 1, 0)], 0)
            return upto[hi - 1] - before

        n_priced = over("priced")
        avg = np.where(n_priced > 0, over("price") / np.maximum(n_priced, 1), np.nan)

        # position and running count inside the session, continuing the state
        session, session_names = numbered(texts(cur["session_id"]))
        both = user * len(session_names) + session
        order = np.lexsort((t, both))
        first = begins(both[order])
        count = np.diff(np.append(first, len(order)))
        seen = np.zeros(len(first), "int64")
        for i, (f, n) in enumerate(zip(order[first], count)):
            # a null counts on like any other, under a name that none has
            name = tuple(f"={x}" if isinstance(x, str) else "" for x in (names[user[f]], session_names[session[f]]))
            old = self.sessions.getValue(name)
            seen[i] = int(old[0]) if old is not None else 0
            self.sessions.updateValue(name, (int(seen[i] + n),))
        offset = np.repeat(seen - first, count)
        peers = begins(both[order], t[order])  # peers share a count
        seq, run = np.zeros(len(cur), "int64"), np.zeros(len(cur), "int64")
        seq[order] = offset + np.arange(1, len(order) + 1)
        ends = np.append(peers[1:], len(order))
        run[order] = offset + np.repeat(ends, ends - peers)

        # keep only what a later event can still see
        newest = secs["sec"][np.append(begins(code)[1:], len(code)) - 1]
        store_table(self.recent, self.RECENT, joined([chosen(held, at < 0), chosen(secs, secs["sec"] >= newest[code] - self.frame)]))

        out = cur[self.columns].copy()
        out["action_sequence"] = seq.astype("int32")
        out["session_action_count"] = run
        out["recent_view_count"] = over("views")
        out["recent_cart_count"] = over("carts")
        out["avg_price_viewed"] = avg
        yield out

    def close(self) -> None:
        pass


STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB,
              "spark.sql.streaming.noDataMicroBatches.enabled": "false"}


def configure(spark) -> None:
    """Session settings for ``stateful_features``: the RocksDB state store,
    and no empty micro-batches -- the processor sets no timers, and with
    processing time enabled (needed for state TTL) empty batches would keep
    an ``availableNow`` query from finishing."""
    for k, v in STATE_CONF.items():
        spark.conf.set(k, v)


@contextmanager
def configured(spark):
    """The same settings for a query started inside; a started query has its
    own copy of the session's settings, so they are put back at the end."""
    old = {k: spark.conf.get(k, None) for k in STATE_CONF}
    configure(spark)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stateful_features(events: DataFrame, recent_seconds: int = RECENT_WINDOW_SECONDS,
                      session_ttl_ms: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Streaming (or batch) frame + the five window features, with state
    across micro-batches (H8). Call ``configure(spark)`` first.

    Session counters stay for good, as in the batch operator;
    ``session_ttl_ms`` drops them that long (processing time) after their
    last update, which bounds the state of a job that runs for ever."""
    out_schema = T.StructType(list(events.schema.fields) + FEATURE_FIELDS)
    return by_bucket(events, "user_id", events.columns, buckets).transformWithStateInPandas(
        statefulProcessor=RecentActivity(events.columns, recent_seconds, session_ttl_ms),
        outputStructType=out_schema, outputMode="Append", timeMode="ProcessingTime")
