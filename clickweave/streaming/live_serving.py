"""Live serving state with sliding expiry (H9, streaming form).

Per user the state holds the current run (start, last write) and the
counters of that run: events per category, per 5-band price class and per
action (C7-C9). A micro-batch first checks, in event time, whether the key
expired before or between its new events (a gap of ``ttl`` or more) -- an
expired key restarts from zero -- then adds the batch's events and emits
the user's full current counters. The newest emission per user is the
live summary; on input in time order it equals ``operators.serving`` with
the same TTL. State per user is bounded (a few dozen counters).

``live_sessions`` does the same for the session record (C10): start time
and user are set by the first event of a run, the last activity and the
count follow every event, and a session idle for ``ttl`` restarts.

``live_recent`` keeps the newest behaviours (C6) as a list of bounded length,
newest first. A late row is put in its place; it may also join two runs of the
key into one, so runs that a row ahead of the watermark can still reach are
kept beside the newest (``start, last`` each).

State is kept in *buckets* of keys (a hash of the key), and one call handles all
keys of a bucket with numpy: a call and each use of the state cost far more than
the few events a key has in a micro-batch. The state of a bucket is a table or
two in Arrow form. A bucket's rows arrive as Arrow chunks; each chunk is reduced
at once to per-second first / last times and per-(second, field) counts (a TTL
is at least a second, so only the first event of a second can start a run).
Memory per bucket then grows with its live keys and the seconds and fields the
batch covers, not with a key's event count. ``buckets`` is fixed by the
checkpoint; take it larger where a bucket would hold too many keys.

All run in event-time mode: after each write an event-time timer is set at the
first ``last write + ttl`` of the bucket, and when the watermark passes it the
keys that have expired are deleted. State thus only holds keys that are still
alive, as the store's expiry would.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..schema import RECENT_BEHAVIORS_KEEP, TTL_CATEGORY_INTERESTS, TTL_RECENT_BEHAVIORS, TTL_SESSION

OUTPUT_SCHEMA = ("user_id string, kind string, field string, count long, "
                 "run_start timestamp, last_write timestamp")
KINDS = ("category_interests", "price_preferences", "action_counts")
BUCKETS = 1024
NEVER = np.iinfo("int64").min // 2

Columns = dict[str, np.ndarray]


# --- buckets -----------------------------------------------------------------


def by_bucket(events: DataFrame, key: str, columns: list[str], buckets: int):
    """The columns needed, grouped by a hash of the key."""
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("_bucket")
    return events.select(bucket, *dict.fromkeys([key, *columns])).groupBy("_bucket")


def load_table(state, schema: pa.Schema) -> Columns:
    """A table kept as one Arrow value; empty if there is none."""
    held = state.get()
    table = pa.ipc.open_stream(bytes(held[0])).read_all() if held is not None else schema.empty_table()
    return {n: table.column(n).to_numpy() for n in schema.names}


def store_table(state, schema: pa.Schema, columns: Columns) -> None:
    if not len(columns[schema.names[0]]):
        state.clear()
        return
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as out:
        out.write_table(pa.table([pa.array(columns[f.name], f.type, from_pandas=pa.types.is_string(f.type)) for f in schema], schema=schema))
    state.update((sink.getvalue().to_pybytes(),))


def joined(parts: list[Columns]) -> Columns:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def chosen(columns: Columns, which: np.ndarray) -> Columns:
    return {c: v[which] for c, v in columns.items()}


def texts(values: pd.Series) -> np.ndarray:
    out = values.to_numpy(object).copy()
    out[pd.isna(out)] = None
    return out


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the keys and the distinct keys; null is a key like any other."""
    code, names = pd.factorize(keys, use_na_sentinel=False)
    names = np.asarray(names, object)
    names[pd.isna(names)] = None
    return code, names


def places(names: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The place of each of ``keys`` among the distinct ``names``, or -1."""
    at = {k: i for i, k in enumerate(names)}
    return np.fromiter((at.get(k, -1) for k in keys), "int64", len(keys))


def begins(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination begins in sorted columns."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def micros(frame: pd.DataFrame) -> np.ndarray:
    return pd.to_datetime(frame["timestamp"]).astype("datetime64[us]").astype("int64").to_numpy()


def times(us: np.ndarray) -> pd.Series:
    return pd.Series(pd.to_datetime(us, unit="us"))


def _expire_at(handle: StatefulProcessorHandle, last_us: np.ndarray, ttl_us: int) -> None:
    """One event-time timer per bucket, at the first expiry of a key."""
    for old in list(handle.listTimers()):
        handle.deleteTimer(old)
    if len(last_us):
        handle.registerTimer((int(last_us.min()) + ttl_us) // 1000)


def _alive(last_us: np.ndarray, ttl_us: int, timer_values) -> np.ndarray:
    return (last_us + ttl_us) // 1000 > timer_values.getCurrentWatermarkInMs()


def _bands(price: np.ndarray) -> np.ndarray:
    return np.select([price < 50, price < 100, price < 200, price < 500, ~np.isnan(price)],
                     ["0-50", "50-100", "100-200", "200-500", "500+"], default=None).astype(object)


# --- seconds and runs ----------------------------------------------------------


def _seconds_of_chunk(code: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows by key and time (arrival order breaks ties), and the begin and end
    of each (key, second) in that order."""
    order = np.lexsort((t, code))
    begin = begins(code[order], t[order] // 1_000_000)
    return order, begin, np.append(begin[1:], len(order))


def _merged_seconds(secs: Columns, code: np.ndarray) -> tuple[Columns, np.ndarray]:
    """Per-second rows of several chunks -> one per (key, second), in order:
    first / last time, number of events, and what the earliest event has."""
    order = np.lexsort((secs["first"], secs["sec"], code))
    secs, code = chosen(secs, order), code[order]
    begin = begins(code, secs["sec"])
    out = chosen(secs, begin)
    out["last"] = np.maximum.reduceat(secs["last"], begin)
    out["n"] = np.add.reduceat(secs["n"], begin)
    return out, code[begin]


def _newest_run(secs: Columns, code: np.ndarray, held_last: np.ndarray, ttl_us: int) -> tuple[np.ndarray, ...]:
    """For each key: its first and last second, the one its newest run begins
    with, and whether the run begins in this batch."""
    first_at = begins(code)
    last_at = np.append(first_at[1:], len(code)) - 1
    prev = np.concatenate([[NEVER], secs["last"][:-1]])
    prev[first_at] = held_last[code[first_at]]
    # only the first event of a second can follow a gap of ttl or more
    newest = np.maximum.reduceat(np.where(secs["first"] - prev >= ttl_us, np.arange(len(code)), -1), first_at)
    return first_at, last_at, np.where(newest >= 0, newest, first_at), newest >= 0


def _held(columns: Columns, value: str, at: np.ndarray, size: int, default) -> np.ndarray:
    """``value`` of the keys of the state that are among those of the batch."""
    out = np.full(size, default, columns[value].dtype if columns[value].dtype != object else object)
    out[at[at >= 0]] = columns[value][at >= 0]
    return out


class UserCounters(StatefulProcessor):
    RUNS = pa.schema([("key", pa.string()), ("start", pa.int64()), ("last", pa.int64())])
    COUNTS = pa.schema([("key", pa.string()), ("kind", pa.int64()), ("field", pa.string()), ("n", pa.int64())])

    def __init__(self, ttl_seconds: int = TTL_CATEGORY_INTERESTS):
        self.ttl_us = int(ttl_seconds) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "rows binary")
        self.counts = handle.getValueState("counts", "rows binary")

    def _reduced(self, rows) -> tuple[Columns, Columns]:
        """A bucket's rows of one micro-batch, reduced chunk by chunk (Arrow
        batches) to seconds (key, sec, first, last, n) and fields (key, sec,
        kind, field, n)."""
        sec_parts, field_parts = [], []
        for chunk in rows:
            code, names = numbered(texts(chunk["user_id"]))
            t = micros(chunk)
            order, begin, end = _seconds_of_chunk(code, t)
            key, sec = names[code[order][begin]], t[order][begin] // 1_000_000
            sec_parts.append({"key": key, "sec": sec, "first": t[order][begin], "last": t[order][end - 1], "n": end - begin})
            at = np.repeat(np.arange(len(begin)), end - begin)
            price = chunk["product_price"].astype("float64").to_numpy()
            for kind, vals in enumerate([chunk["product_category"].to_numpy(object), _bands(price),
                                         chunk["action_type"].to_numpy(object)]):
                field, fields = pd.factorize(vals[order])
                both, n = np.unique((at * max(len(fields), 1) + field)[field >= 0], return_counts=True)
                at_sec = both // max(len(fields), 1)
                field_parts.append({"key": key[at_sec], "sec": sec[at_sec], "kind": np.full(len(both), kind, "int64"),
                                    "field": np.asarray(fields, object)[both % max(len(fields), 1)], "n": n.astype("int64")})
        return joined(sec_parts), joined(field_parts)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        secs, fields = self._reduced(rows)
        runs, counts = load_table(self.runs, self.RUNS), load_table(self.counts, self.COUNTS)
        code, names = numbered(np.concatenate([secs["key"], fields["key"]]))
        secs, sec_code = _merged_seconds(secs, code[:len(secs["key"])])
        field_code = code[-len(fields["key"]):] if len(fields["key"]) else code[:0]
        at = places(names, runs["key"])
        held_start, held_last = (_held(runs, c, at, len(names), NEVER) for c in ("start", "last"))
        first_at, last_at, newest, restarts = _newest_run(secs, sec_code, held_last, self.ttl_us)
        # the keys are numbered, and every one has seconds, so this is in their order
        early = secs["first"][first_at]
        # rows a little late may open the run earlier than its state says
        start = np.where(restarts, secs["first"][newest], np.minimum(held_start, early))
        last = np.maximum(secs["last"][last_at], held_last)
        since = np.where(restarts, secs["sec"][newest], NEVER)

        live = fields["sec"] >= since[field_code]
        old = places(names, counts["key"])
        goes_on = (old >= 0) & ~restarts[old]
        all_code = np.concatenate([field_code[live], old[goes_on]])
        kind = np.concatenate([fields["kind"][live], counts["kind"][goes_on]])
        field, field_names = pd.factorize(np.concatenate([fields["field"][live], counts["field"][goes_on]]).astype(object))
        n = np.concatenate([fields["n"][live], counts["n"][goes_on]])
        order = np.lexsort((field, kind, all_code))
        all_code, kind, field, n = all_code[order], kind[order], field[order], n[order]
        begin = begins(all_code, kind, field)
        all_code, kind, field = all_code[begin], kind[begin], np.asarray(field_names, object)[field[begin]]
        n = np.add.reduceat(n, begin) if len(begin) else n

        self._store(joined([chosen(runs, at < 0), {"key": names, "start": start, "last": last}]),
                    joined([chosen(counts, old < 0), {"key": names[all_code], "kind": kind, "field": field, "n": n}]), timerValues)
        yield pd.DataFrame({"user_id": names[all_code], "kind": np.array(KINDS, object)[kind], "field": field, "count": n,
                            "run_start": times(start[all_code]), "last_write": times(last[all_code])})

    def _store(self, runs: Columns, counts: Columns, timer_values) -> None:
        alive = _alive(runs["last"], self.ttl_us, timer_values)
        kept = chosen(runs, alive)
        if not alive.all():
            counts = chosen(counts, places(kept["key"], counts["key"]) >= 0)
        store_table(self.runs, self.RUNS, kept)
        store_table(self.counts, self.COUNTS, counts)
        _expire_at(self.handle, kept["last"], self.ttl_us)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(load_table(self.runs, self.RUNS), load_table(self.counts, self.COUNTS), timerValues)
        yield from ()

    def close(self) -> None:
        pass


def live_counters(events: DataFrame, ttl_seconds: int = TTL_CATEGORY_INTERESTS, buckets: int = BUCKETS) -> DataFrame:
    """Streaming frame of storable events with an event-time watermark ->
    updated counters per user and micro-batch (``OUTPUT_SCHEMA``). Call
    ``stateful.configure(spark)`` first."""
    return by_bucket(events, "user_id", ["timestamp", "product_price", "product_category", "action_type"], buckets) \
        .transformWithStateInPandas(statefulProcessor=UserCounters(ttl_seconds), outputStructType=OUTPUT_SCHEMA,
                                    outputMode="Update", timeMode="EventTime")


SESSION_OUTPUT_SCHEMA = ("session_id string, user_id string, start_time timestamp, "
                         "last_activity timestamp, action_count long")


class SessionRecord(StatefulProcessor):
    RECORDS = pa.schema([("key", pa.string()), ("start", pa.int64()), ("user", pa.string()), ("last", pa.int64()), ("n", pa.int64())])

    def __init__(self, ttl_seconds: int = TTL_SESSION):
        self.ttl_us = int(ttl_seconds) * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.records = handle.getValueState("records", "rows binary")

    def _reduced(self, rows) -> Columns:
        """A bucket's rows of one micro-batch, reduced chunk by chunk to one row
        per session and second: first / last time, the user of the earliest
        event (arrival order breaks ties) and the event count."""
        parts = []
        for chunk in rows:
            code, names = numbered(texts(chunk["session_id"]))
            t, user = micros(chunk), texts(chunk["user_id"])
            order, begin, end = _seconds_of_chunk(code, t)
            first = t[order][begin]
            parts.append({"key": names[code[order][begin]], "sec": first // 1_000_000, "first": first,
                          "last": t[order][end - 1], "user": user[order][begin], "n": end - begin})
        return joined(parts)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        secs, held = self._reduced(rows), load_table(self.records, self.RECORDS)
        code, names = numbered(secs["key"])
        secs, code = _merged_seconds(secs, code)
        at = places(names, held["key"])
        held_start, held_last = (_held(held, c, at, len(names), NEVER) for c in ("start", "last"))
        held_n, held_user = _held(held, "n", at, len(names), 0), _held(held, "user", at, len(names), None)
        first_at, last_at, newest, restarts = _newest_run(secs, code, held_last, self.ttl_us)
        early = secs["first"][first_at]
        by_batch = restarts | (early < held_start)  # the run's first event is in this batch
        total = np.concatenate([[0], np.cumsum(secs["n"])])
        now = {"key": names, "start": np.where(restarts, secs["first"][newest], np.minimum(held_start, early)),
               "user": np.where(by_batch, secs["user"][newest], held_user),
               "last": np.maximum(secs["last"][last_at], held_last),
               "n": total[last_at + 1] - total[newest] + np.where(restarts, 0, held_n)}
        self._store(joined([chosen(held, at < 0), now]), timerValues)
        yield pd.DataFrame({"session_id": names, "user_id": now["user"], "start_time": times(now["start"]),
                            "last_activity": times(now["last"]), "action_count": now["n"]})

    def _store(self, records: Columns, timer_values) -> None:
        kept = chosen(records, _alive(records["last"], self.ttl_us, timer_values))
        store_table(self.records, self.RECORDS, kept)
        _expire_at(self.handle, kept["last"], self.ttl_us)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(load_table(self.records, self.RECORDS), timerValues)
        yield from ()

    def close(self) -> None:
        pass


def live_sessions(events: DataFrame, ttl_seconds: int = TTL_SESSION, buckets: int = BUCKETS) -> DataFrame:
    """Streaming frame of storable events -> the current session record per
    session touched in a micro-batch (``SESSION_OUTPUT_SCHEMA``)."""
    return by_bucket(events, "session_id", ["timestamp", "user_id"], buckets).transformWithStateInPandas(
        statefulProcessor=SessionRecord(ttl_seconds), outputStructType=SESSION_OUTPUT_SCHEMA,
        outputMode="Update", timeMode="EventTime")


RECENT_OUTPUT_SCHEMA = ("user_id string, rank int, product_id string, action_type string, category string, "
                        "price double, timestamp timestamp, run_start timestamp, last_write timestamp")


def _newest_rows(rows: Columns, n: int) -> Columns:
    """Of every key the newest ``n`` rows, newest first."""
    code, _ = numbered(rows["key"])
    order = np.lexsort((-rows["tie"], -rows["ts"], code))
    first_at = begins(code[order])
    rank = np.arange(len(order)) - np.repeat(first_at, np.diff(np.append(first_at, len(order))))
    return chosen(rows, order[rank < n])


def _merge_runs(runs: Columns, ttl_us: int) -> Columns:
    """Intervals (start, last) of keys -> runs, by key and time: a gap of
    ``ttl_us`` or more begins a new one."""
    code, _ = numbered(runs["key"])
    order = np.lexsort((runs["start"], code))
    runs, code = chosen(runs, order), code[order]
    reach = pd.Series(runs["last"]).groupby(code).cummax().to_numpy()
    new = np.ones(len(code), bool)
    new[1:] = (code[1:] != code[:-1]) | (runs["start"][1:] - reach[:-1] >= ttl_us)
    first = np.flatnonzero(new)
    return {"key": runs["key"][first], "start": runs["start"][first], "last": reach[np.append(first[1:], len(code)) - 1]}


class RecentBehaviors(StatefulProcessor):
    """State per user: the newest ``n`` behaviours, and the runs not yet behind
    the watermark by a lifetime."""
    RUNS = UserCounters.RUNS
    RECENT = pa.schema([("key", pa.string()), ("ts", pa.int64()), ("tie", pa.int64()), ("product_id", pa.string()),
                        ("action_type", pa.string()), ("category", pa.string()), ("price", pa.float64())])

    def __init__(self, ttl_seconds: int, n: int, tie_break: str | None):
        self.ttl_us, self.n, self.tie_break = int(ttl_seconds) * 1_000_000, n, tie_break

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.runs = handle.getValueState("runs", "rows binary")
        self.recent = handle.getValueState("recent", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        kept, runs, touched = load_table(self.recent, self.RECENT), [load_table(self.runs, self.RUNS)], []
        for chunk in rows:
            t, users = micros(chunk), texts(chunk["user_id"])
            new = {"key": users, "ts": t, "tie": chunk[self.tie_break].to_numpy("int64") if self.tie_break else np.zeros(len(t), "int64"),
                   "product_id": texts(chunk["product_id"]), "action_type": texts(chunk["action_type"]),
                   "category": texts(chunk["product_category"]), "price": chunk["product_price"].astype("float64").to_numpy()}
            kept = _newest_rows(joined([kept, new]), self.n)
            runs.append(_merge_runs({"key": users, "start": t, "last": t}, self.ttl_us))
            touched.append(numbered(users)[1])
        _, touched = numbered(np.concatenate(touched))
        runs = _merge_runs(joined(runs), self.ttl_us)
        names, newest = self._store(runs, kept, timerValues)

        # what the touched keys show: the rows of their newest run
        shown = {k: i for i, k in enumerate(names)}
        of = np.fromiter((shown[k] for k in touched), "int64", len(touched))
        wanted = np.zeros(len(names), bool)
        wanted[of] = True
        at = places(names, kept["key"])
        row = wanted[at] & (kept["ts"] >= newest["start"][at])
        out, at = chosen(kept, row), at[row]
        first_at = begins(at)
        rank = np.arange(1, len(at) + 1) - np.repeat(first_at, np.diff(np.append(first_at, len(at))))
        yield pd.DataFrame({
            "user_id": out["key"], "rank": rank.astype("int32"), "product_id": out["product_id"],
            "action_type": out["action_type"], "category": out["category"], "price": out["price"].astype("float64"),
            "timestamp": times(out["ts"]), "run_start": times(newest["start"][at]), "last_write": times(newest["last"][at])})

    def _store(self, runs: Columns, kept: Columns, timer_values) -> tuple[np.ndarray, Columns]:
        """Keeps the runs that can still be reached and the rows in them; returns
        the keys and the newest run of each."""
        first_at = begins(numbered(runs["key"])[0])
        newest = chosen(runs, np.append(first_at[1:], len(runs["key"])) - 1) if len(first_at) else runs
        names = newest["key"]
        alive = _alive(newest["last"], self.ttl_us, timer_values)
        of = np.repeat(np.arange(len(names)), np.diff(np.append(first_at, len(runs["key"]))))
        reachable = runs["last"] + self.ttl_us > timer_values.getCurrentWatermarkInMs() * 1000
        left = chosen(runs, reachable & alive[of])
        earliest = np.full(len(names), np.iinfo("int64").max)
        np.minimum.at(earliest, of[reachable & alive[of]], left["start"])
        store_table(self.runs, self.RUNS, left)
        at = places(names, kept["key"])
        store_table(self.recent, self.RECENT, chosen(kept, (at >= 0) & (kept["ts"] >= earliest[at])))
        _expire_at(self.handle, newest["last"][alive], self.ttl_us)
        return names, newest

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self._store(load_table(self.runs, self.RUNS), load_table(self.recent, self.RECENT), timerValues)
        yield from ()

    def close(self) -> None:
        pass


def live_recent(events: DataFrame, ttl_seconds: int = TTL_RECENT_BEHAVIORS, n: int = RECENT_BEHAVIORS_KEEP,
                tie_break: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Streaming frame of storable events with an event-time watermark -> the
    newest ``n`` behaviours of each user touched in a micro-batch
    (``RECENT_OUTPUT_SCHEMA``, rank 1 = newest). Rows of one time are ordered by
    the long column ``tie_break``, highest first."""
    columns = ["timestamp", "product_id", "action_type", "product_category", "product_price", *([tie_break] if tie_break else [])]
    return by_bucket(events, "user_id", columns, buckets).transformWithStateInPandas(
        statefulProcessor=RecentBehaviors(ttl_seconds, n, tie_break), outputStructType=RECENT_OUTPUT_SCHEMA,
        outputMode="Update", timeMode="EventTime")
