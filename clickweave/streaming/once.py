"""Every record once, late ones too (H10 under the policy ``keep``).

``dropDuplicatesWithinWatermark`` forgets what is behind the watermark, and so
must drop late rows. Here keyed state holds, for each range of ``SPAN`` offsets
of a topic's partition, the offsets seen, as intervals. Offsets come nearly
without gaps, so a range is an interval or two once it has been delivered,
whatever the number of its records; a range in order costs one state update a
batch. Rows are judged chunk by chunk as they arrive. The intervals of a range
are one binary value: where a producer's offsets have gaps, they are many.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

SPAN = 1 << 17  # a task handles a range at a time; the state of one in no order at all is 1 MB


def merge_offsets(lo: np.ndarray, hi: np.ndarray, new: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Disjoint, sorted intervals ``lo..hi`` with the offsets ``new`` put in."""
    a, b = np.concatenate([lo, new]), np.concatenate([hi, new])
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    first = np.flatnonzero(np.concatenate([[True], a[1:] > b[:-1] + 1]))
    return a[first], b[np.append(first[1:], len(a)) - 1]


def unseen(lo: np.ndarray, hi: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True for the first occurrence of each offset outside the intervals."""
    first = np.zeros(len(offsets), bool)
    first[np.unique(offsets, return_index=True)[1]] = True
    if not len(lo):
        return first
    at = np.searchsorted(lo, offsets, "right") - 1
    return first & ((at < 0) | (offsets > hi[np.maximum(at, 0)]))


class SeenOffsets(StatefulProcessor):
    def __init__(self, columns: list[str]):
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("intervals", "bounds binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.seen.get()
        lo, hi = np.frombuffer(bytes(held[0]) if held is not None else b"", "<i8").reshape(2, -1)
        for chunk in rows:
            offsets = chunk["offset"].to_numpy("int64")
            new = unseen(lo, hi, offsets)
            if new.any():
                lo, hi = merge_offsets(lo, hi, offsets[new])
                yield chunk.loc[new, self.columns]
        self.seen.update((np.concatenate([lo, hi]).astype("<i8").tobytes(),))

    def close(self) -> None:
        pass


def each_record_once(events: DataFrame, span: int = SPAN) -> DataFrame:
    """The streaming frame without repeated records (topic, partition, offset),
    however late the repeats or the rows. Rows without an offset are left out;
    a record has one. Start the query inside ``stateful.configured``."""
    missing = [c for c in ("topic", "partition", "offset") if c not in events.columns]
    if missing:
        raise ValueError(f"late='once' needs the record columns {missing}")
    ranged = events.where("offset is not null").withColumn("_range", F.expr(f"(offset - pmod(offset, {int(span)})) div {int(span)}"))
    return ranged.groupBy("topic", "partition", "_range").transformWithStateInPandas(
        statefulProcessor=SeenOffsets(events.columns), outputStructType=T.StructType(list(events.schema.fields)),
        outputMode="Append", timeMode="None")
