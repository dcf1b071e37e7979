"""Streaming forms of the interval operators. They are additions: batch results are the standard."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def gap_sessions(events: DataFrame, key: str, gap: str, watermark: str) -> DataFrame:
    """Sessions that end after a gap without events; late events beyond the watermark are left out. events: key, ts (timestamp)."""
    windows = events.withWatermark("ts", watermark).groupBy(key, F.session_window("ts", gap).alias("w"))
    return windows.agg(F.count("*").alias("parts")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "parts")


def without_repeats(events: DataFrame, key: str, watermark: str) -> DataFrame:
    """First event of each id within the watermark."""
    return events.withWatermark("ts", watermark).dropDuplicatesWithinWatermark([key])


def packed(events: DataFrame, key: str, cap_seconds: float, gap_seconds: float, watermark: str) -> DataFrame:
    """Greedy packing of intervals with a cap, as a stateful stream: key, start, end, parts (seconds).

    events: key, ts (timestamp), seconds. Within a batch intervals are taken by start; a pack is emitted when the next one
    begins, or when the watermark passes its end by the gap.
    """
    kind = events.schema[key].dataType.simpleString()
    out, state = f"{key} {kind}, start double, end double, parts long", "start double, end double, parts long"

    def step(group: tuple, batches: Iterator[pd.DataFrame], held: GroupState) -> Iterator[pd.DataFrame]:
        if held.hasTimedOut:
            start, end, parts = held.get
            held.remove()
            yield pd.DataFrame({key: [group[0]], "start": [start], "end": [end], "parts": [parts]})
            return
        now, done = (held.get if held.exists else None), []
        rows = pd.concat(list(batches))
        rows["start"] = rows["ts"].astype("int64") / 1e9 if rows["ts"].dtype.str.endswith("[ns]") else rows["ts"].astype("datetime64[ns]").astype("int64") / 1e9
        for start, seconds in sorted(zip(rows["start"], rows["seconds"])):
            end = start + seconds
            if now and max(0.0, start - now[1]) <= gap_seconds and end - now[0] <= cap_seconds:
                now = (now[0], max(now[1], end), now[2] + 1)
                continue
            if now:
                done.append(now)
            now = (start, end, 1)
        held.update(tuple(now))
        held.setTimeoutTimestamp(max(int((now[1] + gap_seconds) * 1000), held.getCurrentWatermarkMs() + 1))
        if done:
            yield pd.DataFrame({key: [group[0]] * len(done), "start": [d[0] for d in done], "end": [d[1] for d in done], "parts": [d[2] for d in done]})

    return events.withWatermark("ts", watermark).groupBy(key).applyInPandasWithState(step, out, state, "append", GroupStateTimeout.EventTimeTimeout)
