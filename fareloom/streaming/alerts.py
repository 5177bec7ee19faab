"""Alerts: one row when a group of a window passes its threshold, at once and only once.

A windowed count gives a group's row again with every micro-batch (complete mode) or
when its window has closed (append mode). Here a group stops waiting as soon as the
threshold is passed, and a timer forgets a window when the watermark closes it.

Most groups are small, and each look at the state costs a call between Python and the
JVM, so the groups of a window share the state of a few buckets.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareloom.session import ship

GROUP = ["window_start", "window_end"]


def first_of_groups(key: str, keep: int):
    """Of each group in an Arrow batch only its ``keep`` earliest rows go on.

    Later ones cannot decide when the group passes ``keep - 1`` rows, so a hot group
    sends a bounded number of rows a batch to the one task that holds its state.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            ordered = rows.sort_values("at", kind="stable")
            yield ordered.groupby([*GROUP, key], dropna=False, sort=False).head(keep)

    return run


class Crossing(StatefulProcessor):
    """Holds the earliest times of the groups of a window's bucket until a group has more
    than ``min_count``."""

    def __init__(self, key: str, min_count: int):
        self.key, self.needed = key, min_count + 1

    def init(self, handle) -> None:
        self.handle = handle
        # For each name its times; none at all once its alert is out.
        schema = "names array<string>, times array<array<bigint>>"
        self.groups = handle.getValueState("groups", schema)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held: dict[str | None, list[int]] = {}
        if self.groups.exists():
            held = dict(zip(*self.groups.get(), strict=True))
        else:
            self.handle.registerTimer(int(key[1]) // 1000)
        new: dict[str | None, list[int]] = {}
        for part in rows:
            for name, at in zip(part[self.key].tolist(), part["at"].tolist(), strict=True):
                new.setdefault(name, []).append(at)
        crossed = {}
        for name, times in new.items():
            before = held.get(name)
            if before is not None and not len(before):
                continue
            times = sorted([*(before or ()), *times])[: self.needed]
            if len(times) == self.needed:
                crossed[name], times = times[-1], []
            held[name] = times
        self.groups.update((list(held), [list(times) for times in held.values()]))
        if crossed:
            yield pd.DataFrame(
                {
                    GROUP[0]: int(key[0]),
                    GROUP[1]: int(key[1]),
                    self.key: pd.Series(list(crossed), dtype=object),
                    "crossed_at": list(crossed.values()),
                }
            )

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.groups.clear()
        return iter(())

    def close(self) -> None:
        pass


def threshold_alerts(
    events: DataFrame,
    ts: str,
    width: str,
    key: str,
    min_count: int,
    delay: str = "10 minutes",
    buckets: int = 4,
) -> DataFrame:
    """A row per window and ``key`` that gets more than ``min_count`` events of a stream.

    Columns: window_start, window_end, the key, crossed_at: the time of the earliest
    event with which the group passed the threshold, among the events read by then. For
    events in order of time this equals ``first_crossings`` of a static table. The row
    comes out of the micro-batch that read this event, and never again.

    A null key is a group of its own; events without a time fall out, and so do events
    that are older than the watermark, which ``delay`` keeps behind the latest time.
    ``events`` has no watermark yet. Run it in append mode.

    The key is a string or a type that Spark casts to a string and back. The groups of
    a window lie in ``buckets`` entries of the state, each of which one task reads and
    writes as a whole: take more for windows of very many keys.
    """
    ship(events.sparkSession)
    window = F.window(ts, width)
    rows = events.filter(F.col(ts).isNotNull()).select(
        F.unix_micros(window["start"]).alias(GROUP[0]),
        F.unix_micros(window["end"]).alias(GROUP[1]),
        F.col(key).cast("string").alias(key),
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).alias("bucket"),
        F.unix_micros(ts).alias("at"),
    )
    fewer = rows.mapInPandas(first_of_groups(key, min_count + 1), rows.schema)
    late = fewer.withColumn("event_time", F.timestamp_micros("at")).withWatermark(
        "event_time", delay
    )
    schema = StructType(
        [
            StructField(GROUP[0], LongType()),
            StructField(GROUP[1], LongType()),
            StructField(key, StringType()),
            StructField("crossed_at", LongType()),
        ]
    )
    found = late.groupBy(*GROUP, "bucket").transformWithStateInPandas(
        Crossing(key, min_count), schema, "Append", "EventTime"
    )
    return found.select(
        *(F.timestamp_micros(name).alias(name) for name in GROUP),
        F.col(key).cast(events.schema[key].dataType).alias(key),
        F.timestamp_micros("crossed_at").alias("crossed_at"),
    )
