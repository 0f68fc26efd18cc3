"""Left joins on a stream that answer at once and take back: J2, K3, O6.

:class:`RetractingJoinProcessor` is keyed by the join key and reads the *union* of its sides, so that one shuffle serves all joins
of that key.  A left row comes out as it arrives, with nulls for sides that have not arrived; the first row of such a
side gives a tombstone and the fuller row.  On a replay :mod:`martflow.operators.changelog` gives the same log.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from itertools import product
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

#: Columns of the union: the key, the side (0: left), the time (ms) and place of arrival, and the record as JSON.
INPUT = ["key", "side", "at", "place", "record"]
OUTPUT = "key string, place bigint, nth int, tombstone boolean, left string, rights array<string>"


def sides(left: DataFrame, rights: Sequence[DataFrame]) -> DataFrame:
    """The union of the sides; each has the columns ``key``, ``at``, ``place`` and ``record``."""
    out = left.withColumn("side", F.lit(0))
    for n, r in enumerate(rights, 1):
        out = out.unionByName(r.withColumn("side", F.lit(n)))
    return out.select(*INPUT)


def as_side(df: DataFrame, key: Column, at: Column, place: Column) -> DataFrame:
    """A source as a side: its rows as JSON records."""
    return df.select(key.cast("string").alias("key"), at.cast("bigint").alias("at"), place.cast("bigint").alias("place"),
                     F.to_json(F.struct(*df.columns)).alias("record")).filter(F.col("key").isNotNull())


def retracting_join(union: DataFrame, rights: int, idle_ms: int | None = None, rule: str = "read_write", delay: str = "10 seconds") -> DataFrame:
    """The log of the left joins of side 0 with sides 1 to ``rights`` of ``union`` (:func:`sides`).

    ``idle_ms`` drops a row so long after its last access by arrival time (O6): a right row's time counts from its arrival, a left row's
    too, or with ``read_write`` from the last right row that read it.  State of keys that get no more rows is freed by timers.
    Rows of a key inside a micro-batch are taken by ``place``; ``nth`` orders the log at one place.
    """
    timed = union.withColumn("event_time", F.timestamp_millis("at")).withWatermark("event_time", delay)
    mode = "EventTime" if idle_ms is not None else "None"
    return timed.groupBy("key").transformWithStateInPandas(RetractingJoinProcessor(rights, idle_ms, rule), OUTPUT, "Append", mode)


class RetractingJoinProcessor(StatefulProcessor):
    """State of a key: the left rows with what they have met of each side, and the right rows."""

    def __init__(self, rights: int, idle_ms: int | None, rule: str):
        self.rights, self.idle, self.keep_read = rights, idle_ms, rule == "read_write"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.left = handle.getListState("left", "accessed bigint, record string, met string")
        self.right = handle.getListState("right", "side int, at bigint, record string")

    def _live(self, accessed: int, now: int) -> bool:
        return self.idle is None or now - accessed < self.idle

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        fresh = sorted((int(r[3]), int(r[1]), int(r[2]), r[4]) for df in rows for r in df[df.columns[:5]].itertuples(index=False, name=None))
        left = [[t[0], t[1], json.loads(t[2])] for t in self.left.get()] if self.left.exists() else []
        right = [tuple(t) for t in self.right.get()] if self.right.exists() else []
        out: list[tuple] = []

        def emit(place: int, tombstone: bool, record: str | None, met: list) -> None:
            for others in product(*[m or [None] for m in met]):
                out.append((key[0], place, len(out), tombstone, None if tombstone else record, None if tombstone else list(others)))

        for place, side, at, record in fresh:
            if side == 0:
                met = [[r for s, a, r in right if s == n and self._live(a, at)] for n in range(1, self.rights + 1)]
                emit(place, False, record, met)
                left.append([at, record, met])
                continue
            right.append((side, at, record))
            left = [x for x in left if self._live(x[0], at)]
            for x in left:
                met = x[2]
                if not met[side - 1]:
                    emit(place, True, None, met)
                emit(place, False, x[1], [[record] if n == side - 1 else m for n, m in enumerate(met)])
                met[side - 1].append(record)
                if self.keep_read:
                    x[0] = at
        now = max((f[2] for f in fresh), default=0)
        self._keep(left, right, now)
        if self.idle is not None and fresh:
            self.handle.registerTimer(now + self.idle)
        if out:
            yield pd.DataFrame(out, columns=["key", "place", "nth", "tombstone", "left", "rights"])

    def _keep(self, left: list, right: list, now: int) -> None:
        left = [(a, r, json.dumps(m)) for a, r, m in left if self._live(a, now)]
        right = [t for t in right if self._live(t[1], now)]
        for state, rows in ((self.left, left), (self.right, right)):
            if rows:
                state.put(rows)
            else:
                state.clear()

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        left = [(t[0], t[1], json.loads(t[2])) for t in self.left.get()] if self.left.exists() else []
        right = [tuple(t) for t in self.right.get()] if self.right.exists() else []
        self._keep(left, right, expiredTimerInfo.getExpiryTimeInMs())
        return iter([])

    def close(self) -> None:
        pass
