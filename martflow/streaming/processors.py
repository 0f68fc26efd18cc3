"""Stateful processors for the streaming forms of O2, O3, O4 (+ O5, W1, W3, W5).

Used with ``df.groupBy(key).transformWithStateInPandas(...)``: rows move in Arrow
batches, and dates come as columns worked out before the call.  State is per
key (one date, or the rows of one key that are still inside the pattern window), held
by the RocksDB state store.  Rows of one key inside a micro-batch arrive
unordered, so every processor sorts them first.
"""

from __future__ import annotations

import heapq
import itertools
import pickle
import sys
from collections.abc import Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

DAY_MS = 86_400_000
#: Columns that the callers add: the date of the event time and the day before it.
VISIT, BEFORE = "__visit_dt", "__before_dt"
#: Of O4's state: the buckets of a group, the most rows of a chunk, the rows of a key that are sorted (or given out) at once.
GROUP, CHUNK, RUN = 1024, 256, 50_000


def _sorted(rows: Iterator[pd.DataFrame], columns: Sequence[str], order: Sequence[str]) -> pd.DataFrame:
    """The rows in order.  Spark names input columns after the output's, so those beyond it are named here."""
    df = pd.concat([r.set_axis([*columns, VISIT, BEFORE], axis=1) for r in rows])
    return df.sort_values(list(order), kind="stable", ignore_index=True)


class FirstVisitProcessor(StatefulProcessor):
    """O2: new-visitor repair.  State: first-visit date, never expires."""

    def __init__(self, order: Sequence[str], is_new: str, columns: Sequence[str]):
        self.order, self.is_new, self.columns = list(order), is_new, list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first_visit_dt", "dt string")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, self.columns, self.order)
        new = df[self.is_new] == "1"
        if self.first.exists():
            first = self.first.get()[0]
        else:
            first = df[VISIT].iat[0] if new.iat[0] else df[BEFORE].iat[0]
            self.first.update((first,))
        df.loc[new & (df[VISIT] != first), self.is_new] = "0"
        yield df[self.columns]

    def close(self) -> None:
        pass


class UniqueVisitorProcessor(StatefulProcessor):
    """O3 + O5: emit a row when the key's previous date differs.

    State: last visit date with a time-to-live (processing time) of one
    day by default, refreshed on every write.
    """

    def __init__(self, order: Sequence[str], columns: Sequence[str], ttl_ms: int | None = DAY_MS):
        self.order, self.columns, self.ttl_ms = list(order), list(columns), ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last_visit_dt", "dt string", self.ttl_ms)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        df = _sorted(rows, self.columns, self.order)
        before = df[VISIT].shift(1)
        before.iat[0] = self.last.get()[0] if self.last.exists() else None
        self.last.update((df[VISIT].iat[-1],))
        yield df.loc[(before != df[VISIT]).fillna(True), self.columns]

    def close(self) -> None:
        pass


class UserJumpProcessor(StatefulProcessor):
    """O4 + W1/W3/W5: bounce detection in event time.

    Time is cut into buckets as wide as the pattern limit ``within``.  A bucket is judged when the watermark has
    passed the end of the next one: then all rows of both are there, and the successor of each row of the bucket is among
    them.  An entry is emitted unless its successor is a non-entry less than ``within`` later.  Rows older than the
    watermark are late and ignored.

    A call to the state takes far longer than a row, so rows are kept by group, :data:`GROUP` buckets of a key, in chunks of up to
    :data:`CHUNK` rows, and of rows that are no entry only what orders them.  What arrives together is sorted first and makes a run of
    chunks; a group's runs are merged as they are read, a chunk of each at a time.  A group has a timer for its first
    bucket, which judges all buckets that are due, frees their chunks and sets one for the next, and one for its last.
    """

    def __init__(self, schema: StructType, order: Sequence[str], ts: str, is_entry: str, within_ms: int):
        self.schema, self.names, self.within = schema, schema.fieldNames(), within_ms
        self.at = [self.names.index(c) for c in order]
        self.ts, self.is_entry = self.names.index(ts), self.names.index(is_entry)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        number = lambda *names: StructType([StructField(n, LongType()) for n in names])
        # of a group: its runs (their chunks from .. to), the first and last bucket that have a timer, the last bucket judged
        group = StructType([StructField("begins", ArrayType(LongType())), StructField("ends", ArrayType(LongType())), *number("first", "last", "done").fields])
        self.groups = handle.getMapState("groups", number("group"), group)
        self.kept = handle.getMapState("rows", number("group", "chunk"), StructType([StructField("rows", BinaryType())]))

    def _group(self, g: int) -> tuple | None:
        return tuple(self.groups.getValue((g,))) if self.groups.containsKey((g,)) else None

    def _keep(self, fresh: list) -> None:
        """Rows ``(order, time, entry, row or None)`` as a run of each group they belong to."""
        fresh.sort(key=lambda t: t[0])
        by_group: dict[int, list] = {}
        for t in fresh:
            by_group.setdefault(t[1] // self.within // GROUP, []).append(t)
        for g, rows in by_group.items():
            buckets = [t[1] // self.within for t in rows]
            low, high = min(buckets), max(buckets)
            begins, ends, first, last, done = self._group(g) or ([], [], None, None, None)
            begin = max(ends, default=0)
            parts = [rows[i:i + CHUNK] for i in range(0, len(rows), CHUNK)]
            for n, part in enumerate(parts, begin):
                self.kept.updateValue((g, n), (pickle.dumps(part),))
            for b in {b for b, new in ((low, first is None or low < first), (high, last is None or high > last)) if new}:
                self.handle.registerTimer((b + 2) * self.within)
            first, last = low if first is None else min(first, low), high if last is None else max(last, high)
            self.groups.updateValue((g,), ([*begins, begin], [*ends, begin + len(parts)], first, last, done))

    def _arrived(self, rows: Iterator[Sequence], watermark: int) -> None:
        """Keep these rows (the schema's columns first)."""
        fresh: list = []
        for t in rows:
            if t[self.ts] < watermark:  # W5: late rows ignored
                continue
            order = tuple(sys.intern(v) if type(v) is str else v for v in (t[i] for i in self.at))
            entry = bool(t[self.is_entry])
            fresh.append((order, int(t[self.ts]), entry, tuple(t[:len(self.names)]) if entry else None))
            if len(fresh) >= RUN:
                self._keep(fresh)
                fresh = []
        if fresh:
            self._keep(fresh)

    def _rows(self, g: int, runs: list[list[int]]) -> Iterator[tuple]:
        """The rows of runs in order; the begin of a run moves on with the chunk that is read."""
        def rows(run):
            while run[0] < run[1]:
                yield from pickle.loads(self.kept.getValue((g, run[0]))[0])
                run[0] += 1
        return rows(runs[0]) if len(runs) == 1 else heapq.merge(*map(rows, runs), key=lambda t: t[0])

    def _judged(self, expired: int, watermark: int) -> Iterator[list[tuple]]:
        """The bounces that a timer finds, in lists of up to :data:`RUN`."""
        g = (expired // self.within - 2) // GROUP
        group = self._group(g)
        if group is None:
            return
        begins, ends, first, last, done = group
        due = min(max(expired, watermark) // self.within - 2, (g + 1) * GROUP - 1)
        runs = [list(x) for x in zip(begins, ends)]
        rows = self._rows(g, runs)
        if last == due == (g + 1) * GROUP - 1 and (beyond := self._group(g + 1)):
            rows = itertools.chain(rows, itertools.islice(self._rows(g + 1, [list(x) for x in zip(beyond[0], beyond[1])]), 1))
        out, before, after = [], None, None
        for t in itertools.chain(rows, [None]):
            if before is not None:
                stopped = t is not None and not t[2] and t[1] - before[1] < self.within
                if before[2] and not stopped:
                    out.append(before[3])
                    if len(out) >= RUN:
                        yield out
                        out = []
            if t is None or t[1] // self.within > due:
                after = t
                break
            before = t if done is None or t[1] // self.within > done else None
        if out:
            yield out
        over = last <= due
        for begin, run in zip(begins, runs):
            for n in range(begin, run[1] if over else run[0]):
                self.kept.removeKey((g, n))
        if over:
            self.groups.removeKey((g,))
            return
        first = after[1] // self.within
        if first < last:  # the last has its timer
            self.handle.registerTimer((first + 2) * self.within)
        runs = [run for run in runs if run[0] < run[1]]
        self.groups.updateValue((g,), ([r[0] for r in runs], [r[1] for r in runs], first, last, due if done is None else max(due, done)))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        self._arrived((t for df in rows for t in zip(*[df[c].tolist() for c in self.names])), timerValues.getCurrentWatermarkInMs())
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        for out in self._judged(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()):
            yield pd.DataFrame(out, columns=self.names)

    def close(self) -> None:
        pass


class UserJumpRowProcessor(UserJumpProcessor):
    """The same for ``transformWithState``: rows come and go as rows, as data frames of the few rows of a key take longer than they do."""

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: TimerValues) -> Iterator[Row]:
        self._arrived(rows, timerValues.getCurrentWatermarkInMs())
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[Row]:
        row = Row(*self.names)
        for out in self._judged(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()):
            yield from (row(*t) for t in out)
