"""O4's stream state is called for a group of buckets, not for each bucket."""

import random

import pandas as pd
from pyspark.sql import types as T

from martflow.streaming import processors

WITHIN, DAY = 6 * 3_600_000, 86_400_000
SCHEMA = T.StructType([T.StructField("mid", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("is_entry", T.BooleanType())])


class Key:
    """State and timers of one key, and how often they are called."""

    def __init__(self):
        self.maps, self.timers, self.calls = {}, set(), 0

    def getMapState(self, name, *_):
        store = self.maps.setdefault(name, {})
        def counted(f):
            def call(*a):
                self.calls += 1
                return f(*a)
            return staticmethod(call)
        made = {"containsKey": lambda k: k in store, "getValue": lambda k: store[k], "updateValue": store.__setitem__, "removeKey": store.pop}
        return type("MapState", (), {k: counted(f) for k, f in made.items()})()

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


def _replay(rows, batches, delay):
    """The bounces of one key that come in batches, judged as the watermark moves on, and the calls of state."""
    key = Key()
    p = processors.UserJumpProcessor(SCHEMA, ["ts", "seq"], "ts", "is_entry", WITHIN)
    p.init(key)
    out, watermark = [], 0
    for part in [*batches, []]:
        clock = type("Times", (), {"getCurrentWatermarkInMs": lambda self, w=watermark: w})()
        if part:
            list(p.handleInputRows(("a",), iter([pd.DataFrame(part, columns=SCHEMA.fieldNames())]), clock))
        for due in sorted(t for t in key.timers if t <= watermark):
            key.timers.remove(due)
            for got in p.handleExpiredTimer(("a",), clock, type("Due", (), {"getExpiryTimeInMs": lambda self, due=due: due})()):
                out += [(watermark, i) for i in got["seq"].tolist()]
        watermark = max([watermark, *(t[1] - delay for t in part)]) if part is not batches[-1] else 10 ** 15
    return out, key


def _bounces(rows):
    rows = sorted(rows, key=lambda t: (t[1], t[2]))
    return sorted(t[2] for t, n in zip(rows, [*rows[1:], None]) if t[3] and (n is None or n[1] - t[1] >= WITHIN or n[3]))


def test_a_replay_calls_the_state_a_few_times_for_a_key():
    draw = random.Random(1)
    rows = [("a", draw.randrange(30 * DAY), i, draw.random() < 0.3) for i in range(67)]
    out, key = _replay(rows, [rows], 0)
    assert sorted(i for _, i in out) == _bounces(rows) and not any(key.maps.values())
    assert key.calls < 60  # by bucket it was hundreds


def test_buckets_are_judged_as_soon_as_they_are_due(monkeypatch):
    monkeypatch.setattr(processors, "CHUNK", 3)
    monkeypatch.setattr(processors, "RUN", 10)
    monkeypatch.setattr(processors, "GROUP", 40)
    for seed in range(30):
        draw = random.Random(seed)
        delay, n = draw.choice([0, DAY, 5 * DAY]), draw.choice([40, 400])
        rows = [("a", draw.randrange(90 * DAY) // 3_600_000 * 3_600_000, i, draw.random() < 0.5) for i in range(n)]
        rows.sort(key=lambda t: t[1] + draw.randrange(delay + 1))
        cut = max(1, n // draw.choice([1, 4, 20]))
        batches = [rows[i:i + cut] for i in range(0, n, cut)]
        out, key = _replay(rows, batches, delay)
        assert sorted(i for _, i in out) == _bounces(rows) and not any(key.maps.values()), seed
        # emitted at the first watermark that is past the end of the next bucket
        marks = [0]
        for b in batches:
            marks.append(max([marks[-1], *(t[1] - delay for t in b)]))
        marks[-1] = 10 ** 15
        for at, i in out:
            t = next(r for r in rows if r[2] == i)
            came = next(k for k, b in enumerate(batches) if t in b)
            assert at == next(w for k, w in enumerate(marks) if k >= came and w >= (t[1] // WITHIN + 2) * WITHIN), seed


def test_a_long_stream_reads_what_is_not_judged_yet():
    rows = [("a", i * 1000, i, i % 3 == 0) for i in range(0, 40_000, 7)]
    rows = [("a", t[1] * 400, t[2], t[3]) for t in rows]
    out, key = _replay(rows, [rows[i:i + 20] for i in range(0, len(rows), 20)], 0)
    assert sorted(i for _, i in out) == _bounces(rows) and not any(key.maps.values())
    assert key.calls < 30 * len(rows) / 7.7  # in proportion to the buckets
