"""O2, O3, O4, X1-X5 on hand-made cases, and the skew-safe plans against
their literal window forms on random inputs."""

import json
import random

from pyspark.sql import Window, functions as F

from martflow.operators import traffic
from martflow.plans import jobs

DAY = 86_400_000
D1 = 1_700_000_000_000 - (1_700_000_000_000 % DAY) + 3_600_000  # 01:00 UTC of some day


def _rows(spark, rows, schema="seq long, mid string, ts long, is_new string"):
    return spark.createDataFrame(rows, schema)


def test_repair_new_visitor(spark):
    # mid m: is_new 1 on d1, 1 on d1, 1 on d2, 1 on d0 -> 1, 1, 0, 0
    df = _rows(spark, [(1, "m", D1, "1"), (2, "m", D1 + 5, "1"), (3, "m", D1 + DAY, "1"),
                       (4, "m", D1 - DAY, "1")])
    got = {r.seq: r.is_new for r in traffic.repair_new_visitor(df, order=["ts", "seq"]).collect()}
    # arrival order is (ts, seq): d0 comes first, so it fixes the first date to d0
    assert got == {4: "1", 1: "0", 2: "0", 3: "0"}


def test_repair_new_visitor_arrival_order(spark):
    # in arrival order d1, d1, d2, d0 the first record fixes d1 (stream form semantics)
    df = _rows(spark, [(1, "m", D1, "1"), (2, "m", D1 + 5, "1"), (3, "m", D1 + DAY, "1"),
                       (4, "m", D1 - DAY, "1")])
    got = {r.seq: r.is_new for r in traffic.repair_new_visitor(df, order=["seq"]).collect()}
    assert got == {1: "1", 2: "1", 3: "0", 4: "0"}


def test_repair_old_visitor(spark):
    # mid m: is_new 0 on d2, 1 on d1, 1 on d2 (arrival order) -> 0, 1, 0
    df = _rows(spark, [(1, "m", D1 + DAY, "0"), (2, "m", D1, "1"), (3, "m", D1 + DAY + 9, "1"),
                       (4, None, D1, "1")])
    got = {r.seq: r.is_new for r in traffic.repair_new_visitor(df, order=["seq"]).collect()}
    assert got == {1: "0", 2: "1", 3: "0", 4: "1"}


def test_unique_visitor_time_order(spark):
    df = _rows(spark, [(1, "m", D1, "1"), (2, "m", D1 + 10, "1"), (3, "m", D1 + DAY, "1"),
                       (4, "n", D1 + 10, "1")])
    got = sorted(r.seq for r in traffic.unique_visitor(df, order=["ts", "seq"]).collect())
    assert got == [1, 3, 4]


def test_unique_visitor_arrival_order(spark):
    # entries on d1, d1, d2, d1 (arrival order) -> emit 1st, 3rd, 4th
    df = _rows(spark, [(1, "m", D1, "1"), (2, "m", D1 + 10, "1"), (3, "m", D1 + DAY, "1"),
                       (4, "m", D1 + 20, "1")])
    got = sorted(r.seq for r in traffic.unique_visitor_by_arrival(df, "mid", "ts", "seq").collect())
    assert got == [1, 3, 4]
    # buckets of two rows: predecessors cross bucket edges
    got = sorted(r.seq for r in traffic.unique_visitor_by_arrival(df, "mid", "ts", "seq", bucket=2).collect())
    assert got == [1, 3, 4]


def test_unique_visitor_by_arrival_matches_lag(spark):
    rnd = random.Random(11)
    rows = [(i, f"m{rnd.randint(0, 4)}", D1 + rnd.randint(-3, 3) * DAY + rnd.randint(0, 1000), "1")
            for i in range(400)]
    df = _rows(spark, rows)
    w = Window.partitionBy("mid").orderBy("seq")
    d = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    x = df.withColumn("d", d).withColumn("p", F.lag(d).over(w))
    want = sorted(r.seq for r in x.filter(F.col("p").isNull() | (F.col("p") != F.col("d"))).collect())
    for b in (1, 7, 64, 1 << 16):
        got = traffic.unique_visitor_by_arrival(df, "mid", "ts", "seq", bucket=b)
        assert sorted(r.seq for r in got.collect()) == want, b


def _jump(spark, rows, within=15_000):
    df = spark.createDataFrame(rows, "seq long, mid string, ts long, is_entry boolean")
    return sorted(r.seq for r in traffic.user_jump(df, F.col("is_entry"), order=["ts", "seq"],
                                                   within_ms=within).collect())


def test_user_jump_cases(spark):
    # entry 0 s, entry 10 s, page 12 s -> 1st emitted, 2nd not
    assert _jump(spark, [(1, "m", 0, True), (2, "m", 10_000, True), (3, "m", 12_000, False)]) == [1]
    # timeout: entry 0 s, page 20 s -> emitted
    assert _jump(spark, [(1, "m", 0, True), (2, "m", 20_000, False)]) == [1]
    # boundary: entry 0 s, page 15 s -> emitted (equality is a timeout)
    assert _jump(spark, [(1, "m", 0, True), (2, "m", 15_000, False)]) == [1]
    # tail: entry with nothing after -> emitted in batch
    assert _jump(spark, [(1, "m", 0, True)]) == [1]
    # page right after -> not a bounce; across a bucket edge too
    assert _jump(spark, [(1, "m", 14_000, True), (2, "m", 16_000, False)]) == []


def test_user_jump_kinds(spark):
    df = spark.createDataFrame([(1, "m", 0, True), (2, "m", 10_000, True), (3, "m", 40_000, False)],
                               "seq long, mid string, ts long, is_entry boolean")
    m, t = traffic.user_jump_matches_and_timeouts(df, F.col("is_entry"), order=["ts", "seq"])
    assert [r.seq for r in m.collect()] == [1] and [r.seq for r in t.collect()] == [2]


def _random_events(n=600, seed=7):
    rnd = random.Random(seed)
    rows, t = [], {}
    for i in range(n):
        mid = f"m{rnd.randint(0, 6)}"
        t[mid] = t.get(mid, 0) + rnd.choice([1_000, 5_000, 14_999, 15_000, 15_001, 40_000, DAY // 2])
        rows.append((i, mid, t[mid] + (D1 if rnd.random() < 0.9 else 0), rnd.random() < 0.5,
                     rnd.choice(["1", "0", None])))
    return rows


def test_skew_safe_plans_equal_window_forms(spark):
    df = spark.createDataFrame(_random_events(), "seq long, mid string, ts long, is_entry boolean, is_new string")
    w = Window.partitionBy("mid").orderBy("ts", "seq")
    # O4
    x = df.withColumn("nts", F.lead("ts").over(w)).withColumn("nen", F.lead("is_entry").over(w))
    nts, nen = F.col("nts"), F.col("nen")
    naive = x.filter(F.col("is_entry") & (nts.isNull() | (nts - F.col("ts") >= 15_000) | nen))
    fast = traffic.user_jump(df, F.col("is_entry"), order=["ts", "seq"])
    assert sorted(r.seq for r in naive.collect()) == sorted(r.seq for r in fast.collect())
    # O3
    d = F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")
    y = df.withColumn("d", d).withColumn("prev", F.lag(d).over(w))
    naive3 = y.filter(F.col("prev").isNull() | (F.col("prev") != F.col("d")))
    fast3 = traffic.unique_visitor(df, order=["ts", "seq"])
    assert sorted(r.seq for r in naive3.collect()) == sorted(r.seq for r in fast3.collect())
    # O2 against a literal per-row replay
    state, expect = {}, {}
    for seq, mid, ts, _, is_new in sorted(_random_events(), key=lambda r: (r[2], r[0])):
        from datetime import datetime, timezone
        day = lambda ms: datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y-%m-%d")  # noqa
        first = state.get(mid)
        out = is_new
        if is_new == "1":
            if first is None:
                state[mid] = day(ts)
            elif first != day(ts):
                out = "0"
        elif first is None:
            state[mid] = day(ts - DAY)
        expect[seq] = out
    got = {r.seq: r.is_new for r in traffic.repair_new_visitor(df, order=["ts", "seq"]).collect()}
    assert got == expect


def _log(mid, ts, **kw):
    rec = {"common": {"mid": mid, "is_new": "1"}, "ts": ts}
    rec.update(kw)
    return json.dumps(rec)


def test_log_split(spark):
    page = _log("m", 1000, page={"page_id": "home", "during_time": 1234, "x": None}, err={"code": 1},
                actions=[{"action_id": "a", "item": 1, "ts": 5}, {"action_id": "b"}],
                displays=[{"item": 3, "order": 1}], extra={"deep": [1, {"y": 2}]})
    start = _log("m", 500, start={"entry": "icon", "loading_time": 12}, err={"code": 2})
    rows = [page, start, "not json", "[1]", "", json.dumps({"ts": 1}), json.dumps({"common": {"mid": "m"}})]
    out = jobs.base_log(spark.createDataFrame([(r,) for r in rows], "value string"))
    got = {k: sorted(r.value for r in v.collect()) for k, v in out.items()}
    assert {k: len(v) for k, v in got.items()} == {"page": 1, "start": 1, "action": 2, "display": 1, "error": 2, "dirty": 5}
    common = {"mid": "m", "is_new": "1"}
    assert json.loads(got["page"][0]) == {"common": common, "ts": 1000, "extra": {"deep": [1, {"y": 2}]},
                                          "page": {"page_id": "home", "during_time": 1234, "x": None}}
    assert json.loads(got["start"][0]) == {"common": common, "ts": 500, "start": {"entry": "icon", "loading_time": 12}}
    first = json.loads(got["action"][0])
    assert first["ts"] == 1000 and first["item"] == 1 and first["common"] == common and first["page"]["page_id"] == "home"
    assert sorted(map(json.loads, got["error"]), key=str) == [{"code": 1}, {"code": 2}]


def test_ties_follow_arrival(spark):
    entry, other = _log("m", 1000, page={"page_id": "a"}), _log("m", 1000, page={"page_id": "b", "last_page_id": "a"})
    for order, want in (((entry, other), 0), ((other, entry), 1)):
        raw = spark.createDataFrame([(i, v) for i, v in enumerate(order)], "seq int, value string").repartition(3)
        page = jobs.base_log(raw, arrival=["seq"])["page"]
        assert jobs.user_jump_detail(page, arrival=["seq"]).count() == want
