"""Keyed tables in buckets, segment topics, routing by arrival, snapshot hand-over, bounce state by time."""

import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martflow.operators import upsert
from martflow.sinks import segments
from martflow.sinks.keyed_table import KeyedTable
from martflow.streaming import jobs as S
from martflow.streaming.processors import UserJumpProcessor


# -------------------------------------------------------------- K3, K4, K7
def files(path):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(f"{path}/data") for f in names if f.startswith("part-"))


def test_keyed_table_is_the_latest_value_of_each_key(spark, tmp_path):
    draw, want = random.Random(1), {}
    t = KeyedTable(spark, str(tmp_path / "t"), 8)
    assert t.read().collect() == [] and t.compact() == []
    for batch in range(5):
        rows = [(draw.choice([None, *(f"k{i}" for i in range(40))]), draw.choice([None, f"v{batch}-{i}"]), i) for i in range(60)]
        for k, v, _ in rows:
            want[k] = v
        t.append(spark.createDataFrame(rows, "key string, value string, o bigint").repartition(3), ["o"], batch)
        if batch in (1, 3):
            assert t.compact(0.1)
        if batch == 2:  # a batch that comes again changes nothing
            t.append(spark.createDataFrame([("k1", "again", 1)], "key string, value string, o bigint"), ["o"], batch)
        assert {r.key: r.value for r in t.read().collect()} == {k: v for k, v in want.items() if k and v is not None}
    assert len(t.files()) <= 3 * 8  # after a compaction: a base and the deltas since
    t.compact(0)
    assert len(t.files()) <= 8
    plan = t.read()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), 16, ["name", "size"])
    rows = [(f"k{i}", {"name": f"n{i}", "size": "1", "unknown": "x"}, 1) for i in range(200)]
    t.append(spark.createDataFrame(rows, "key string, data map<string,string>, ts bigint"), ["ts"], 0)
    assert len(t.compact(0)) == 16
    before = set(t.files())
    t.append(spark.createDataFrame([("k7", {"size": "2"}, 2), ("k7", {"name": None}, 3)], "key string, data map<string,string>, ts bigint"), ["ts"], 1)
    touched = t.compact(0)
    after = set(t.files())
    assert len(touched) == 1 and len(before & after) == 15
    got = {r.key: r.data for r in t.read().collect()}
    assert len(got) == 200 and got["k7"] == {"name": None, "size": "2"} and got["k8"] == {"name": "n8", "size": "1"}
    for _ in range(2):  # what a base has replaced goes one version later
        t.append(spark.createDataFrame([("k7", {"size": "3"}, 2)], "key string, data map<string,string>, ts bigint"), ["ts"], 2 + _)
        t.compact(0)
    assert len(files(t.path)) < 16 + 8


def test_a_bucket_whose_keys_are_all_deleted_is_empty(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), 2)
    t.append(spark.createDataFrame([("a", "1", 1)], "key string, value string, o bigint"), ["o"], 0)
    t.compact(0)
    t.append(spark.createDataFrame([("a", None, 1)], "key string, value string, o bigint"), ["o"], 1)
    t.append(spark.createDataFrame([], "key string, value string, o bigint"), ["o"], 2)
    assert t.done("batch", 2)
    t.compact(0)
    assert t.read().collect() == [] and t.files() == []


# ------------------------------------------------------------------ S1, S2
def test_topic_offsets_run_on_without_gaps(spark, tmp_path):
    path = str(tmp_path / "topic")
    draw = random.Random(2)
    sent = []
    for batch in range(3):
        rows = [(f"k{draw.randrange(7)}" if draw.random() < 0.9 else None, f"{batch}-{i}", i) for i in range(50)] if batch != 1 else []
        sent += rows
        df = spark.createDataFrame(rows, "k string, value string, i bigint").repartition(4)
        segments.append(df, path, batch, partitions=3, key="k", order=["i"])
        segments.append(df, path, batch, partitions=3, key="k", order=["i"])  # a retry
    got = segments.read(spark, path).collect()
    assert sorted((r.key, r.value) for r in got if r.key) == sorted((k, v) for k, v, _ in sent if k) and len(got) == 100
    ends = segments.end_offsets(spark, path)
    for p in {r.partition for r in got}:
        mine = sorted(r.offset for r in got if r.partition == p)
        assert mine == list(range(ends[p]))
    for key in {r.key for r in got if r.key}:  # one partition, in the order sent
        mine = sorted((r for r in got if r.key == key), key=lambda r: r.offset)
        assert len({r.partition for r in mine}) == 1 and [r.value for r in mine] == [v for k, v, _ in sent if k == key]
    some = segments.read(spark, path, starting={p: e - 1 for p, e in ends.items()}).collect()
    assert len(some) == len(ends)


def test_a_stream_goes_on_at_its_offsets(spark, tmp_path):
    path, out, ck = str(tmp_path / "topic"), str(tmp_path / "out"), str(tmp_path / "ck")
    for batch in range(3):
        segments.append(spark.range(20).select(F.col("id").cast("string").alias("value"), "id"), path, batch, partitions=2, order=["id"])
        segments.read(spark, path, stream=True).writeStream.format("parquet").option("checkpointLocation", ck) \
            .trigger(availableNow=True).start(out).awaitTermination()
    got = [(r.partition, r.offset) for r in spark.read.parquet(out).collect()]
    assert len(got) == 60 == len(set(got))


# ----------------------------------------------------------------- J6, S5
FEED = [("c", 10, "t", "dim_t", "id,name"), ("u", 20, "t", "dim_u", "id"), ("u", 30, "t", "dim_u", "name"), ("u", 40, "t", "dim_t", "id"), ("d", 50, "t", "dim_t", "id")]


def routed(at):
    if 10 <= at < 20:
        return "dim_t", {"id": str(at), "name": "n"}
    if 20 <= at < 30:
        return "dim_u", {"id": str(at)}
    return ("dim_t", {"id": str(at)}) if 40 <= at < 50 else None


@pytest.mark.parametrize("small", [True, False])
def test_routing_by_arrival(spark, small):
    kind = "struct<source_table:string,sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>"
    feed = spark.createDataFrame([(None if op != "d" else (s, k, c, None, None), None if op == "d" else (s, k, c, None, None), op, at) for op, at, s, k, c in FEED],
                                 f"before {kind}, after {kind}, op string, at bigint")
    data = spark.createDataFrame([("t", "insert", {"id": str(i), "name": "n", "x": "y"}, i) for i in range(60)] + [("other", "insert", {"id": "1"}, 45), ("t", "insert", {"name": "n"}, 15)],
                                 "table string, type string, data map<string,string>, at bigint")
    got = upsert.route_by_arrival(data, upsert.config_versions(feed, "at"), small=small).collect()
    assert {(r.at, r.sink_table, tuple(sorted(r.data.items()))) for r in got} == \
        {(i, routed(i)[0], tuple(sorted(routed(i)[1].items()))) for i in range(60) if routed(i)}


def test_config_is_state_of_the_stream(spark, tmp_path):
    root = str(tmp_path)
    text = lambda x: json.dumps(x)
    row = lambda s, k, c: {"source_table": s, "sink_table": k, "sink_columns": c}
    feed = [(text({"op": op, "ts_ms": 1, "before" if op == "d" else "after": row(s, k, c)}), at) for op, at, s, k, c in FEED]
    data = [(text({"database": "d", "table": "t", "type": "insert", "ts": 1, "data": {"id": str(i), "name": "n", "x": "y"}}), i) for i in range(60)] + [("{bad", 33)]
    frame = lambda rows: spark.createDataFrame(rows, "value string, at bigint")
    for n, (low, high) in enumerate([(0, 15), (15, 25), (25, 45), (45, 60)]):
        for name, rows in (("db", data), ("config", feed)):
            part = [r for r in rows if low <= r[1] < high]
            segments.append(frame(part), f"{root}/{name}", n, partitions=1, order=["at"], timestamp=F.col("o0"))
        S.dim_route_stream(spark, f"{root}/db", f"{root}/config", f"{root}/out", checkpoint=f"{root}/ck").awaitTermination()
    got = spark.read.parquet(f"{root}/out/routed").collect()
    assert sorted((int(r.pk), r.sink_table, tuple(sorted(r.data.items()))) for r in got) == \
        sorted((i, routed(i)[0], tuple(sorted(routed(i)[1].items()))) for i in range(60) if routed(i))
    assert [r.value for r in spark.read.text(f"{root}/out/_dirty").select("value").collect()] == ["{bad"]
    assert S.config_state(spark, f"{root}/out").collect() == []  # deleted in the end


def test_hand_over_loses_and_doubles_nothing(spark):
    """A table that changes while it is read in chunks: the changes handed over lead to its final state."""
    draw = random.Random(3)
    table, log, snapshot = {i: "v" for i in range(30)}, [], []
    begun = 50
    for at in range(400):
        if at >= begun and at % 10 == 0 and at < begun + 300:  # a key is read every ten changes
            k = (at - begun) // 10
            if k in table:
                snapshot.append((k, table[k], at - 1))
        k = draw.randrange(40)
        op = "d" if k in table and draw.random() < 0.2 else "u" if k in table else "c"
        if op == "d":
            table.pop(k)
        else:
            table[k] = f"v{at}"
        log.append((op, k, None if op == "d" else f"v{at}", at))
    s = spark.createDataFrame(snapshot, "id bigint, value string, read_at bigint")
    df = upsert.hand_over(s, spark.createDataFrame(log, "op string, id bigint, value string, place bigint"), "id", "read_at", "place", begun - 1)
    rows = df.collect()
    state = {}
    for r in sorted(rows, key=lambda r: r.place):
        state[r.id] = r.value
        if r.op == "d":
            state.pop(r.id)
    untouched = {k for k in range(30, 40)} & {r[1] for r in log if r[3] < begun} - {r[1] for r in log if r[3] >= begun}
    assert {k: v for k, v in table.items() if k not in untouched} == {k: v for k, v in state.items() if k in table} and set(state) <= set(table)
    assert len({(r.id, r.place, r.op == "r") for r in rows}) == len(rows)


# --------------------------------------------------------------------- O4
class Memory:
    """State and timers of one key, without Spark."""

    def __init__(self):
        self.maps, self.timers = {}, set()

    def getMapState(self, name, *_):
        store = self.maps.setdefault(name, {})
        made = lambda **f: type("MapState", (), {k: staticmethod(v) for k, v in f.items()})()
        return made(containsKey=lambda k: k in store, getValue=lambda k: store[k], updateValue=lambda k, v: store.__setitem__(k, v), removeKey=lambda k: store.pop(k))

    def registerTimer(self, at):
        self.timers.add(at)


def test_bounces_of_a_hot_key_cost_in_proportion():
    schema = T.StructType([T.StructField("mid", T.StringType()), T.StructField("ts", T.LongType()), T.StructField("seq", T.LongType()), T.StructField("is_entry", T.BooleanType())])
    draw = random.Random(4)

    def run(n, within, spread):
        rows = sorted((draw.randrange(spread), i, draw.random() < 0.5) for i in range(n))
        p, memory = UserJumpProcessor(schema, ["ts", "seq"], "ts", "is_entry", within), Memory()
        p.init(memory)
        clock = type("Times", (), {"getCurrentWatermarkInMs": lambda self: 0})()
        df = pd.DataFrame([("a", t, i, e) for t, i, e in rows], columns=schema.fieldNames()).sample(frac=1, random_state=1)
        began, out = time.perf_counter(), []
        for part in range(4):
            list(p.handleInputRows(("a",), iter([df.iloc[part::4]]), clock))
        for due in sorted(memory.timers):
            for got in p.handleExpiredTimer(("a",), clock, type("Due", (), {"getExpiryTimeInMs": lambda self, due=due: due})()):
                out += got["seq"].tolist()
        want = [i for (t, i, e), nxt in zip(rows, [*rows[1:], None]) if e and (nxt is None or nxt[0] - t >= within or nxt[2])]
        assert sorted(out) == sorted(want) and not any(memory.maps.values())
        return time.perf_counter() - began

    run(2_000, 15_000, 10_000_000)
    assert run(100_000, 15_000, 15_000) < 15  # all in one window
