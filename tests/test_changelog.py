"""Change-log joins, idle state, as-of lookups, running values and watermarks against literal state machines."""

import json
import random
from itertools import product

import pytest
from pyspark.sql import functions as F

from martflow.operators import changelog, joins, traffic
from martflow.operators.sequence import running
from martflow.streaming.retracting import INPUT, retracting_join


def events(seed, keys=4, n=60, rights=2):
    """(key, side, place, record) with distinct places; keys 0 is hot."""
    draw = random.Random(seed)
    places = draw.sample(range(10 * n), n)
    return [(f"k{min(draw.randrange(2 * keys), keys - 1)}" if draw.random() < 0.6 else "k0", draw.choice([0, *range(1, rights + 1)]), p, f"r{p}") for p in places]


def machine(rows, rights, idle=None, keep_read=True):
    """The log of chained left joins, row by row."""
    state, out = {}, []
    for key, side, at, rec in sorted(rows, key=lambda r: r[2]):
        left, right = state.setdefault(key, ([], []))
        live = lambda t: idle is None or at - t < idle  # noqa: E731, B023
        if side == 0:
            met = [[r for s, t, r in right if s == n and live(t)] for n in range(1, rights + 1)]
            out += [(key, at, False, rec, o) for o in product(*[m or [None] for m in met])]
            left.append([at, rec, met])
            continue
        right.append((side, at, rec))
        for x in [x for x in left if live(x[0])]:
            if not x[2][side - 1]:
                out += [(key, at, True, None, None) for _ in product(*[m or [None] for m in x[2]])]
            out += [(key, at, False, x[1], o) for o in product(*[[rec] if n == side - 1 else m or [None] for n, m in enumerate(x[2])])]
            x[2][side - 1].append(rec)
            if keep_read:
                x[0] = at
    return sorted(out, key=str)


def frames(spark, rows, rights):
    df = spark.createDataFrame(rows, "key string, side int, place bigint, record string")
    one = lambda n, k, r: df.filter(F.col("side") == n).select(F.col("key").alias(k), F.col("record").alias(r), F.col("place").alias(f"p{n}"))
    return [one(n, f"k{n}", f"r{n}") for n in range(rights + 1)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_log_of_left_joins_equals_the_state_machine(spark, seed):
    rows = events(seed)
    left, a, b = frames(spark, rows, 2)
    j = changelog.appended(left, F.col("p0")).drop("p0")
    for n, r in ((1, a), (2, b)):
        j = changelog.left_outer(j, changelog.appended(r, F.col(f"p{n}")).drop(f"p{n}"), "k0", f"k{n}")
    got = changelog.log(j.select(F.col("k0").alias("key"), "r0", "r1", "r2", changelog.FROM, changelog.TO), ["key"])
    got = sorted(((r.key, r.place, r.tombstone, r.r0, None if r.tombstone else (r.r1, r.r2)) for r in got.collect()), key=str)
    assert got == machine(rows, 2)


def test_left_outer_shuffles_each_side_once(spark):
    left = changelog.appended(spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, p long"), F.col("p"))
    right = changelog.appended(spark.createDataFrame([("a", 5, "x"), ("a", 4, "y"), ("a", None, "z"), (None, 1, "n")], "rk string, q long, v string"), F.col("q"))
    out = changelog.left_outer(left, right.drop("q"), "k", "rk")
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    got = sorted(((r.k, r.v, r[changelog.FROM], r[changelog.TO]) for r in out.collect()), key=str)
    assert got == sorted([("a", None, 1, 4), ("a", "x", 5, None), ("a", "y", 4, None), ("a", "z", 1, None), ("b", None, 2, None), (None, None, 3, None)], key=str)


@pytest.mark.parametrize("rule", ["create", "read_write"])
def test_idle_left_join_equals_the_state_machine(spark, rule):
    for seed in (4, 5):
        rows = events(seed, n=120, rights=1)
        left, right = frames(spark, rows, 1)
        got = changelog.idle_left_outer(left, right, "k0", "k1", "p0", "p1", 40, rule, "r0")
        log = changelog.log(got.select(F.col("k0").alias("key"), "r0", "r1", changelog.FROM, changelog.TO), ["key"]).collect()
        got = sorted(((r.key, r.place, r.tombstone, r.r0, None if r.tombstone else (r.r1,)) for r in log), key=str)
        want = machine(rows, 1, 40, rule == "read_write")
        assert got == want
    assert machine(rows, 1, 40, True) != machine(rows, 1, 40, False)


def test_left_joins_of_null_keys_and_empty_sides(spark):
    left = changelog.appended(spark.createDataFrame([(None, "a", 1), ("x", "b", 2)], "k0 string, r0 string, p bigint"), F.col("p")).drop("p")
    none = changelog.appended(spark.createDataFrame([(None, "c", 3)], "k1 string, r1 string, q bigint"), F.col("q")).drop("q")
    got = changelog.log(changelog.left_outer(left, none, "k0", "k1"), ["k0"]).collect()
    assert sorted((r.r0, r.tombstone, r.r1) for r in got) == [("a", False, None), ("b", False, None)]


@pytest.mark.parametrize("idle, rule", [(None, "read_write"), (40_000, "read_write"), (40_000, "create")])
def test_stream_log_equals_the_state_machine(spark, tmp_path, idle, rule):
    rows = sorted(events(6, n=80), key=lambda r: r[2])
    source = str(tmp_path / "in")
    for k in range(0, 80, 20):  # four micro-batches in order of arrival
        part = [(key, side, 1000 * p, p, rec) for key, side, p, rec in rows[k:k + 20]]
        spark.createDataFrame(part, "key string, side int, at bigint, place bigint, record string").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema("key string, side int, at bigint, place bigint, record string").option("maxFilesPerTrigger", 1).parquet(source)
    out = retracting_join(stream.select(*INPUT), 2, idle, rule)
    q = out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out"))
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted(((r.key, r.place, r.tombstone, r.left, None if r.tombstone else tuple(r.rights)) for r in got), key=str)
    scale = None if idle is None else idle // 1000
    assert got == machine(rows, 2, scale, rule == "read_write")


# ------------------------------------------------------------ running values
@pytest.mark.parametrize("how", ["last", "max", "sum"])
def test_running_equals_a_loop(spark, how):
    draw = random.Random(how)
    rows = [(f"k{draw.randrange(3)}", i, draw.choice([None, draw.randrange(100)])) for i in range(300)]
    df = spark.createDataFrame(draw.sample(rows, len(rows)), "k string, i bigint, v bigint").repartition(4)
    step = {"last": lambda a, v: v, "max": max, "sum": lambda a, v: a + v}[how]
    for keys in (["k"], []):
        for inclusive in (True, False):
            got = {r.i: r.o for r in running(df, keys, ["i"], F.floor(F.col("i") / 7).cast("bigint"), "v", "o", how, inclusive, (3, 2)).collect()}
            acc = {}
            for k, i, v in rows:
                k = k if keys else ""
                before = acc.get(k)
                if v is not None:
                    acc[k] = v if before is None else step(before, v)
                assert got[i] == (acc.get(k) if inclusive else before), (keys, inclusive, i)


def test_running_keeps_its_windows_by_bucket(spark):
    df = spark.range(10).select(F.col("id").alias("i"), F.lit(1).alias("v"))
    plan = running(df, [], ["i"], F.floor(F.col("i") / 4).cast("bigint"), "v", "o")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 3 and sum("[__run_b" in w.split("ROWS")[0] or "__run_b" in w for w in windows) == 3


# ------------------------------------------------------------------ J4
@pytest.mark.parametrize("how", ["inner", "left"])
def test_lookup_as_of_equals_a_loop_on_both_ways(spark, how):
    draw = random.Random(7)
    versions = [(draw.choice("abc"), draw.randrange(1000), f"n{i}", draw.random() < 0.2) for i in range(60)] + [(None, 0, "x", False), ("a", None, "y", False)]
    facts = [(i, draw.choice(["a", "b", "c", "d", None]), draw.choice([None, *range(0, 1000, 13)])) for i in range(400)]
    f = spark.createDataFrame(facts, "id bigint, code string, at bigint")
    v = spark.createDataFrame(versions, "code string, valid_from bigint, name string, gone boolean")

    def want(code, at):
        fit = [x for x in versions if code is not None and at is not None and x[0] == code and x[1] is not None and x[1] <= at]
        last = max(fit, key=lambda x: (x[1], x[2], x[3]), default=None)
        return None if last is None or last[3] else last[2]

    plain = sorted((i, n) for i, c, t in facts for n in [want(c, t)] if how == "left" or n is not None) if how == "inner" else \
        sorted(((i, want(c, t)) for i, c, t in facts), key=str)
    for small in (True, False):
        got = joins.lookup_as_of(f, v, "code", "code", "at", ["name"], how, gone="gone", bucket=50, small=small)
        assert got.columns == ["id", "code", "at", "name"]
        assert sorted(((r.id, r.name) for r in got.collect()), key=str) == sorted(plain, key=str), small


def test_dictionary_versions(spark):
    rows = [("base_dic", "insert", 5, {"dic_code": "1", "dic_name": "one"}), ("base_dic", "delete", 9, {"dic_code": "1", "dic_name": "one"}),
            ("other", "insert", 1, {"dic_code": "2"}), ("base_dic", "bootstrap-start", 1, {})]
    env = spark.createDataFrame(rows, "table string, type string, ts bigint, data map<string,string>")
    got = joins.dictionary_versions(env, "base_dic", "dic_code", ["dic_code", "dic_name"]).collect()
    assert sorted(tuple(r) for r in got) == [("1", 5, "one", False), ("1", 9, "one", True)]


# -------------------------------------------------------------- W1, W5
def test_late_records_equal_a_loop(spark):
    draw = random.Random(8)
    rows = [(i, 1000 * i - draw.choice([0, 0, 500, 2001, 2002, 9000])) for i in range(300)] + [(300, None), (301, 10**9)]
    df = spark.createDataFrame(draw.sample(rows, len(rows)), "i bigint, ts bigint").repartition(3)
    newest, late = None, set()
    for i, ts in rows:
        if ts is not None and newest is not None and ts <= newest - 2001:
            late.add(i)
        newest = max(x for x in (newest, ts, -10**18) if x is not None)
    on_time, behind = traffic.split_late(df, ["i"], F.floor(F.col("i") / 16).cast("bigint"))
    assert {r.i for r in behind.collect()} == late and {r.i for r in on_time.collect()} == {i for i, _ in rows} - late
    assert on_time.columns == ["i", "ts"]
