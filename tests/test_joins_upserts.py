"""J7 interval join, lookup join, K7 latest, O7 column merge, O8/J6 routing."""

import random

import pytest
from pyspark.sql import functions as F

from martflow.operators import joins, upsert
from martflow.plans import jobs
from martflow.streaming.jobs import read_dimension, upsert_dimensions


def test_interval_join_bounds(spark):
    left = spark.createDataFrame([("k", 10_000)], "lk string, lts long")
    right = spark.createDataFrame([("k", 7_000, 1), ("k", 13_000, 2), ("k", 13_001, 3), ("j", 10_000, 4)],
                                  "rk string, rts long, rid int")
    got = sorted(r.rid for r in joins.interval_join(left, right, "lk", "rk", "lts", "rts",
                                                    -3_000, 3_000).collect())
    assert got == [1, 2]


def test_interval_join_matches_naive(spark):
    rnd = random.Random(3)
    lrows = [(f"k{rnd.randint(0, 3)}", rnd.randint(0, 100_000), i) for i in range(300)]
    rrows = [(f"k{rnd.randint(0, 3)}", rnd.randint(0, 100_000), i) for i in range(300)]
    left = spark.createDataFrame(lrows, "lk string, lts long, lid int")
    right = spark.createDataFrame(rrows, "rk string, rts long, rid int")
    for lo, hi in [(-3_000, 3_000), (0, 5_000), (-7_000, -1_000)]:
        for how in ("inner", "left"):
            fast = joins.interval_join(left, right, "lk", "rk", "lts", "rts", lo, hi, how)
            naive = left.join(right, (left.lk == right.rk) & right.rts.between(left.lts + lo, left.lts + hi), how)
            key = lambda r: (r.lid, -1 if r.rid is None else r.rid)
            assert sorted(map(key, fast.collect())) == sorted(map(key, naive.collect()))


def test_lookup_join_checked_broadcast(spark):
    facts = spark.createDataFrame([("A", 1), ("B", 2)], "code string, v int")
    dic = spark.createDataFrame([("A", "x")], "dic_code string, dic_name string")
    j = joins.lookup_join(facts, dic, "code", "dic_code")
    assert [(r.v, r.dic_name) for r in j.collect()] == [(1, "x")]
    assert "BroadcastHashJoin" in j._jdf.queryExecution().executedPlan().toString()
    assert joins.has_at_most(dic, 1) and not joins.has_at_most(facts, 1)
    assert not joins.has_at_most(dic, 1, max_bytes=1)


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), ("b", 1, "z", False),
                                ("b", 3, None, True)], "k string, seq int, v string, gone boolean")
    got = sorted(tuple(r) for r in upsert.latest(df, ["k"], ["seq"], drop_deleted="gone").collect())
    assert got == [("a", 2, "y")]


def test_partial_upsert(spark):
    ch = spark.createDataFrame([("1", {"id": "1", "a": "a1", "b": "b1"}, 1), ("1", {"id": "1", "a": "a2"}, 2)],
                               "pk string, data map<string,string>, seq int")
    r = upsert.merge_columns(ch, ["pk"], "data", ["a", "b"], ["seq"]).first()
    assert (r.a, r.b) == ("a2", "b1")


def _cfg(spark, rows):
    out = []
    for op, ts, src, sink, cols in rows:
        row = (src, sink, cols, None, None)
        out.append((row if op == "d" else None, None if op == "d" else row, op, ts))
    schema = ("before struct<source_table:string,sink_table:string,sink_columns:string,"
              "sink_pk:string,sink_extend:string>, after struct<source_table:string,"
              "sink_table:string,sink_columns:string,sink_pk:string,sink_extend:string>, "
              "op string, ts_ms bigint")
    return spark.createDataFrame(out, schema)


def _data(spark, rows):
    return spark.createDataFrame(
        [("db", t, typ, ts, None, None, d, None) for t, typ, ts, d in rows],
        "database string, table string, type string, ts long, xid long, commit string, "
        "data map<string,string>, old map<string,string>")


def test_config_delete_as_of_and_whitelist(spark):
    cfg = _cfg(spark, [("c", 10, "c", "dim_c", "id,name"), ("d", 20, "c", "dim_c", "id,name"),
                       ("r", 0, "x", "dim_x", None)])
    data = _data(spark, [("c", "insert", 5, {"id": "1", "name": "a", "x": "q"}),
                         ("c", "insert", 15, {"id": "2", "name": "b", "x": "q"}),
                         ("c", "insert", 25, {"id": "3", "name": "c"})])
    routed = upsert.route_dimensions(data, upsert.config_intervals(cfg), time_col="ts")
    got = [(r.pk, r.data) for r in routed.collect()]
    assert got == [("2", {"id": "2", "name": "b"})]
    live, rejected = upsert.fold_config(cfg)
    assert live.count() == 0 and [r.source_table for r in rejected.collect()] == ["x"]


def test_delete_rows_are_upserted_unless_dropped(spark):
    cfg = _cfg(spark, [("r", 0, "c", "dim_c", "id,name")])
    data = _data(spark, [("c", "insert", 1, {"id": "1", "name": "a"}),
                         ("c", "delete", 2, {"id": "1", "name": "a"})])
    tables, _ = jobs.dim_sync(data, cfg, order_cols=["ts"])
    assert tables["dim_c"].count() == 1
    live, _ = upsert.fold_config(cfg)
    assert upsert.route_dimensions(data, live, drop_deletes=True).count() == 1


def test_dimension_sink_versions(spark, scratch):
    cfg, _ = upsert.fold_config(_cfg(spark, [("r", 0, "c", "dim_c", "id,a,b"), ("r", 0, "e", "dim_e", "id,z")]))
    b0 = _data(spark, [("c", "insert", 1, {"id": "1", "a": "a1", "b": "b1"})])
    b1 = _data(spark, [("c", "update", 2, {"id": "1", "a": "a2"}), ("c", "insert", 2, {"a": "no key"}),
                       ("c", "insert", 3, {"id": "2", "a": "x", "b": "y"})])
    assert upsert_dimensions(spark, b0, cfg, scratch, 0) == {"dim_c": 0, "dim_e": 0}  # created at config time
    assert read_dimension(spark, scratch, "dim_e").columns == ["id", "z"]
    assert upsert_dimensions(spark, b1, cfg, scratch, 1) == {"dim_c": 1}  # only what the batch touches
    assert upsert_dimensions(spark, b1, cfg, scratch, 1) == {}  # a retried batch is done already
    cur = sorted(tuple(r) for r in read_dimension(spark, scratch, "dim_c").collect())
    assert cur == [("1", "a2", "b1"), ("2", "x", "y")]
    # a new stream checkpoint counts its batches from 0 again; a column joins the config
    wider, _ = upsert.fold_config(_cfg(spark, [("r", 0, "c", "dim_c", "id,a,b,d")]))
    b2 = _data(spark, [("c", "update", 1, {"id": "2", "d": "new"})])
    assert upsert_dimensions(spark, b2, wider, scratch, 0, query_id="again") == {"dim_c": 2}
    cur = sorted(tuple(r) for r in read_dimension(spark, scratch, "dim_c").collect())
    assert cur == [("1", "a2", "b1", None), ("2", "x", "y", "new")]


def test_dimension_read_errors_are_not_empty_tables(spark, scratch):
    import os
    cfg, _ = upsert.fold_config(_cfg(spark, [("r", 0, "c", "dim_c", "id,a")]))
    assert read_dimension(spark, scratch, "dim_c") is None
    upsert_dimensions(spark, _data(spark, [("c", "insert", 1, {"id": "1", "a": "x"})]), cfg, scratch, 0)
    path = f"{scratch}/dim_c/version=0"
    for f in os.listdir(path):
        if f.startswith("part"):
            with open(f"{path}/{f}", "wb") as out:
                out.write(b"broken")
    with pytest.raises(Exception):
        upsert_dimensions(spark, _data(spark, [("c", "update", 2, {"id": "1", "a": "y"})]), cfg, scratch, 1)


def test_changes_of_one_second_follow_their_order(spark, scratch):
    cfg, _ = upsert.fold_config(_cfg(spark, [("r", 0, "c", "dim_c", "id,a")]))
    rows = _data(spark, [("c", "insert", 5, {"id": "1", "a": "first"}), ("c", "update", 5, {"id": "1", "a": "second"})])
    for sign, want in ((1, "second"), (-1, "first")):
        numbered = rows.withColumn("seq", F.when(F.col("type") == "update", sign).otherwise(0))
        out = f"{scratch}/{want}"
        upsert_dimensions(spark, numbered, cfg, out, 0, order_cols=("ts", "seq"))
        assert read_dimension(spark, out, "dim_c").first().a == want
