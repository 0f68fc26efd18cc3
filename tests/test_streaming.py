"""Stream versus batch: replay the sf0.001 tables as file topics in several
files (one file per micro-batch) and compare with the batch operators."""

import json
import os
import time

from pyspark.sql import functions as F

from conftest import SF001
from martflow.operators import joins, trade, traffic, upsert
from martflow.plans import jobs
from martflow.sources import tables as T
from martflow.sources.envelope import parse_envelope
from martflow.sources.topics import read_topic
from martflow.streaming import jobs as S

TRAFFIC_SCHEMA = "event_id long, mid string, ts long, is_new string, is_entry boolean"


def _chunks(df, path, n=3, col="event_id", fmt="parquet"):
    """Write ``df`` as ``n`` files, in order of ``col`` (one micro-batch each)."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = df.filter((F.col(col) >= lo + i * step) & (F.col(col) < lo + (i + 1) * step))
        if fmt == "text":
            part = part.select("value")
        out = part.coalesce(1).write.mode("overwrite")
        # file topics are laid out as batch=<n> folders (as the topic writer does)
        (out.parquet if fmt == "parquet" else out.text)(f"{path}/batch={i}")
    return [f"{path}/batch={i}" for i in range(n)]


def _stream_parquet(spark, dirs, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(os.path.dirname(dirs[0]))


def _run(df, out, ckpt, trigger=None):
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt) \
        .trigger(**(trigger or {"availableNow": True})).outputMode("append").start()
    _drain(q)


# State with a processing-time TTL keeps no-data batches running.
TTL_TRIGGER = {"availableNow": True}


def _drain(q, timeout=300):
    """Wait until the query ends or has consumed its files, then stop it.

    A query with processing-time TTL state keeps running no-data batches to
    expire state and never ends on its own; it counts as drained at its
    first batch without input after the data batches.
    """
    deadline = time.time() + timeout
    while q.isActive and time.time() < deadline:
        if q.awaitTermination(1):
            break
        prog = q.recentProgress
        if any(p["numInputRows"] > 0 for p in prog) and prog[-1]["numInputRows"] == 0:
            break
    assert q.exception() is None
    q.stop()


def _traffic(spark):
    return T.traffic_rows(spark, SF001).select("event_id", "mid", "ts", "is_new", "is_entry")


def test_visitor_repair_stream_equals_batch(spark, scratch):
    src = _traffic(spark)
    dirs = _chunks(src, f"{scratch}/in")
    s = _stream_parquet(spark, dirs, TRAFFIC_SCHEMA)
    _run(S.visitor_repair_stream(s, "mid", "ts", "is_new", seq="event_id"), f"{scratch}/out", f"{scratch}/ck")
    got = {r.event_id: r.is_new for r in spark.read.parquet(f"{scratch}/out").collect()}
    want = {r.event_id: r.is_new for r in
            traffic.repair_new_visitor(src, order=["ts", "event_id"]).collect()}
    assert len(got) == len(want), (len(got), len(want), sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3])
    assert got == want


def test_unique_visitor_stream_equals_batch(spark, scratch):
    src = _traffic(spark).filter("is_entry")
    dirs = _chunks(src, f"{scratch}/in")
    s = _stream_parquet(spark, dirs, TRAFFIC_SCHEMA)
    _run(S.unique_visitor_stream(s, "mid", "ts", seq="event_id"), f"{scratch}/out", f"{scratch}/ck",
         TTL_TRIGGER)
    got = sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect())
    want = sorted(r.event_id for r in traffic.unique_visitor(src, order=["ts", "event_id"]).collect())
    assert len(got) == len(want), (len(got), len(want), sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3])
    assert got == want


def test_user_jump_stream_equals_batch(spark, scratch):
    within = 6 * 3600 * 1000
    src = _traffic(spark)
    dirs = _chunks(src, f"{scratch}/in")
    # flush events: far in the future, so the watermark passes every real timer
    mx = src.agg(F.max("ts")).first()[0]
    for i, gap in enumerate([2 * within, 4 * within]):
        spark.createDataFrame([(10**9 + i, "__flush__", mx + gap, "0", False)], TRAFFIC_SCHEMA) \
            .coalesce(1).write.parquet(f"{scratch}/in/zflush{i}")
    s = _stream_parquet(spark, dirs, TRAFFIC_SCHEMA)
    j = S.user_jump_stream(s, "mid", "ts", "event_id", "is_entry", within_ms=within)
    _run(j, f"{scratch}/out", f"{scratch}/ck")
    got = sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect())
    want = sorted(r.event_id for r in traffic.user_jump(src, F.col("is_entry"), order=["ts", "event_id"],
                                                         within_ms=within).collect())
    assert len(got) == len(want), (len(got), len(want), sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3])
    assert got == want


def test_interval_join_stream_equals_batch(spark, scratch):
    e = T.traffic_rows(spark, SF001)
    left = e.filter("event_type = 'click'").select(F.col("event_id").alias("lid"), F.col("mid").alias("lk"),
                                                   F.col("ts").alias("lts"))
    right = e.filter("event_type = 'purchase'").select(F.col("event_id").alias("rid"),
                                                       F.col("mid").alias("rk"), F.col("ts").alias("rts"))
    lp, rp = f"{scratch}/l", f"{scratch}/r"
    left.write.parquet(lp)
    right.write.parquet(rp)
    ls = spark.readStream.schema(left.schema).parquet(lp)
    rs = spark.readStream.schema(right.schema).parquet(rp)
    j = S.interval_join_stream(ls, rs, "lk", "rk", "lts", "rts", -3_600_000, 3_600_000)
    _run(j.select("lid", "rid"), f"{scratch}/out", f"{scratch}/ck")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/out").collect())
    want = sorted((r.lid, r.rid) for r in joins.interval_join(
        left, right, "lk", "rk", "lts", "rts", -3_600_000, 3_600_000).collect())
    assert got == want and len(got) > 0


def test_base_log_stream_equals_batch(spark, scratch):
    text = T.log_text(spark, SF001)
    _chunks(text, f"{scratch}/topic", fmt="text")
    bad = spark.createDataFrame([("{broken",)], "value string")
    bad.coalesce(1).write.text(f"{scratch}/topic/batch=9")
    topic = f"{scratch}/topic"
    main, dirty = S.base_log_stream(spark, topic, f"{scratch}/out", checkpoint=f"{scratch}/ck",
                                    trigger={"availableNow": True})
    for q in (main, dirty):
        _drain(q)
    batch = jobs.base_log(read_topic(spark, topic).select("value"))
    for name in ("page", "start", "action", "display", "error"):
        got = sorted(r.value for r in spark.read.text(f"{scratch}/out/{name}").collect())
        assert got == sorted(r.value for r in batch[name].collect()) and got, name
    assert spark.read.text(f"{scratch}/out/dirty").count() == 1


def test_lookup_stream_cart_add(spark, scratch):
    env = T.topic_db(spark, SF001, ("cart_info",))
    topic = f"{scratch}/db"
    env.select(F.to_json(F.struct(*env.columns)).alias("value")).coalesce(2).write.text(topic)
    dic_path = f"{scratch}/base_dic"
    T.base_dic(spark).write.parquet(dic_path)
    stream, _ = parse_envelope(read_topic(spark, topic, stream=True))
    q = S.lookup_stream(spark, stream, lambda b, d: trade.cart_add(b, d).drop("pt"),
                        lambda: spark.read.parquet(dic_path), f"{scratch}/out",
                        checkpoint=f"{scratch}/ck")
    _drain(q)
    got = spark.read.json(f"{scratch}/out").count()
    assert got == trade.cart_add(env, T.base_dic(spark)).count() > 0


def test_keyed_topic_roundtrip(spark, scratch):
    from martflow.sinks.topics import write_keyed
    from martflow.sources.topics import read_keyed_topic
    df = spark.createDataFrame([("1", "a", False), ("1", "b", False), ("2", "c", False), ("2", None, True)],
                               "id string, v string, gone boolean")
    df = df.withColumn("n", F.when(F.col("v") == "b", 2).otherwise(1))
    write_keyed(df.filter("v IS NOT NULL"), f"{scratch}/k", ["id"], order=F.col("n"), batch_id=0)
    write_keyed(df.filter("gone"), f"{scratch}/k", ["id"], order=F.col("n"), batch_id=1, tombstone="gone")
    log = read_keyed_topic(spark, f"{scratch}/k", drop_tombstones=False)
    assert log.count() == 4
    cur = upsert.latest(log.withColumn("gone", F.col("value").isNull()), ["key"], ["batch_id", "offset"],
                        drop_deleted="gone")
    assert [(r.key, json.loads(r.value)["v"]) for r in cur.collect()] == [('{"id":"1"}', "b")]
    assert read_keyed_topic(spark, f"{scratch}/k").count() == 3


def test_dim_sync_stream_equals_batch(spark, scratch):
    env = T.dimension_changes(spark, SF001)
    topic = f"{scratch}/db"
    env.select(F.to_json(F.struct(*env.columns)).alias("value")).coalesce(2).write.text(topic)
    cfg = T.config_feed(spark)
    cfg_topic = f"{scratch}/cfg"
    cfg.select(F.to_json(F.struct(*cfg.columns)).alias("value")).coalesce(1).write.text(cfg_topic)
    q = S.dim_sync_stream(spark, topic, cfg_topic, f"{scratch}/dims", checkpoint=f"{scratch}/ck")
    _drain(q)
    tables, rejected = jobs.dim_sync(env, cfg, order_cols=["ts"])
    assert sorted(tables) == ["dim_customer", "dim_part", "dim_supplier"]
    assert [r.source_table for r in rejected.collect()] == ["region"]
    for name, df in tables.items():
        cur = S.read_dimension(spark, f"{scratch}/dims", name)
        assert sorted(map(tuple, cur.collect())) == sorted(map(tuple, df.collect())), name


def test_order_pre_process_stream_equals_batch(spark, scratch):
    tables = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon")
    env = T.topic_db(spark, SF001, tables)
    topic = f"{scratch}/db"
    # replay in change-time order, two files
    mid_ts = env.agg(F.percentile_approx("ts", 0.5)).first()[0]
    for i, cond in enumerate([F.col("ts") <= mid_ts, F.col("ts") > mid_ts]):
        env.filter(cond).select(F.to_json(F.struct(*env.columns)).alias("value")).coalesce(1) \
            .write.text(f"{topic}/batch={i}")
    # flush changes far in the future for every source table move the watermark
    # past all real rows (two files: the second runs after the first's watermark)
    mx = env.agg(F.max("ts")).first()[0]
    # (the test tables' order and ship dates are up to years apart)
    for i, gap in enumerate([9000 * 86400, 18000 * 86400, 27000 * 86400]):
        flush = [{"database": "d", "table": t, "type": "insert", "ts": mx + gap,
                  "data": {"id": f"flush{i}", "order_id": "none", "order_detail_id": "none",
                           "source_type": "Z"}} for t in tables]
        spark.createDataFrame([(json.dumps(r),) for r in flush], "value string").coalesce(1) \
            .write.text(f"{topic}/batch={2 + i}")
    stream, _ = parse_envelope(read_topic(spark, topic, stream=True,
                                          options={"maxFilesPerTrigger": "1"}))
    joined = S.order_pre_process_stream(stream, retention_s=4000 * 86400, side_retention_s=60,
                                        delay="0 seconds")
    dic = T.base_dic(spark)
    q = joined.writeStream.foreachBatch(
        lambda b, i: S.with_dictionary(b, dic, F.lit(None).cast("timestamp"))
        .withColumn("old", F.to_json("old")).write.mode("append").parquet(f"{scratch}/out")) \
        .option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
    _drain(q)
    got = sorted((r.id, r.type, r.activity_id, r.coupon_id) for r in spark.read.parquet(f"{scratch}/out").collect())
    pre = trade.order_pre_process(env, dic, F.lit(None).cast("timestamp"))
    want = sorted((r.id, r.type, r.activity_id, r.coupon_id) for r in pre.collect())
    assert len(got) == len(want), (len(got), len(want), sorted(set(want) - set(got))[:3], sorted(set(got) - set(want))[:3])
    assert got == want


def test_unique_visitor_stream_by_arrival(spark, scratch):
    # entries on d1, d1, d2, d1 in arrival order, all in one micro-batch -> 1st, 3rd, 4th
    d1 = 1_700_000_000_000
    rows = [(1, "m", d1, "1", True), (2, "m", d1 + 10, "1", True),
            (3, "m", d1 + 86_400_000, "1", True), (4, "m", d1 + 20, "1", True)]
    spark.createDataFrame(rows, TRAFFIC_SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/batch=0")
    s = _stream_parquet(spark, [f"{scratch}/in/batch=0"], TRAFFIC_SCHEMA)
    _run(S.unique_visitor_stream(s, "mid", "ts", seq="event_id", by_arrival=True),
         f"{scratch}/out", f"{scratch}/ck", TTL_TRIGGER)
    assert sorted(r.event_id for r in spark.read.parquet(f"{scratch}/out").collect()) == [1, 3, 4]


def test_detail_and_pay_streams_equal_batch(spark, scratch):
    from martflow.sinks.topics import write_keyed
    tables = ("order_detail", "order_info", "order_detail_activity", "order_detail_coupon", "payment_info")
    env = T.topic_db(spark, SF001, tables)
    dic = T.base_dic(spark)
    clock = F.lit(None).cast("timestamp")
    pre = trade.order_pre_process(env, dic, clock)
    # job 6 output as a keyed topic, written in two batches
    half = pre.agg(F.percentile_approx("od_ts", 0.5)).first()[0]
    write_keyed(pre.filter(F.col("od_ts") <= half), f"{scratch}/pre", ["id"], order=F.col("oi_ts"), batch_id=0)
    write_keyed(pre.filter(F.col("od_ts") > half), f"{scratch}/pre", ["id"], order=F.col("oi_ts"), batch_id=1)
    pre_stream = S.read_pre_process(spark, f"{scratch}/pre")
    placed, cancelled = S.detail_streams(pre_stream)
    _run(cancelled.select("id", "order_status"), f"{scratch}/cancel", f"{scratch}/ck1")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/cancel").collect())
    want = sorted((r.id, r.order_status) for r in trade.cancel_detail(pre).collect())
    assert got == want and len(got) > 0
    # job 9: payments topic x placed stream (bound covers the test tables' date spread)
    topic = f"{scratch}/db"
    env.select(F.to_json(F.struct(*env.columns)).alias("value")).coalesce(1).write.text(f"{topic}/batch=0")
    env_stream, _ = parse_envelope(read_topic(spark, topic, stream=True))
    pay = S.pay_detail_stream(env_stream, placed, dic, bound_s=4000 * 86400, delay="0 seconds")
    _run(pay.filter("NOT late").select("id", "payment_type", "pay_time"), f"{scratch}/pay", f"{scratch}/ck2")
    got = sorted(tuple(r) for r in spark.read.parquet(f"{scratch}/pay").collect())
    want = sorted((r.id, r.payment_type, r.pay_time)
                  for r in trade.pay_detail(env, trade.order_detail(pre), dic).collect())
    assert got == want and len(got) > 0


def test_page_topic_jobs_equal_batch(spark, scratch):
    # job 2 output (page topic) -> jobs 3 and 4 as streams
    page = jobs.base_log(T.log_text(spark, SF001).select("value"))["page"]
    page.select("value").coalesce(1).write.text(f"{scratch}/page/batch=0")
    uv = S.unique_visitor_job_stream(spark, f"{scratch}/page", f"{scratch}/uv",
                                     checkpoint=f"{scratch}/ck1", trigger={"availableNow": True})
    _drain(uv)
    want_uv = jobs.unique_visitor_detail(page).count()
    assert spark.read.text(f"{scratch}/uv").count() == want_uv > 0
    # bounce with a 6 h limit; a flush page far in the future fires every timer
    within = 6 * 3600 * 1000
    mx = page.agg(F.max("ts")).first()[0]
    flush = [json.dumps({"common": {"mid": "__flush__"}, "page": {"page_id": "x", "last_page_id": "y"},
                         "ts": mx + k * within}) for k in (2, 4)]
    for i, line in enumerate(flush):
        spark.createDataFrame([(line,)], "value string").coalesce(1).write.text(f"{scratch}/page/batch={1 + i}")
    uj = S.user_jump_job_stream(spark, f"{scratch}/page", f"{scratch}/uj", checkpoint=f"{scratch}/ck2",
                                options={"maxFilesPerTrigger": "1"}, within_ms=within)
    _drain(uj)
    want_uj = jobs.user_jump_detail(page, within_ms=within).count()
    assert spark.read.text(f"{scratch}/uj").count() == want_uj > 0


def test_user_jump_state_is_freed(spark, scratch):
    """Keys with rows that no entry needs, and entries followed by a long tail, leave nothing behind."""
    t0 = 1_700_000_000_000
    rows = [(i, "m", t0 + i * 1000, "0", i == 0) for i in range(200)] + \
           [(1000 + i, "none", t0 + i * 1000, "0", False) for i in range(200)]
    spark.createDataFrame(rows, TRAFFIC_SCHEMA).coalesce(1).write.parquet(f"{scratch}/in/batch=0")
    for i, gap in enumerate((7, 14)):
        spark.createDataFrame([(5000 + i, "flush", t0 + gap * 86_400_000, "0", False)], TRAFFIC_SCHEMA) \
            .coalesce(1).write.parquet(f"{scratch}/in/zflush{i}")
    s = _stream_parquet(spark, [f"{scratch}/in/batch=0"], TRAFFIC_SCHEMA)
    _run(S.user_jump_stream(s, "mid", "ts", "event_id"), f"{scratch}/out", f"{scratch}/ck")
    assert spark.read.schema(TRAFFIC_SCHEMA).parquet(f"{scratch}/out").count() == 0
    state = spark.read.format("statestore").option("stateVarName", "rows").load(f"{scratch}/ck").collect()
    assert {r.key.mid for r in state} <= {"flush"}


def test_kafka_options_reach_reader_and_writer(spark, scratch, monkeypatch):
    """No broker here: the calls show that format, topic and options arrive."""
    from martflow.sinks import topics as sink
    from martflow.streaming import jobs as module
    seen = []
    dirs = _chunks(T.open_log_lines(spark, SF001), f"{scratch}/topic", n=1, fmt="text")

    def reader(session, topic, *, fmt="file", stream=False, options=None, arrival=False):
        seen.append(("read", topic, fmt, options))
        return read_topic(session, os.path.dirname(dirs[0]), stream=stream, arrival=arrival)

    monkeypatch.setattr(module, "read_topic", reader)

    def write(df, topic, *, fmt="file", batch_id=None, options=None, serialise=True):
        seen.append(("write", topic, fmt, options))
        df.write.format("noop").mode("overwrite").save()

    monkeypatch.setattr(sink, "write_append", write)
    monkeypatch.setattr(module, "write_append", write)
    for q in S.base_log_stream(spark, "log", "unused", fmt="kafka", options={"a": "1"}, out_fmt="kafka",
                               out_options={"b": "2"}, checkpoint=f"{scratch}/ck"):
        _drain(q)
    assert ("read", "log", "kafka", {"a": "1"}) in seen
    assert {x[1] for x in seen if x[0] == "write"} == {"page", "start", "action", "display", "error", "dirty"}
    assert all(x[2:] == ("kafka", {"b": "2"}) for x in seen if x[0] == "write")
