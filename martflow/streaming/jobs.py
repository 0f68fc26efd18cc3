"""Streaming forms of the warehouse jobs (Structured Streaming).

* stateful traffic operators via ``transformWithState`` (O2, O3, O4)
* stream-stream joins with watermarks and a time range (J1, J2, J7, O6)
* micro-batch sinks via ``foreachBatch``: dictionary re-read per batch (J4),
  config-driven dimension upserts (J6, K4, K5, O7, O8), fan-out (K6)

Every sink writes one folder per ``batch_id`` (overwrite), so a micro-batch
retried after an executor or driver loss replaces its own output.
Checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from martflow.functions.timefmt import previous_day_str, to_date_str
from martflow.operators import trade, traffic, upsert
from martflow.operators.joins import stream_interval_join
from martflow.session import checkpoint_root, column_family_state, land
from martflow.sinks import segments
from martflow.sinks.topics import fan_out, write_append, write_keyed
from martflow.sources.envelope import LOG_SCHEMA, parse_config_feed, parse_envelope, parse_strict
from martflow.sources.topics import ARRIVAL, read_topic
from martflow.streaming import processors
from martflow.streaming.processors import BEFORE, VISIT, FirstVisitProcessor, UniqueVisitorProcessor, UserJumpRowProcessor

# The Python worker in which the driver sets up a processor has only the path that the driver process was started with.
register_pickle_by_value(processors)


def _ckpt(spark: SparkSession, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{checkpoint_root(spark)}/streams/{name}"


def _order(ts: str, seq: str | Sequence[str] | None, by_arrival: bool) -> list[str]:
    """Order of a key's rows inside a micro-batch: event time then arrival, or arrival alone."""
    arrival = [seq] if isinstance(seq, str) else list(seq or ())
    return arrival if by_arrival and arrival else [ts, *arrival]


def _dated(df: DataFrame, ts: str, tz: str) -> DataFrame:
    return df.withColumns({VISIT: to_date_str(F.col(ts), tz), BEFORE: previous_day_str(F.col(ts), tz)})


# ------------------------------------------------------------ traffic
def visitor_repair_stream(df: DataFrame, key: str, ts: str = "ts", is_new: str = "is_new",
                          seq: str | Sequence[str] | None = None, tz: str = "UTC",
                          by_arrival: bool = False) -> DataFrame:
    """O2 on a stream: keyed first-visit state that never expires.  Rows of a
    key inside a micro-batch are taken in (ts, seq) order, or in ``seq``
    order alone with ``by_arrival``.  Null keys must be filtered out first."""
    return _dated(df, ts, tz).groupBy(key).transformWithStateInPandas(
        FirstVisitProcessor(_order(ts, seq, by_arrival), is_new, df.columns), df.schema, "Append", "None")


def unique_visitor_stream(df: DataFrame, key: str, ts: str = "ts", seq: str | Sequence[str] | None = None,
                          tz: str = "UTC", ttl_ms: int | None = 86_400_000,
                          by_arrival: bool = False) -> DataFrame:
    """O3/O5 on a stream: last-date state with a processing-time TTL.

    State with a TTL makes Spark run no-data batches to expire it, so an
    ``availableNow`` trigger does not end on its own: run it with a
    processing-time trigger, or pass ``ttl_ms=None`` for a bounded replay.
    """
    return _dated(df, ts, tz).groupBy(key).transformWithStateInPandas(
        UniqueVisitorProcessor(_order(ts, seq, by_arrival), df.columns, ttl_ms), df.schema, "Append",
        "None" if ttl_ms is None else "ProcessingTime")


def user_jump_stream(df: DataFrame, key: str, ts: str = "ts", seq: str | Sequence[str] = "seq",
                     is_entry: str = "is_entry", within_ms: int = traffic.BOUNCE_WITHIN_MS,
                     delay: str = "2 seconds") -> DataFrame:
    """O4/W1/W3 on a stream: watermark ``delay`` on the event time, entries
    judged when the watermark passes ``ts + within``; rows are freed then, too."""
    w = df.withColumn("event_time", F.timestamp_millis(F.col(ts))).withWatermark("event_time", delay)
    return w.groupBy(key).transformWithState(
        UserJumpRowProcessor(df.schema, _order(ts, seq, False), ts, is_entry, within_ms), df.schema, "Append", "EventTime")


def base_log_stream(spark: SparkSession, log_topic: str, out_root: str, *, fmt: str = "file",
                    options: dict | None = None, out_fmt: str = "file", out_options: dict | None = None,
                    tz: str = "UTC", checkpoint: str | None = None, trigger: dict | None = None):
    """Job 2 as a stream: parse -> O2 state per mid -> split and fan out (K6).

    ``options`` go to the reader, ``out_options`` to the writers; with ``out_fmt='kafka'`` the topics are
    ``page``, ``start``, ``action``, ``display``, ``error`` and ``dirty``.  Records without ``mid`` or ``ts`` go to dirty.
    Returns the two started queries ``(main, dirty)``.
    """
    raw = read_topic(spark, log_topic, fmt=fmt, stream=True, options=options, arrival=True)
    clean, dirty = traffic.keyed_log(raw, keep=ARRIVAL)
    repaired = visitor_repair_stream(clean, "mid", "ts", "is_new", seq=ARRIVAL, tz=tz)

    def sink(batch: DataFrame, batch_id: int) -> None:
        records = batch.persist(StorageLevel.MEMORY_AND_DISK)
        fan_out(traffic.split_open_log(records), out_root, batch_id=batch_id, fmt=out_fmt, options=out_options)
        records.unpersist()

    ck = _ckpt(spark, "base_log", checkpoint)
    t = trigger or {"availableNow": True}
    with column_family_state(spark):
        main = repaired.writeStream.foreachBatch(sink).option("checkpointLocation", f"{ck}/main") \
            .trigger(**t).start()
    bad = _text_sink(dirty, f"{out_root}/dirty" if out_fmt == "file" else "dirty", out_fmt, out_options, f"{ck}/dirty", t)
    return main, bad


def _text_sink(df: DataFrame, topic: str, fmt: str, options: dict | None, checkpoint: str, trigger: dict):
    """Append the texts of a stream to a topic, a folder for each micro-batch."""
    with column_family_state(df.sparkSession):
        return df.select("value").writeStream.foreachBatch(
            lambda batch, batch_id: write_append(batch, topic, fmt=fmt, batch_id=batch_id, options=options, serialise=False)) \
            .option("checkpointLocation", checkpoint).trigger(**trigger).start()


# --------------------------------------------------------------- joins
def interval_join_stream(left: DataFrame, right: DataFrame, key_l: str, key_r: str,
                         ts_l: str, ts_r: str, lower_ms: int, upper_ms: int,
                         how: str = "inner", delay: str = "2 seconds") -> DataFrame:
    """J7 (inner) / J2 (left outer) on streams: watermark both sides on the
    event time (epoch ms columns) and bound the join by the time range."""
    lw = left.withColumn("l_time", F.timestamp_millis(F.col(ts_l))).withWatermark("l_time", delay)
    rw = right.withColumn("r_time", F.timestamp_millis(F.col(ts_r))).withWatermark("r_time", delay)
    return stream_interval_join(lw, rw, key_l, key_r, "l_time", "r_time", lower_ms, upper_ms, how)


def order_pre_process_stream(env: DataFrame, retention_s: int = 905,
                             side_retention_s: int | None = None,
                             delay: str = "10 seconds") -> DataFrame:
    """Job 6 joins on a change stream (J1, J2, O6) -- before the dictionary.

    The idle retention of the source system becomes an event-time bound:
    an order version joins a detail only within ``retention_s`` of it, and
    activity/coupon rows within ``side_retention_s`` (default: the same).
    Counted from the detail's change time.  An order version without a detail within the bound (the default is the
    source system's idle time) is not lost: it comes out with ``late`` true and null detail columns once the watermark has
    passed the bound, to be counted and kept by the caller.
    All sides are watermarked on the change time so Spark can drop join
    state; a detail without activity/coupon is emitted (with nulls) once the
    watermark passes its time plus the bound.
    """
    ev = env.withColumn("change_time", F.timestamp_seconds(F.col("ts")))
    od = trade.order_details(ev.withColumn("ts", F.col("ts"))) \
        .withColumn("od_time", F.timestamp_seconds(F.col("od_ts"))).withWatermark("od_time", delay)
    oi = trade.order_infos(ev).withColumn("oi_time", F.timestamp_seconds(F.col("oi_ts"))) \
        .withWatermark("oi_time", delay)
    act = trade._table(ev, "order_detail_activity", ("insert",)).select(
        *[F.col("data")[k].alias("act_" + k) for k in trade.ACTIVITY_KEYS],
        F.col("change_time").alias("act_time")).withWatermark("act_time", delay)
    cou = trade._table(ev, "order_detail_coupon", ("insert",)).select(
        *[F.col("data")[k].alias("cou_" + k) for k in trade.COUPON_KEYS],
        F.col("change_time").alias("cou_time")).withWatermark("cou_time", delay)
    rng = F.expr(f"INTERVAL {retention_s} SECONDS")
    side = F.expr(f"INTERVAL {side_retention_s or retention_s} SECONDS")
    # Each join output keeps one event-time column (the detail's), so the
    # next stateful join sees a single watermark.
    j = oi.join(od, (od["order_id"] == oi["oi_id"])
                & oi["oi_time"].between(od["od_time"] - rng, od["od_time"] + rng), "leftOuter") \
        .select(*od.columns, *[c for c in oi.columns if c != "oi_time"])
    # late rows have no detail time; by the condition on their own side they pass the next joins at once, without state
    j = j.join(act, j["od_time"].isNotNull() & (j["id"] == act["act_order_detail_id"])
               & act["act_time"].between(j["od_time"] - side, j["od_time"] + side), "leftOuter") \
        .drop("act_time")
    j = j.join(cou, j["od_time"].isNotNull() & (j["id"] == cou["cou_order_detail_id"])
               & cou["cou_time"].between(j["od_time"] - side, j["od_time"] + side), "leftOuter") \
        .drop("cou_time")
    return j.withColumn("late", F.col("od_time").isNull())


def with_dictionary(pre: DataFrame, base_dic: DataFrame, now: Column | None = None) -> DataFrame:
    """Finish job 6 on one micro-batch of joined rows: dictionary join
    and the output projection.  Late rows have no detail and are the caller's to keep."""
    from martflow.operators.joins import lookup_join
    d = lookup_join(pre.filter(~F.col("late")), base_dic, "source_type", "dic_code", dict_cols=trade.DIC_COLS)
    pt = now if now is not None else F.current_timestamp()
    return d.select(
        *[F.col(c) for c in trade.ORDER_DETAIL_KEYS if c != "source_type"],
        F.col("dic_name").alias("source_type"), "split_original_amount", "od_ts",
        F.col("oi_order_status").alias("order_status"), F.col("oi_user_id").alias("user_id"),
        F.col("oi_operate_time").alias("operate_time"),
        F.col("oi_province_id").alias("province_id"), "oi_ts", pt.alias("pt"),
        F.col("act_activity_id").alias("activity_id"),
        F.col("act_activity_rule_id").alias("activity_rule_id"),
        F.col("cou_coupon_id").alias("coupon_id"), F.col("cou_coupon_use_id").alias("coupon_use_id"),
        "type", "old", pt.alias("row_op_ts"))


# ----------------------------------------------------------- micro-batch
def lookup_stream(spark: SparkSession, env_stream: DataFrame,
                  build: Callable[[DataFrame, DataFrame], DataFrame],
                  load_dictionary: Callable[[], DataFrame], out: str, *,
                  keyed: list[str] | None = None, order: Column | None = None,
                  fmt: str = "file", options: dict | None = None, checkpoint: str | None = None,
                  name: str = "lookup", trigger: dict | None = None):
    """Run ``build(batch, dictionary)`` per micro-batch with the dictionary
    *re-read for each batch* (J4: the dictionary as of processing time).

    Output is an append topic, or a keyed topic (K3) when ``keyed`` names
    the key columns and ``order`` the order of a key's versions.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        res = build(batch, load_dictionary())
        if keyed:
            write_keyed(res, out, keyed, order=order, batch_id=batch_id, fmt=fmt, options=options)
        else:
            write_append(res, out, batch_id=batch_id, fmt=fmt, options=options)

    return env_stream.writeStream.foreachBatch(sink) \
        .option("checkpointLocation", _ckpt(spark, name, checkpoint)) \
        .trigger(**(trigger or {"availableNow": True})).start()


COMMIT_SCHEMA = "sink_table string, version bigint, query_id string, batch_id bigint"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _commits(spark: SparkSession, root: str) -> DataFrame:
    """The versions that were written whole: one row for each, with the query and micro-batch that wrote it."""
    path = f"{root}/_commits"
    if not _exists(spark, path):
        return spark.createDataFrame([], COMMIT_SCHEMA)
    return spark.read.schema(COMMIT_SCHEMA).parquet(path)


def read_dimension(spark: SparkSession, root: str, table_name: str) -> DataFrame | None:
    """Current content of a dimension table: its newest committed version; None if it has none.
    Any error of the storage fails the call, it never reads as "no version yet"."""
    last = _commits(spark, root).filter(F.col("sink_table") == table_name).agg(F.max("version")).first()[0]
    return None if last is None else spark.read.parquet(f"{root}/{table_name}/version={last}").drop("version")


def upsert_dimensions(spark: SparkSession, batch_env: DataFrame, config: DataFrame,
                      root: str, batch_id: int, *, query_id: str = "batch", order_cols: Sequence[str] = ("ts",),
                      drop_deletes: bool = False) -> dict[str, int]:
    """K4/K5/O7 for one micro-batch: route the batch by the config (J6, F8),
    merge each touched dimension's changes column-wise into its current version and
    write the result as its next version.  A dimension that has no version yet gets an
    empty one (K5).  Versions have a counter of their own, so a new stream checkpoint goes on from the last;
    the commit log names the query and micro-batch, so a retry finds its version done.
    ``order_cols`` order the changes of a key, arrival last.  The version before the last stays for readers,
    older ones are deleted.  Returns the version written per table.
    """
    rows = upsert.config_rows(config)
    commits = _commits(spark, root).filter(F.col("sink_table").isin([r["sink_table"] for r in rows])).groupBy("sink_table").agg(
        F.max("version").alias("version"),
        F.max(F.when((F.col("query_id") == query_id) & (F.col("batch_id") == batch_id), F.col("version"))).alias("own"))
    done = {r["sink_table"]: (r["version"], r["own"]) for r in commits.collect()}
    routed = upsert.route_dimensions(batch_env, config, drop_deletes=drop_deletes).persist(StorageLevel.MEMORY_AND_DISK)
    touched = {r[0] for r in routed.select("sink_table").distinct().collect()}  # configured names alone
    written = {}
    for row in rows:
        name, pk, cols = row["sink_table"], row["sink_pk"], row["sink_columns"].split(",")
        schema = upsert.dimension_schema(row["sink_columns"], pk)
        last, own = done.get(name, (None, None))
        if own is not None or last is not None and name not in touched:
            continue
        version = 0 if last is None else last + 1
        out = spark.createDataFrame([], schema)
        if name in touched:
            order = lambda new, *rest: F.struct(F.lit(new).alias("new"), *rest).alias("__seq")
            given = [F.col(c).alias(f"o{i}") for i, c in enumerate(order_cols)]
            new = routed.filter(F.col("sink_table") == name).select("pk", "data", order(1, *given))
            cur = read_dimension(spark, root, name)
            if cur is not None:
                have = [c for c in cols if c in cur.columns]  # a column added to the config starts as null
                none = [F.lit(None).cast(batch_env.schema[c].dataType).alias(f"o{i}") for i, c in enumerate(order_cols)]
                as_changes = cur.select(F.col(pk).alias("pk"), F.map_filter(  # never-written columns are null: leave them out
                    F.map_from_arrays(F.array(*[F.lit(c) for c in have]), F.array(*[F.col(c) for c in have])),
                    lambda k, v: v.isNotNull()).alias("data"), order(0, *none))
                new = as_changes.unionByName(new)
            merged = upsert.merge_columns(new, ["pk"], "data", [c for c in cols if c != pk], ["__seq"])
            out = merged.select(*[(F.col("pk") if c == pk else F.col(c)).alias(c) for c in cols])
        out.write.mode("overwrite").parquet(f"{root}/{name}/version={version}")
        spark.createDataFrame([(name, version, query_id, batch_id)], COMMIT_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_commits")
        if version > 1:
            _delete(spark, f"{root}/{name}/version={version - 2}")
        written[name] = version
    routed.unpersist()
    return written


def dim_sync_stream(spark: SparkSession, db_topic: str, config_topic: str, root: str, *,
                    fmt: str = "file", options: dict | None = None, config_options: dict | None = None,
                    query_id: str = "dim_sync", checkpoint: str | None = None,
                    trigger: dict | None = None):
    """Job 1 as a stream: per micro-batch, fold the config feed *as of now*
    (O8; a data row whose config is not there yet is dropped, as in the
    source system) and upsert the routed rows into the dimension tables.

    Dirty change records go to ``root/_dirty``, rejected config rows and dirty config text to ``root/_rejected``.
    """
    raw = read_topic(spark, db_topic, fmt=fmt, stream=True, options=options, arrival=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        env, dirty = parse_envelope(batch, keep=ARRIVAL)
        write_append(dirty, f"{root}/_dirty", batch_id=batch_id, serialise=False)
        feed, bad = parse_config_feed_batch(spark, config_topic, fmt, config_options)
        cfg, rejected = upsert.fold_config(feed, seq_col="__arrival")
        write_append(bad.select("value").unionByName(rejected.select(F.to_json(F.struct(*rejected.columns)).alias("value"))),
                     f"{root}/_rejected", batch_id=batch_id, serialise=False)
        upsert_dimensions(spark, env, cfg, root, batch_id, query_id=query_id, order_cols=("ts", *ARRIVAL))
        batch.unpersist()

    return raw.writeStream.foreachBatch(sink) \
        .option("checkpointLocation", _ckpt(spark, "dim_sync", checkpoint)) \
        .trigger(**(trigger or {"availableNow": True})).start()


# Places of two topics on one clock: milliseconds, and in one of them config changes by offset, then data.
_PLACES = 1_000_000


def dim_route_stream(spark: SparkSession, db_topic: str, config_topic: str, root: str, *, checkpoint: str | None = None,
                     trigger: dict | None = None, max_files: int | None = None):
    """J6 + O8 as one stream over two segment topics: each change row is routed by the config that had arrived before it.

    The topics' records are one stream, by their time of arrival.  The config is state: a small table ``root/_config``, a version for
    each micro-batch, made from the last one and the batch's config changes alone.  Routed rows (``sink_table, sink_pk,
    pk, data, place``) go to ``root/routed``, dirty texts of both topics to ``root/_dirty``.
    """
    both = segments.read(spark, db_topic, stream=True, max_files=max_files).withColumn("is_config", F.lit(False)) \
        .unionByName(segments.read(spark, config_topic, stream=True, max_files=max_files).withColumn("is_config", F.lit(True)))
    nth = F.when(F.col("is_config"), F.col("offset") % (_PLACES - 1)).otherwise(_PLACES - 1)
    both = both.select("is_config", "value", (F.col("timestamp") * _PLACES + nth).alias("place"))

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        env, dirty = parse_envelope(batch.filter("NOT is_config"), keep=("place",))
        feed, bad = parse_config_feed(batch.filter("is_config"), keep=("place",))
        versions = upsert.config_versions(feed, "place")
        last = config_state(spark, root, batch_id)
        if last is not None:
            versions = versions.unionByName(last)
        versions = land(versions, "config-versions")
        routed = upsert.route_by_arrival(env, versions, "place")
        routed.select("sink_table", "sink_pk", "pk", "data", "place").write.mode("overwrite").parquet(f"{root}/routed/batch={batch_id}")
        write_append(dirty.select("value").unionByName(bad.select("value")), f"{root}/_dirty", batch_id=batch_id, serialise=False)
        now = upsert.latest(versions, ["source_table"], ["valid_from"]).filter("NOT gone")
        now.coalesce(1).write.mode("overwrite").parquet(f"{root}/_config/version={batch_id}")
        batch.unpersist()

    return both.writeStream.foreachBatch(sink).option("checkpointLocation", _ckpt(spark, "dim_route", checkpoint)) \
        .trigger(**(trigger or {"availableNow": True})).start()


def config_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The config after the newest micro-batch (``before`` that one); None if there was none."""
    if not _exists(spark, f"{root}/_config"):
        return None
    versions = [int(f.rpartition("version=")[2]) for f in _folders(spark, f"{root}/_config") if "version=" in f]
    versions = [v for v in versions if before is None or v < before]
    return spark.read.parquet(f"{root}/_config/version={max(versions)}") if versions else None


def _folders(spark: SparkSession, path: str) -> list[str]:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return [s.getPath().toString() for s in p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)]


def parse_config_feed_batch(spark: SparkSession, config_topic: str, fmt: str = "file", options: dict | None = None):
    """The config feed as it stands now, with an arrival sequence that breaks
    ties between changes of the same millisecond."""
    raw = read_topic(spark, config_topic, fmt=fmt, options=options, arrival=True)
    feed, bad = parse_config_feed(raw, keep=ARRIVAL)
    return feed.withColumn("__arrival", F.struct(*ARRIVAL)), bad


# ------------------------------------------------------------ jobs 7-9
# Column types of the wide order row that are not text.
_TYPED = {"od_ts": "bigint", "oi_ts": "bigint", "pt": "timestamp", "row_op_ts": "timestamp", "old": "map<string,string>"}
PRE_PROCESS_SCHEMA = ", ".join(f"{c} {_TYPED.get(c, 'string')}" for c in trade.PRE_PROCESS_COLUMNS)


def read_pre_process(spark: SparkSession, path: str, *, stream: bool = True) -> DataFrame:
    """The keyed pre-processing topic read back as a plain append log of
    wide rows (tombstones dropped)."""
    from martflow.sources.topics import read_keyed_topic
    log = read_keyed_topic(spark, path, stream=stream)
    return log.select(F.from_json("value", PRE_PROCESS_SCHEMA).alias("r")).select("r.*")


def detail_streams(pre: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Jobs 7 and 8 on the pre-processing stream: stateless filters."""
    return trade.order_detail(pre), trade.cancel_detail(pre)


def pay_detail_stream(env: DataFrame, placed: DataFrame, base_dic: DataFrame, *,
                      bound_s: int, delay: str = "10 seconds") -> DataFrame:
    """Job 9 on streams: successful payments ⋈ placed details on the order id
    (J1, watermarks on both sides), then the dictionary (J5).

    The source system keeps payments and details for ever; a stream here must bound its state, so
    ``bound_s`` says how far a payment may lie from its detail's change time.  A payment without a
    detail within it is not lost: it comes out with ``late`` true (and null detail columns) once the watermark has
    passed the bound, to be counted and kept by the caller.
    """
    from martflow.operators.joins import lookup_join
    pay = trade._table(env, "payment_info", ("update",)) \
        .filter(F.col("data")["payment_status"] == trade.PAYMENT_SUCCESS) \
        .select(*[F.col("data")[k].alias("pi_" + k) for k in trade.PAYMENT_KEYS],
                F.timestamp_seconds(F.col("ts")).alias("pay_time_ev")) \
        .withWatermark("pay_time_ev", delay)
    od = placed.withColumn("od_time", F.timestamp_seconds(F.col("od_ts"))) \
        .withWatermark("od_time", delay)
    rng = F.expr(f"INTERVAL {bound_s} SECONDS")
    j = pay.join(od, (od["order_id"] == pay["pi_order_id"])
                 & pay["pay_time_ev"].between(od["od_time"] - rng, od["od_time"] + rng), "leftOuter")
    j = lookup_join(j, base_dic, "pi_payment_type", "dic_code", dict_cols=trade.DIC_COLS, dict_small=False)
    return j.select(*trade.DETAIL_COLUMNS, F.col("dic_name").alias("payment_type"),
                    F.col("pi_create_time").alias("pay_time"), F.col("pi_order_id").alias("paid_order_id"),
                    F.col("id").isNull().alias("late"))


# ------------------------------------------------------------ jobs 3, 4
def _page_stream(spark: SparkSession, page_topic: str, fmt: str, options: dict | None):
    """The page topic parsed without a dirty output (P3: the page log was
    cleaned by job 2, bad text fails the job), with the key, the entry flag and
    the arrival order as columns.  Pages without a key or time are no visitor's."""
    raw = read_topic(spark, page_topic, fmt=fmt, stream=True, options=options, arrival=True)
    recs = parse_strict(raw, LOG_SCHEMA, keep=("value", *ARRIVAL))
    return recs.select("value", F.col("common")["mid"].alias("mid"), "ts",
                       F.col("page")["last_page_id"].isNull().alias("is_entry"), *ARRIVAL) \
        .filter(F.col("mid").isNotNull() & F.col("ts").isNotNull())


def unique_visitor_job_stream(spark: SparkSession, page_topic: str, out: str, *,
                              fmt: str = "file", options: dict | None = None,
                              out_fmt: str = "file", out_options: dict | None = None,
                              checkpoint: str | None = None, trigger: dict | None = None,
                              ttl_ms: int | None = 86_400_000, tz: str = "UTC"):
    """Job 3 as a stream: page topic -> session entries (F7) -> O3 state ->
    append topic of the emitted page records (K1)."""
    pages = _page_stream(spark, page_topic, fmt, options).filter("is_entry")
    uv = unique_visitor_stream(pages, "mid", "ts", seq=ARRIVAL, tz=tz, ttl_ms=ttl_ms)
    return _text_sink(uv, out, out_fmt, out_options, _ckpt(spark, "unique_visitor", checkpoint),
                      trigger or {"processingTime": "10 seconds"})


def user_jump_job_stream(spark: SparkSession, page_topic: str, out: str, *,
                         fmt: str = "file", options: dict | None = None,
                         out_fmt: str = "file", out_options: dict | None = None,
                         checkpoint: str | None = None, trigger: dict | None = None,
                         within_ms: int = traffic.BOUNCE_WITHIN_MS, delay: str = "2 seconds"):
    """Job 4 as a stream: page topic -> O4 state with event-time timers ->
    append topic of the bounced entry records (K1)."""
    pages = _page_stream(spark, page_topic, fmt, options)
    uj = user_jump_stream(pages, "mid", "ts", ARRIVAL, "is_entry", within_ms, delay)
    return _text_sink(uj, out, out_fmt, out_options, _ckpt(spark, "user_jump", checkpoint), trigger or {"availableNow": True})
