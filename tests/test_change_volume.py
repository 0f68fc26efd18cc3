"""Jobs 5-9 and keyed tables shuffle and write each row as seldom as they can."""

import json
import os
import re

from pyspark.sql import functions as F

from martflow.functions.cols import pack, unpack
from martflow.operators import joins, trade
from martflow.plans import queries as Q
from martflow.session import land
from martflow.sinks.keyed_table import KeyedTable
from martflow.sources.envelope import parse_envelope, read_changes

KEY = "spark.sql.maxConcurrentOutputFileWriters"


def _lines(spark):
    rec = lambda table, typ, data, **more: json.dumps({"database": "d", "table": table, "type": typ, "ts": 5, "data": data} | more)
    detail = {"id": "1", "order_id": "7", "sku_id": "3", "order_price": "2.50", "sku_num": "3", "source_type": "N"}
    rows = [rec("order_detail", "insert", detail), rec("order_detail", "insert", detail),
            rec("order_detail", "insert", detail | {"id": None, "order_id": "8"}),
            rec("order_detail", "insert", detail | {"id": "2", "order_price": None}).replace("order_detail", "order\\u005fdetail"),
            rec("order_info", "insert", {"id": "7", "order_status": "1001"}), rec("order_info", "update", {"id": "7", "order_status": "1003"}, old={"order_status": "1001"}),
            rec("order_info", "insert", {"id": "8", "order_status": "1001"}),
            rec("order_detail_activity", "insert", {"order_detail_id": "1", "activity_id": "a"}),
            rec("base_dic", "insert", {"dic_code": "N", "dic_name": "order_detail"}), "[1]", '{"table":"order_info"', '{"table":"order_info","type":"bootstrap-start"}', ""]
    return spark.createDataFrame([(r,) for r in rows], "value string")


def _all(df):
    return sorted(map(repr, df.drop("pt", "row_op_ts").collect()))


def test_views_of_the_text_equal_views_of_the_parsed_changes(spark, tmp_path):
    _lines(spark).write.parquet(str(tmp_path / "in"))
    lines = spark.read.parquet(str(tmp_path / "in"))
    parsed, texts = parse_envelope(lines), read_changes(lines)
    dic = spark.createDataFrame([("N", "none")], "dic_code string, dic_name string")
    pre = [trade.order_pre_process(env, dic) for env in (parsed[0], texts[0])]
    assert _all(pre[0]) == _all(pre[1]) and len(_all(pre[1])) == 7
    assert {r.split_original_amount for r in pre[1].collect()} == {"7.5000", None}
    assert _all(joins.dictionary_versions(parsed[0], "base_dic", "dic_code", ["dic_name"])) == _all(joins.dictionary_versions(texts[0], "base_dic", "dic_code", ["dic_name"]))
    assert _all(parsed[1]) == _all(texts[1].select("value")) and parsed[1].count() == 4
    plan = trade.order_infos(texts[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.rindex("Contains(") > plan.rindex("jsonObjectKeys(")  # the text is tested before it is parsed


def test_a_derived_amount_is_worked_out_behind_the_joins(spark):
    env, _ = read_changes(_lines(spark))
    plan = trade.order_pre_process(env, spark.createDataFrame([("N", "none")], "dic_code string, dic_name string"))._jdf.queryExecution().optimizedPlan().toString()
    assert "split_original_amount" in plan and plan.index("split_original_amount") < plan.index("Join") and plan.count("AS split_original_amount") == 1


def _pre_by_plain_joins(env, dic):
    """Job 6 as the plain joins of its four views."""
    od, oi = trade.order_details(env).join(dic, F.col("source_type") == F.col("dic_code")), trade.order_infos(env)
    act = trade._table(env, "order_detail_activity", ("insert",)).select(*trade.map_fields("data", trade.ACTIVITY_KEYS, "act_"))
    cou = trade._table(env, "order_detail_coupon", ("insert",)).select(*trade.map_fields("data", trade.COUPON_KEYS, "cou_"))
    od = od.drop("source_type").withColumnRenamed("dic_name", "source_type")
    j = od.join(act, od["id"] == act["act_order_detail_id"], "left").join(cou, od["id"] == cou["cou_order_detail_id"], "left")
    j = j.join(oi, j["order_id"] == oi["oi_id"])
    short = lambda c: c.split("_", 1)[1] if c.startswith(("act_", "cou_")) or c.startswith("oi_") and c != "oi_ts" else c
    j = j.drop("act_order_detail_id", "cou_order_detail_id", "oi_id")
    return j.select(*[F.col(c).alias(short(c)) for c in j.columns]).select(*[c for c in trade.PRE_PROCESS_COLUMNS if c not in ("pt", "row_op_ts")])


def _wide_lines(spark):
    rec = lambda table, typ, data, **more: json.dumps({"database": "d", "table": table, "type": typ, "ts": 5, "data": data} | more)
    odd = {"sku_name": 'a "b"\x01\x02\n\t\\ \u00e9', "source_id": "", "create_time": None, "order_price": "2.5", "sku_num": "3", "source_type": "N"}
    keys = [("1", "7"), ("1", "7"), ("1", "8"), ("2", "7"), (None, "7"), ("3", None), (None, None), ("4", "9"), ("", "7"), ("5", "")]
    rows = [rec("order_detail", "insert", odd | {"id": i, "order_id": o}) for i, o in keys]
    rows += [rec("order_info", t, {"id": o, "order_status": s}, old={"a": s}) for o, t, s in [("7", "insert", "1001"), ("7", "update", "1003"), ("8", "insert", "1001"), (None, "insert", "x"), ("", "update", "1003")]]
    rows += [rec("order_detail_activity", "insert", {"order_detail_id": i, "activity_id": a}) for i, a in [("1", "a"), ("1", "b"), ("1", "b"), (None, "n"), ("", "e"), ("9", "z")]]
    rows += [rec("order_detail_coupon", "insert", {"order_detail_id": i, "coupon_id": a}) for i, a in [("1", "c"), ("1", "d"), ("2", None), (None, "n"), ("5", "f")]]
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_details_that_are_shuffled_once_equal_plain_joins(spark, tmp_path):
    _wide_lines(spark).write.parquet(str(tmp_path / "in"))
    env, _ = read_changes(spark.read.parquet(str(tmp_path / "in")))
    dic = spark.createDataFrame([("N", "none")], "dic_code string, dic_name string")
    want, got = _pre_by_plain_joins(env, dic), trade.order_pre_process(env, dic)
    assert _all(want) == _all(got.select(*want.columns)) and len(_all(got)) > 30
    paid = spark.createDataFrame([("7",), ("7",), (None,)], "o string")
    assert _all(want.filter("order_id = '7'")) == _all(trade.order_pre_process(env, dic, orders=paid).select(*want.columns))


def test_wide_details_are_shuffled_once(spark, tmp_path):
    _wide_lines(spark).write.parquet(str(tmp_path / "in"))
    env, _ = read_changes(spark.read.parquet(str(tmp_path / "in")))
    pre = trade.order_pre_process(env, spark.createDataFrame([("N", "none")], "dic_code string, dic_name string"))
    plan = pre._jdf.queryExecution().executedPlan().toString()
    by = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
    assert sorted(by) == sorted(["order_id", "order_id", "x_id", "act_order_detail_id", "cou_order_detail_id", "x_order_id", "oi_id"])
    pre.collect()
    assert "ReusedExchange" in pre._jdf.queryExecution().executedPlan().toString()  # both uses of the details


def test_packed_columns_come_back(spark):
    rows = [("a", None, 'x"y', 3), ("", "\x01\x02", "\x020", None), (None, None, None, None), ("\x021", "\x0221\x01", "\x02", -1), ("", "", "", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, n bigint").coalesce(1)
    back = df.select(pack("a", "b", "c", "n").alias("p")).select(*unpack("p", "a", "b", "c", "n"))
    assert [tuple(r) for r in back.collect()] == [tuple(None if v is None else str(v) for v in r) for r in rows]


def test_landing_by_folder_needs_no_shuffle(spark):
    rows = spark.range(1000, numPartitions=3).select("id", (F.col("id") % 5).cast("string").alias("p"))
    was = spark.conf.get(KEY)
    back = land(rows, "folders", ("p",))
    files = [os.path.dirname(f) for f in back.inputFiles()]
    assert len(files) == 15 and len(set(files)) == 5  # each of the three tasks wrote to each folder
    assert back.filter("p = '3'").count() == 200 and spark.conf.get(KEY) == was


def test_a_keyed_table_is_written_by_the_tasks_of_its_fold(spark, tmp_path):
    t = KeyedTable(spark, str(tmp_path / "t"), 4)
    rows = spark.range(400).select(F.col("id").cast("string").alias("key"), F.lit("v").alias("value"), F.col("id").alias("at"))
    t.append(rows.unionByName(rows.withColumn("value", F.lit("w")).withColumn("at", F.col("at") + 1)), ["at"], batch_id=0)
    assert len(t.files()) == 4 and t.compact(0) == [0, 1, 2, 3]
    assert {r.value for r in t.read().collect()} == {"w"} and t.read().count() == 400


def test_order_current_takes_the_last_version(spark, tmp_path, monkeypatch):
    dic = spark.createDataFrame([("N", "none")], "dic_code string, dic_name string")
    env, _ = read_changes(_lines(spark))
    pre = trade.order_pre_process(env, dic, F.lit(None).cast("timestamp")).filter("id = '1'").withColumn("oi_ts", F.col("oi_ts") + F.when(F.col("type") == "update", 1).otherwise(0))
    monkeypatch.setattr(Q, "_pre", lambda spark, sf: pre)
    assert [tuple(r) for r in Q.order_current(spark, "-").collect()] == [("1", "update", "1003", 6)]
