"""Records are parsed once, topics are rendered once, landed tables go."""

import os

from pyspark.sql import functions as F

from martflow.operators import trade, traffic
from martflow.session import checkpoint_root, drop_landed, land, topic_once
from martflow.sources.envelope import parse_envelope


def test_a_change_record_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([('{"table":"t","type":"insert","ts":1,"data":{"id":"1"}}',), ("[1]",), ('{"type":"bootstrap-start"}',)], "value string").write.text(str(tmp_path / "in"))
    clean, dirty = parse_envelope(spark.read.text(str(tmp_path / "in")))
    plan = clean.filter("table = 't' AND type = 'insert'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1 and plan.count("jsonObjectKeys(") == 1
    assert [r.data for r in clean.collect()] == [{"id": "1"}] and dirty.count() == 2


def test_a_log_record_is_parsed_once(spark, tmp_path):
    spark.createDataFrame([('{"common":{"mid":"1"},"ts":1}',), ("{",)], "value string").write.text(str(tmp_path / "in"))
    clean, dirty = traffic.keyed_log(spark.read.text(str(tmp_path / "in")))
    plan = clean._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson(") == 1 and clean.count() == 1 and dirty.count() == 1


def test_landed_tables_are_removed_and_topics_stay(spark):
    lines = topic_once(spark, "test lines", lambda: spark.createDataFrame([('{"table":"a","type":"insert","ts":1,"data":{}}',)] * 3, "value string"))
    again = topic_once(spark, "test lines", lambda: 1 / 0)
    changes, _ = trade.land_changes(lines)
    assert changes.count() == 3 and again.count() == 3
    landed = f"{checkpoint_root(spark)}/tables-{spark.sparkContext.applicationId}".removeprefix("file:")
    assert os.listdir(landed)
    drop_landed(spark)
    assert not os.path.exists(landed) and again.count() == 3
    assert land(spark.range(3).withColumn("p", F.col("id") % 2), "x", ("p",)).filter("p = 1").count() == 1
